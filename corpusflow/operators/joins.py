"""Joins whose key may hold a large part of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusflow.session import stored

#: Keys that more than one row in this many has are frequent: there are fewer of them than this.
FREQUENT = 1_000


def spread_join(rows: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """Left join of stored ``rows`` to ``table`` (one row per ``key``, a null being
    a key too), however many rows share a key: fewer than ``FREQUENT`` keys can
    each hold more than 1 in ``FREQUENT`` rows, and those are joined by broadcast, the others by
    a shuffle in which no key stands out.  ``table`` has no other column of ``rows``."""
    total = rows.count()
    often = rows.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") * FREQUENT > total)
    often = F.broadcast(stored(often.select(F.col(key).alias("_often"), F.lit(True).alias("_is")), "frequent"))
    side = table.withColumnRenamed(key, "_key")
    marked = rows.join(often, F.col(key).eqNullSafe(F.col("_often")), "left")
    few = side.join(often, F.col("_key").eqNullSafe(F.col("_often")), "left_semi")
    columns = [*rows.columns, *(c for c in table.columns if c != key)]
    parts = [marked.filter(w).join(t, F.col(key).eqNullSafe(F.col("_key")), "left").select(*columns)
             for w, t in ((F.col("_is"), F.broadcast(few)), (F.col("_is").isNull(), side))]
    return parts[0].unionByName(parts[1])
