"""Exact deduplication with a deterministic survivor.

The survivor of each group of identical raw texts is the earliest row in
arrival order ``(source_ord, doc_ord)``.  Plan:

* project (digest, order key) only - the text itself is not shuffled here;
* ``groupBy(digest).agg(min(order))``: partial aggregation before the
  shuffle, so a text repeated in a third of all rows is one partial row per
  map task, not a hot reduce task;
* anti join of the rows to the losers (non-first copies) on the *unique*
  order key: broadcast when the losers are few, so the text does not move;
  never on the digest, which carries the skew.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusflow.functions.text import text_digest
from corpusflow.operators.sizing import broadcast_if_small


def with_digest(df: DataFrame, text_col: str = "text", name: str = "h") -> DataFrame:
    return df.withColumn(name, text_digest(F.col(text_col)))


LOW_SPAN = 1 << 64  # as many values as a BIGINT has


def order_key(order_cols: list[str]) -> Column:
    """A single number that sorts like (order_cols...): hash aggregation can
    keep its minimum in a fixed-width buffer, whereas min(struct) falls back
    to a sort-based aggregate over all rows.  One column stays a BIGINT; of two,
    the first (below 10^18) times 2^64 plus the second is a DECIMAL(38, 0), so every
    BIGINT fits as the second.  A null order column is an error."""
    if len(order_cols) == 1:
        key = F.col(order_cols[0]).cast("bigint")
    elif len(order_cols) == 2:
        hi, lo = F.col(order_cols[0]).cast("decimal(18,0)"), F.col(order_cols[1]).cast("bigint").cast("decimal(19,0)")
        key = (hi * F.lit(str(LOW_SPAN)).cast("decimal(20,0)") + lo).cast("decimal(38,0)")
    else:
        raise ValueError("order by one or two columns")
    return F.coalesce(key, F.raise_error(F.lit("an order column is null")))


# Up to this many duplicate keys are broadcast (8 bytes each, checked by a
# bounded count); beyond it the anti join is a shuffle join on a unique key.
MAX_BROADCAST_LOSERS = 8_000_000


def dedup_first(df: DataFrame, order_cols: list[str] = ("source_ord", "doc_ord"),
                text_col: str = "text", enabled: bool = True,
                per_source: bool = False) -> DataFrame:
    """D1 first-wins dedup; D2 across sources unless ``per_source``; D4 off switch.

    Rows must already have passed the text filters (only they are remembered).
    The order columns must identify a row.

    Only narrow (digest, key) rows are shuffled to find the *losers* (copies
    that are not the first of their text).  The rows are then anti-joined to
    the losers: when they are few (the usual case) the loser keys are
    broadcast and the text rows do not move at all; otherwise it is a
    shuffle join on the unique, evenly spread order key.
    """
    if not enabled:
        return df
    order_cols = list(order_cols)
    key = ["h", "source_ord"] if per_source else ["h"]
    extra = [F.col("source_ord")] if per_source else []
    keyed = df.select(text_digest(F.col(text_col)).alias("h"), *extra, order_key(order_cols).alias("_ok"))
    winners = keyed.groupBy(*key).agg(F.min("_ok").alias("_ok")).select("_ok")
    # a row is a loser iff its key is no digest's minimum: an anti join on the
    # unique key (never on the digest, whose hot values would meet in one task)
    losers = (keyed.select("_ok").join(winners, "_ok", "left_anti")
              .checkpoint())  # small, read twice: size check and join
    losers = broadcast_if_small(losers, MAX_BROADCAST_LOSERS)
    return (df.withColumn("_ok", order_key(order_cols))
            .join(losers, on="_ok", how="left_anti").drop("_ok"))
