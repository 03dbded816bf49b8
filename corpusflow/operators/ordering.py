"""Distributed ordered scans: ordinals, prefix sums, running max/min and lag.

A window over a whole table (``Window.orderBy`` without a partition) or over a
hot key (one run or source holding a third of the rows) puts that much data in
one task.  Here every scan is split by an explicit *bucket* of the order key:

1. per-bucket totals (partial + final hash aggregate: tiny output),
2. exclusive prefix of those totals over buckets (a window on the tiny table),
3. join the prefix back on (keys, bucket) - AQE broadcasts it at runtime when
   its measured size is small, otherwise a shuffle join on a skew-free key,
4. a window inside (keys, bucket), which reuses the input's partitioning.

The rows are shuffled once on (keys, bucket) and, when expensive, written
once by a reliable checkpoint (see ``scan``).

The bucket must be non-decreasing in the order key within each partition and
is computed from the data (not ``spark_partition_id``), so recomputation after
a lost executor yields the same answer.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BKT = "_bkt"

_WITHIN = {"sum": F.sum, "count": F.count, "max": F.max, "min": F.min}
_ACROSS = {"sum": F.sum, "count": F.sum, "max": F.max, "min": F.min}


@dataclass(frozen=True)
class Running:
    """A running aggregate ``op(expr)`` over rows up to the current one
    (``inclusive``) or strictly before it."""
    name: str
    op: str
    expr: Column
    inclusive: bool = True


#: Quantile segments of the order key: what one scalar aggregate brings to the driver.
SEGMENTS = 64
QUANTILE_ACCURACY = 1_000  # a bound is off by at most one row in so many: a sixteenth of a segment
ROWS_PER_BUCKET = 1_000_000


def target_buckets(df: DataFrame, rows: int = 0, per_partition: int = 4) -> int:
    """Buckets for ``rows`` rows: a few per shuffle partition, more as the rows grow."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    return max(8, parts * per_partition, math.ceil(rows / ROWS_PER_BUCKET))


def _search(key: Column, bounds: list, leaf, first: int = 0, end: int | None = None) -> Column:
    """``leaf(i)`` for the segment i that starts at the largest of ``bounds`` not above ``key``: one bisection."""
    end = len(bounds) if end is None else end
    if end - first == 1:
        return leaf(first)
    mid = (first + end) // 2
    return F.when(key < F.lit(bounds[mid]), _search(key, bounds, leaf, first, mid)).otherwise(_search(key, bounds, leaf, mid, end))


def range_bucket(df: DataFrame, key: Column, buckets: int | None = None,
                 integral: bool = True) -> Column:
    """About ``buckets`` buckets of about equally many rows, rising with the key.

    The key's range is cut at data quantiles into up to ``SEGMENTS`` segments,
    so neither an outlier nor a source whose keys lie close together puts more
    than a segment's rows into one bucket; each segment is cut further into
    pieces of equal width when more buckets are wanted.  Rows of equal keys
    stay together; null keys come first.  One scalar aggregate is computed, and
    a row's bucket takes one bisection, whose leaves hold the cut of their segment."""
    cuts = [i / SEGMENTS for i in range(1, SEGMENTS)]
    rows, lo, hi, inner = df.agg(F.count(key), F.min(key), F.max(key),
                                 F.percentile_approx(key, cuts, QUANTILE_ACCURACY)).first()
    if lo is None:
        return F.lit(0).cast("bigint")
    n = buckets or target_buckets(df, rows)
    segments = min(n, SEGMENTS)
    picked = [inner[i * SEGMENTS // segments - 1] for i in range(1, segments)]
    bounds = sorted({lo, *picked})
    pieces = max(1, math.ceil(n / len(bounds)))
    step = 1 if integral else 0
    ends = [*bounds[1:], hi]

    def leaf(i: int) -> Column:
        if pieces == 1:
            return F.lit(i).cast("bigint")
        width = float((ends[i] + step - bounds[i]) / pieces) or 1.0
        piece = F.greatest(F.lit(0), F.least(F.lit(pieces - 1), F.floor((key - F.lit(bounds[i])) / F.lit(width))))
        return F.lit(i * pieces).cast("bigint") + piece
    return F.when(key.isNull(), F.lit(0).cast("bigint")).otherwise(_search(key, bounds, leaf)).cast("bigint")


def _combine(op: str, prior: Column, within: Column) -> Column:
    if op in ("sum", "count"):
        both_null = prior.isNull() & within.isNull()
        total = F.coalesce(prior, F.lit(0)) + F.coalesce(within, F.lit(0))
        if op == "count":
            return total.cast("bigint")
        return F.when(both_null, F.lit(None)).otherwise(total)
    if op == "max":
        return F.greatest(prior, within)
    return F.least(prior, within)


def scan(df: DataFrame, by: list[str], order: list[Column], bucket: Column,
         running: list[Running] = (), previous: list[str] = (),
         materialize: bool = True) -> DataFrame:
    """Add running aggregates and previous-row values, ordered by ``order``
    within ``by``.  ``order`` must be a total order (end with a unique key).

    ``previous`` columns appear as ``prev_<name>``: the value on the preceding
    row of the same partition (null on the first row).

    Shuffles: the totals branch moves only partial aggregates (one row per
    key, bucket and map task); the rows themselves are shuffled once, on
    (keys, bucket), for the join and the window.  The input is read by both
    branches, so an expensive input would be computed twice: with
    ``materialize`` it is written once by a reliable checkpoint (shared
    folder, lineage cut) before the scan.  Cheap inputs (a plain table scan)
    should pass ``materialize=False``.  (An explicit repartition before the
    checkpoint does not help: with AQE the checkpointed relation does not keep
    its partitioning, so it would only add a shuffle.)"""
    b = df.withColumn(BKT, bucket)
    if materialize:
        b = b.checkpoint(eager=True)
    for i, r in enumerate(running):
        b = b.withColumn(f"_v{i}", r.expr)

    totals_aggs = [_WITHIN[r.op](F.col(f"_v{i}")).alias(f"_t{i}") for i, r in enumerate(running)]
    if previous:
        last_struct = F.struct(*[F.col(c) for c in previous])
        totals_aggs.append(F.max_by(last_struct, F.struct(*order)).alias("_last"))
    totals = b.groupBy(*by, BKT).agg(*totals_aggs)

    wb = Window.partitionBy(*by).orderBy(BKT) if by else Window.orderBy(BKT)
    before = wb.rowsBetween(Window.unboundedPreceding, -1)
    pref_cols = [_ACROSS[r.op](F.col(f"_t{i}")).over(before).alias(f"_p{i}")
                 for i, r in enumerate(running)]
    if previous:
        pref_cols.append(F.lag("_last").over(wb).alias("_plast"))
    prefix = totals.select(*by, BKT, *pref_cols)

    j = b.join(prefix, on=[*by, BKT], how="inner")
    wi = Window.partitionBy(*by, BKT).orderBy(*order)
    out = j
    for i, r in enumerate(running):
        frame = wi.rowsBetween(Window.unboundedPreceding, 0 if r.inclusive else -1)
        within = _WITHIN[r.op](F.col(f"_v{i}")).over(frame)
        out = out.withColumn(r.name, _combine(r.op, F.col(f"_p{i}"), within))
    if previous:
        first_in_bucket = F.row_number().over(wi) == 1
        for c in previous:
            out = out.withColumn(
                f"prev_{c}",
                F.when(first_in_bucket, F.col("_plast")[c]).otherwise(F.lag(c).over(wi)))
    drop = [BKT] + [f"_v{i}" for i in range(len(running))] + [f"_p{i}" for i in range(len(running))]
    if previous:
        drop.append("_plast")
    return out.drop(*drop)


def ordinal(df: DataFrame, by: list[str], order: list[Column], bucket: Column,
            name: str = "ord", materialize: bool = True) -> DataFrame:
    """1-based row number within ``by`` in ``order``, without a single-task window."""
    return scan(df, by, order, bucket, [Running(name, "count", F.lit(1))], materialize=materialize)


def prefix_sum(df: DataFrame, by: list[str], order: list[Column], bucket: Column,
               value: Column, name: str = "cum", materialize: bool = True) -> DataFrame:
    """Inclusive running sum of ``value`` within ``by`` in ``order``."""
    return scan(df, by, order, bucket, [Running(name, "sum", value)], materialize=materialize)
