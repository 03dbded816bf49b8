"""Weighted mixing of sources under a token budget (M1-M8).

The reference draws a source at random per chunk.  Here the interleave is an
order key: each source is a Poisson process of rate w, so chunk r of source s
arrives at T = sum_{j<=r} E_j / w (E_j exponential from a hash, "race"), or at
T = (r - 1/2) / w ("deterministic").  Ordering all chunks by T gives
consecutive picks that are independent and proportional to the weights, and a
drained source simply stops arriving.  Every step is a column expression or a
bucketed scan (see ``ordering``), never a single-task window.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusflow.functions.hashing import md5_bucket, md5_uniform
from corpusflow.operators.ordering import BKT, Running, prefix_sum, range_bucket, scan
from corpusflow.operators.sizing import SMALL_TABLE_ROWS, broadcast_if_small
from corpusflow.session import stored

# Arrivals per bucket of the global mix order (bounded rows per window task).
ARRIVALS_PER_BUCKET = 200_000
# Arrival times count whole units: integer sums do not depend on their order.
TIME_UNITS = 1_000_000


def normalize_weights(catalog: DataFrame, override: dict[str, float] | None = None) -> DataFrame:
    """M1: explicit weights override catalog weights; w / sum(w).

    The catalog holds one row per source (a configuration table), so the
    whole-table window below is bounded by the number of sources."""
    df = catalog
    if override:
        w = F.col("weight")
        for name, val in override.items():
            w = F.when(F.col("source") == name, F.lit(float(val))).otherwise(w)
        # the configured weight stays at hand for the compat caps
        df = df.withColumn("weight_config", F.col("weight")).withColumn("weight", w)
    total = F.sum("weight").over(Window.partitionBy())
    return df.withColumn("weight_norm", F.col("weight") / total)


def check_weights(weights: dict[str, float]) -> None:
    if sum(weights.values()) <= 0:
        raise ValueError("weights must sum to a positive number")
    if any(w < 0 for w in weights.values()):
        raise ValueError("weights must be non-negative")


def catalog_weights(catalog: DataFrame) -> list[tuple[str, float]]:
    """(source, weight) of a catalog: configuration, one row per source, so bounded; more rows are an error."""
    rows = catalog.select("source", F.col("weight").cast("double")).limit(SMALL_TABLE_ROWS + 1).collect()
    if len(rows) > SMALL_TABLE_ROWS:
        raise ValueError(f"a catalog of more than {SMALL_TABLE_ROWS} sources")
    return [(r[0], r[1]) for r in rows]


def source_caps(weights: DataFrame, target_tokens: int | None, target_length: int,
                compat: bool = False) -> DataFrame:
    """M2: chunk cap per source = int(target_tokens / target_length * weight).

    Default uses the normalized weight; 0 means zero chunks and no budget
    means unlimited (null).  ``compat`` reproduces the reference: raw config
    weight, and a cap of 0 means unlimited."""
    if not target_tokens:
        return weights.withColumn("cap", F.lit(None).cast("bigint"))
    configured = "weight_config" if "weight_config" in weights.columns else "weight"
    w = F.col(configured) if compat else F.col("weight_norm")
    cap = F.floor(F.lit(float(target_tokens)) / F.lit(float(target_length)) * w).cast("bigint")
    if compat:
        cap = F.when(cap == 0, F.lit(None).cast("bigint")).otherwise(cap)
    return weights.withColumn("cap", cap)


def per_source_ordinal(df: DataFrame, order: list[Column], bucket: Column,
                       name: str = "src_ord") -> DataFrame:
    """1-based ordinal inside each source, bucketed so a source holding most
    rows is still spread over many tasks."""
    return scan(df, ["source"], order, bucket, [Running(name, "count", F.lit(1))])


def cap_per_source(df_with_ord: DataFrame, caps: DataFrame, ord_col: str = "src_ord") -> DataFrame:
    """M3: keep the first ``cap`` chunks of every source (null cap = all)."""
    c = broadcast_if_small(caps.select("source", "cap"))  # one row per source, checked
    j = df_with_ord.join(c, "source", "left")
    return j.filter(F.col("cap").isNull() | (F.col(ord_col) <= F.col("cap"))).drop("cap")


def arrivals(df: DataFrame, weights: DataFrame, order: list[Column], bucket: Column,
             mode: str = "race", seed: int = 0, key: list[Column] | None = None) -> DataFrame:
    """M4: arrival time ``mix_t`` of every chunk.

    race: T = cumulative sum of -ln(u)/w in source order, u in (0, 1) from an
    md5 of (source, key..., seed), each step cut to whole ``TIME_UNITS``, so
    that T is the same for any buckets; deterministic: T = (r - 1/2) / w."""
    w = broadcast_if_small(weights.select("source", "source_ord", F.col("weight").alias("_w")))
    j = df.join(w, "source", "inner").filter(F.col("_w") > 0)
    if mode == "race":
        parts = [F.col("source")] + (key or order) + [F.lit(seed)]
        step = F.floor(-F.log(md5_uniform(*parts)) / F.col("_w") * F.lit(float(TIME_UNITS))).cast("bigint")
        out = scan(j, ["source"], order, bucket, [Running("_units", "sum", step)])
        out = out.withColumn("mix_t", F.col("_units") / F.lit(float(TIME_UNITS))).drop("_units")
    elif mode == "deterministic":
        out = scan(j, ["source"], order, bucket, [Running("_r", "count", F.lit(1))])
        out = out.withColumn("mix_t", (F.col("_r") - F.lit(0.5)) / F.col("_w")).drop("_r")
    else:
        raise ValueError(f"unknown mode {mode}")
    return out.drop("_w")


#: Sources up to which each has its own bound in the filter on the source scan.
MAX_SOURCE_BOUNDS = 64


@dataclass(frozen=True)
class Reach:
    """What caps and budget can reach: ``buckets`` has a row per source and bucket
    in reach with what lies before it (``_before_n`` rows, ``_before_units`` of the
    clock); ``on_scan`` is the same as a filter on source and order key, for the
    source scan; ``last_t`` is the time after which nothing is drawn."""
    buckets: DataFrame
    on_scan: Column
    last_t: float | None


def _clock_step(w: Column, mode: str | None, parts: list[Column], seed: int) -> Column:
    if mode != "race":
        return F.lit(0).cast("bigint")
    uniform = md5_uniform(F.col("source"), *parts, F.lit(seed))
    return F.floor(-F.log(uniform) / w * F.lit(float(TIME_UNITS))).cast("bigint")


def _time(n: Column, units: Column, w: Column, mode: str | None) -> Column:
    return (n - F.lit(0.5)) / w if mode != "race" else units / F.lit(float(TIME_UNITS))


def reach(rows: DataFrame, scan_key: str, target_tokens: int | None, mode: str | None, length_col: str = "chunk_len") -> Reach:
    """Phase one of the early stop, over rows with ``source``, ``_w``, ``cap``, ``_step`` and a bucket.

    Only totals per source and bucket leave the scan.  A bucket is out of reach if the
    buckets before it fill the source's cap, or if it starts after the time by
    which the buckets that are over hold the whole budget."""
    totals = rows.groupBy("source", BKT).agg(
        F.first("_w").alias("_w"), F.first("cap").alias("cap"), F.count(F.lit(1)).alias("_n"), F.sum(length_col).cast("bigint").alias("_tokens"),
        F.sum("_step").alias("_units"), F.max(scan_key).alias("_last"))
    before = Window.partitionBy("source").orderBy(BKT).rowsBetween(Window.unboundedPreceding, -1)
    prior = {f"_before{c}": F.coalesce(F.sum(c).over(before), F.lit(0)).cast("bigint") for c in ("_n", "_units")}
    found = stored(totals.withColumns(prior), "bucket-totals")
    n, units, w, cap = F.col("_before_n"), F.col("_before_units"), F.col("_w"), F.col("cap")
    found = found.filter(cap.isNull() | (n < cap))
    last_t = None
    if target_tokens and mode:
        start = _time(n + 1, units, w, mode)
        timed = found.withColumns({"_start": start, "_end": _time(n + F.col("_n"), units + F.col("_units"), w, mode),
                                   # of a bucket that a cap cuts, nothing is certain
                                   "_sure": F.when(cap.isNull() | (n + F.col("_n") <= cap), F.col("_tokens")).otherwise(0)})
        timed = timed.withColumnRenamed(BKT, "_own")
        sums = prefix_sum(timed, [], [F.col("_end"), F.col("source"), F.col("_own")], range_bucket(timed, F.col("_end"), integral=False), F.col("_sure"), "_sum", materialize=False)
        last_t = sums.filter(F.col("_sum") >= target_tokens).agg(F.min("_end")).first()[0]
        if last_t is not None:
            found = found.filter(start <= F.lit(last_t))
    ends = found.groupBy("source").agg(F.max("_last").alias("_last"))
    bounds = ends.limit(MAX_SOURCE_BOUNDS + 1).collect()
    on_scan = F.lit(False)
    if len(bounds) > MAX_SOURCE_BOUNDS:
        on_scan = F.col(scan_key) <= F.lit(ends.agg(F.max("_last")).first()[0])
    else:
        for r in bounds:
            within = F.col(scan_key) <= F.lit(r["_last"]) if r["_last"] is not None else F.col(scan_key).isNull()
            on_scan = on_scan | ((F.col("source") == r["source"]) & (within | F.col(scan_key).isNull()))
    return Reach(found.select("source", BKT, "_before_n", "_before_units"), on_scan, last_t)


def first_arrivals(df: DataFrame, catalog: DataFrame, order: list[Column], bucket: Column, scan_key: str, *, mode: str | None = "deterministic", seed: int = 0,
                   key: list[Column] | None = None, target_tokens: int | None = None, length_col: str = "chunk_len") -> DataFrame:
    """M3 to M5 without ordering what they can't reach.

    ``catalog``: source, source_ord, weight and, if there are caps, cap (null: none); sources
    that it doesn't hold, and those of weight 0 (with a ``mode``), are never drawn.  Two
    phases: ``reach`` finds from totals per source and bucket which buckets the caps and the
    budget can reach; only their rows are read again (the bounds of
    ``scan_key``, the first order column, go down to the source scan) and ordered.  Returns
    the rows within their caps with ``src_ord`` and, with a mode, the arrival time ``mix_t``; the
    rows of the budget are all there, for ``mix_order`` and ``budget_cut``."""
    cap = F.col("cap") if "cap" in catalog.columns else F.lit(None).cast("bigint")
    w = broadcast_if_small(catalog.select("source", "source_ord", F.col("weight").cast("double").alias("_w"), cap.alias("cap")))
    rows = df.join(w, "source", "inner")
    if mode:
        rows = rows.filter(F.col("_w") > 0)
    rows = rows.withColumns({BKT: bucket, "_step": _clock_step(F.col("_w"), mode, key or order, seed)})
    found = reach(rows, scan_key, target_tokens, mode, length_col)
    inside = rows.filter(found.on_scan).join(broadcast_if_small(found.buckets), ["source", BKT])
    within = Window.partitionBy("source", BKT).orderBy(*order)
    inside = inside.withColumn("src_ord", (F.col("_before_n") + F.row_number().over(within)).cast("bigint"))
    if mode:
        units = F.col("_before_units") + F.sum("_step").over(within.rowsBetween(Window.unboundedPreceding, 0))
        inside = inside.withColumn("mix_t", _time(F.col("src_ord"), units, F.col("_w"), mode))
        if found.last_t is not None:
            inside = inside.filter(F.col("mix_t") <= F.lit(found.last_t))
    inside = inside.filter(F.col("cap").isNull() | (F.col("src_ord") <= F.col("cap")))
    return inside.drop(BKT, "_w", "cap", "_step", "_before_n", "_before_units")


def mix_bucket(weights_rows: list[tuple[str, float]], per_bucket: int = ARRIVALS_PER_BUCKET) -> Column:
    """Bucket of the arrival time: the arrival rate is sum(w), so a bucket of
    width per_bucket / sum(w) holds about per_bucket chunks."""
    rate = sum(w for _, w in weights_rows if w > 0) or 1.0
    return F.floor(F.col("mix_t") / F.lit(per_bucket / rate)).cast("bigint")


def mix_bucket_of(position: Column, per_bucket: int = ARRIVALS_PER_BUCKET) -> Column:
    """Bucket of a 1-based position of the global mix order."""
    return F.floor((position - 1) / F.lit(per_bucket)).cast("bigint")


def mix_order(df: DataFrame, bucket: Column, tie: list[Column],
              length_col: str = "chunk_len") -> DataFrame:
    """Global interleave position ``mix_ord`` and running token count
    ``mix_cum`` in order (mix_t, tie...)."""
    order = [F.col("mix_t")] + tie
    return scan(df, [], order, bucket, [Running("mix_ord", "count", F.lit(1)),
                                         Running("mix_cum", "sum", F.col(length_col))])


def budget_cut(df_ordered: DataFrame, target_tokens: int | None,
               length_col: str = "chunk_len") -> DataFrame:
    """M5: stop once target tokens are emitted; the crossing chunk is kept."""
    if not target_tokens:
        return df_ordered
    return df_ordered.filter(F.col("mix_cum") - F.col(length_col) < F.lit(target_tokens))


def split_by_hash(df: DataFrame, digest_col: str = "h", val_fraction: float = 0.05,
                  modulus: int = 10000) -> DataFrame:
    """M7: stable train/validation split on the text digest, so identical texts
    always land on the same side and the parts are disjoint after dedup."""
    cut = int(round(val_fraction * modulus))
    return df.withColumn("split", F.when(md5_bucket(F.col(digest_col), modulus) < cut,
                                         F.lit("val")).otherwise(F.lit("train")))


def budget_from_subset(subset_size: int | None, seq_len: int, default: int | None) -> int | None:
    """M8: a sample-count override sets the budget to subset x seq_len."""
    if subset_size:
        return int(subset_size) * int(seq_len)
    return default
