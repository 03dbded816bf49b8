"""Run-log analytics.

A run log is a DataFrame with a run key, an arrival order and metric columns.
Ordered metrics (histories, running peak, best-so-far, trends, throughput)
use the bucketed scan of ``ordering``: a run holding a third of all rows is
still spread over many tasks.  Per-run summaries (latest row, evaluation,
first crossing, checkpoint resolution) are plain partial+final aggregates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusflow.functions.format import metric_title, trend_arrow
from corpusflow.functions.schedule import perplexity
from corpusflow.operators.filters import on_cadence
from corpusflow.operators.ordering import Running, scan

RUN = "run_id"
CADENCE_BLOCK = 1000  # expected steps generated per row of the block table

# Metric names of a run-log row (DM8), in the order the trainer logs them.
METRICS = ["loss", "perplexity", "learning_rate", "vram_usage", "tokens_per_second"]

RUNLOG_SCHEMA = T.StructType([
    T.StructField("step", T.LongType(), True),
    T.StructField("epoch", T.LongType(), True),
    T.StructField("loss", T.DoubleType(), True),
    T.StructField("perplexity", T.DoubleType(), True),
    T.StructField("learning_rate", T.DoubleType(), True),
    T.StructField("vram_usage", T.DoubleType(), True),
    T.StructField("tokens_per_second", T.DoubleType(), True),
])


def ordered(rl: DataFrame, order: list[Column], bucket: Column,
            running: list[Running] = (), previous: list[str] = (),
            materialize: bool = False) -> DataFrame:
    """Adds ``seq`` (1-based arrival ordinal per run) plus requested running
    aggregates / previous values, in one bucketed scan.  A run log read from
    files is cheap to re-read, so it is not materialized by default."""
    return scan(rl, [RUN], order, bucket,
                [Running("seq", "count", F.lit(1))] + list(running), previous, materialize)


def history(rl: DataFrame, metric: str, map_col: str | None = None) -> DataFrame:
    """A1: values of rows *having* the metric, in arrival order (``seq``).
    With a MAP column an explicit null is kept and an absent key dropped;
    with typed columns absence and null coincide."""
    if map_col:
        has = F.map_contains_key(F.col(map_col), F.lit(metric))
        return rl.filter(has).withColumn("value", F.col(map_col)[metric])
    return rl.filter(F.col(metric).isNotNull()).withColumn("value", F.col(metric))


def latest(rl: DataFrame, order: list[Column], cols: list[str]) -> DataFrame:
    """A2: last row per run in arrival order and the number of rows."""
    last = F.max_by(F.struct(*[F.col(c) for c in cols]), F.struct(*order))
    return (rl.groupBy(RUN).agg(last.alias("_l"), F.count(F.lit(1)).alias("n_rows"))
            .select(RUN, "n_rows", *[F.col("_l")[c].alias(c) for c in cols]))


def latest_per_step(rl: DataFrame, order: list[Column], cols: list[str], step: str = "step") -> DataFrame:
    """Q13: a resumed run repeats steps; the last row of every (run, step) in arrival order, and how often it was logged."""
    last = F.max_by(F.struct(*[F.col(c) for c in cols]), F.struct(*order))
    return (rl.groupBy(RUN, step).agg(last.alias("_l"), F.count(F.lit(1)).alias("n_logged"))
            .select(RUN, step, "n_logged", *[F.col("_l")[c].alias(c) for c in cols]))


def series(rl: DataFrame, metrics: list[str], x: Column, carry: list[str] = ()) -> DataFrame:
    """A3 + X3: wide -> long (run, *carry, metric, title, x, value) of rows having the
    metric; x is the step, else the arrival position."""
    base = rl.select(RUN, *carry, x.alias("x"), *[F.col(m).cast("double") for m in metrics])
    long = base.unpivot([RUN, *carry, "x"], metrics, "metric", "value").filter(F.col("value").isNotNull())
    return long.withColumn("title", metric_title(F.col("metric")))


def has_step(rl: DataFrame) -> bool:
    """A3 guard: nothing is plotted unless some row has a step."""
    return rl.filter(F.col("step").isNotNull()).limit(1).count() > 0


def token_weighted_eval(rows: DataFrame, loss: Column, tokens: Column,
                        by: list[str] = (RUN,)) -> DataFrame:
    """A4 + A5: sum(loss * tokens) / sum(tokens) (0.0 when no tokens) and
    perplexity exp(min(loss, 20))."""
    agg = rows.groupBy(*by).agg(F.sum(loss * tokens).alias("_lt"),
                                F.sum(tokens).cast("bigint").alias("n_tokens"))
    val = F.when(F.coalesce(F.col("n_tokens"), F.lit(0)) > 0,
                 F.col("_lt") / F.col("n_tokens")).otherwise(F.lit(0.0))
    return (agg.withColumn("val_loss", val)
            .withColumn("val_perplexity", perplexity(F.col("val_loss"))).drop("_lt"))


def throughput(tokens: Column, seconds: Column) -> Column:
    """Tokens / elapsed seconds; 0 when elapsed <= 0; null without a previous row.
    ``tokens`` are those of the whole interval, or ``compat_tokens``."""
    return (F.when(seconds.isNull(), F.lit(None).cast("double"))
            .when(seconds <= 0, F.lit(0.0))
            .otherwise(tokens.cast("double") / seconds))


def compat_tokens(batch_tokens: Column, accumulation: int) -> Column:
    """A6, compat numerator: the last micro-batch's tokens times the accumulation steps, although
    the seconds span all batches since the previous log (Q9: it counts too few)."""
    return batch_tokens * F.lit(accumulation)


def running_peak(value: str) -> Running:
    """Running max from 0.0 (combine with ``F.greatest(col, 0.0)``)."""
    return Running(f"{value}_peak", "max", F.col(value))


def best_so_far(value: str) -> Running:
    """W2 helper: min over strictly earlier rows."""
    return Running(f"{value}_prev_min", "min", F.col(value), inclusive=False)


def is_best(value: Column, prev_min: Column) -> Column:
    """Strictly below every earlier value (ties are not best); the first
    value is best (initial best is +inf)."""
    return F.when(value.isNull(), F.lit(False)).when(prev_min.isNull(), F.lit(True)).otherwise(value < prev_min)


def trends(rl_prev: DataFrame, metrics: list[str]) -> DataFrame:
    """Arrow per metric vs the previous row (needs ``prev_<metric>``)."""
    out = rl_prev
    for m in metrics:
        cur = F.coalesce(F.col(m), F.lit(0.0))
        out = out.withColumn(f"{m}_trend", trend_arrow(cur, F.col(f"prev_{m}")))
    return out


def first_crossing(rl: DataFrame, value: str, threshold: float, step: Column,
                   check_every: int = 10) -> DataFrame:
    """First checked step (step % check_every == 0) whose running peak
    exceeds the threshold.  The running peak is monotone, so this equals the
    first checked row above the threshold: one partial+final aggregate."""
    hit = on_cadence(step, check_every, include_zero=True) & (F.col(value) > F.lit(threshold))
    return rl.groupBy(RUN).agg(F.min(F.when(hit, step)).alias("cross_step"))


def batch_breaks(crossings: DataFrame, batch_size: int, reduced: int) -> DataFrame:
    """C8 with W4: per run the intervals of equal batch size, in order: (from_step, size, before), where
    ``before`` samples precede the interval.  The step that crosses still has the full size."""
    after = F.col("cross_step") + 1
    first = F.struct(F.lit(0).cast("bigint").alias("from_step"), F.lit(batch_size).cast("bigint").alias("size"), F.lit(0).cast("bigint").alias("before"))
    second = F.struct(after.alias("from_step"), F.lit(reduced).cast("bigint").alias("size"), (after * batch_size).alias("before"))
    return crossings.select(RUN, "cross_step", F.when(F.col("cross_step").isNull() | (F.lit(batch_size) <= reduced), F.array(first)).otherwise(F.array(first, second)).alias("breaks"))


def batch_at(breaks: Column, step: Column) -> Column:
    """STRUCT<batch_size, first_sample> of a step: its place in the ordered intervals."""
    own = F.element_at(F.filter(breaks, lambda b: b["from_step"] <= step), -1)
    return F.struct(own["size"].alias("batch_size"), (own["before"] + (step - own["from_step"]) * own["size"]).alias("first_sample"))


def batch_of_sample(breaks: Column, sample: Column) -> Column:
    """Step whose batch holds a sample (counted from 0): the inverse of ``batch_at``."""
    own = F.element_at(F.filter(breaks, lambda b: b["before"] <= sample), -1)
    return own["from_step"] + F.floor((sample - own["before"]) / own["size"]).cast("bigint")


def monotone_accept(step: Column, prev_max_step: Column) -> Column:
    """A row is shown only if its step exceeds every earlier one (start 0)."""
    return F.coalesce(step, F.lit(0)) > F.coalesce(prev_max_step, F.lit(0))


def cadence_audit(rl: DataFrame, step: Column, every: int) -> DataFrame:
    """expected steps (every N, > 0, up to the run's last step) against
    the steps present; one row per expected step with ``present``."""
    present = rl.select(RUN, step.alias("step")).filter(on_cadence(F.col("step"), every))
    last = rl.groupBy(RUN).agg(F.max(step).alias("_max"))
    # Expected steps are generated in blocks of CADENCE_BLOCK: one row per
    # block is spread over tasks first, so a very long run is not expanded by
    # a single task.
    span = every * CADENCE_BLOCK
    blocks = (last.filter(F.col("_max") >= every)
              .select(RUN, "_max", F.explode(F.sequence(F.lit(every).cast("bigint"),
                                                        F.col("_max").cast("bigint"),
                                                        F.lit(span).cast("bigint"))).alias("_b"))
              .repartition(RUN, "_b"))
    block_end = F.least(F.col("_b") + F.lit(span - every), F.col("_max").cast("bigint"))
    expected = blocks.select(RUN, F.explode(F.sequence(F.col("_b"), block_end,
                                                      F.lit(every).cast("bigint"))).alias("step"))
    hits = present.groupBy(RUN, "step").agg(F.count(F.lit(1)).alias("n_logged"))
    return (expected.join(hits, [RUN, "step"], "left")
            .select(RUN, "step", F.col("n_logged").isNotNull().alias("present"),
                    F.coalesce("n_logged", F.lit(0)).cast("bigint").alias("n_logged")))


def checkpoint_step(path: Column) -> Column:
    """A8 helper: integer after the last '_' of the file stem; unparsable -> 0."""
    name = F.element_at(F.split(path, "/"), -1)
    stem = F.regexp_replace(name, r"\.pt$", "")
    return F.coalesce(F.element_at(F.split(stem, "_"), -1).try_cast("bigint"), F.lit(0).cast("bigint"))


def resolve_checkpoint(manifest: DataFrame, path_col: str = "path") -> DataFrame:
    """Per run, latest.pt if present, else the checkpoint_step_*.pt with
    the largest step (ties by path); runs without candidates yield no row."""
    name = F.element_at(F.split(F.col(path_col), "/"), -1)
    is_latest = name == F.lit("latest.pt")
    is_step = name.rlike(r"^checkpoint_step_.*\.pt$")
    cand = (manifest.filter(is_latest | is_step)
            .select(RUN, F.col(path_col).alias("path"), is_latest.alias("_latest"),
                    F.when(is_latest, F.lit(None).cast("bigint"))
                    .otherwise(checkpoint_step(F.col(path_col))).alias("step")))
    key = F.struct(F.col("_latest"), F.coalesce(F.col("step"), F.lit(-1)), F.col("path"))
    best = F.max_by(F.struct("path", "step"), key)
    return cand.groupBy(RUN).agg(best.alias("_b")).select(RUN, F.col("_b.path").alias("path"),
                                                         F.col("_b.step").alias("step"))
