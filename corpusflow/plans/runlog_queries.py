"""Registered run-log queries.  ``events`` plays the run log:

run_id = user_id; arrival order = (ts, event_id); seq = 1-based ordinal per
run; step = (seq - 1) * 10 (the trainer logs every 10 steps from step 0);
micro-batch loss = value / 100 / accumulation, logged loss = its de-scaled
value; vram_usage = value / 50 (GB); tokens = 512 * (1 + event_id mod 4).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow.functions.format import status_line
from corpusflow.functions.time import epoch_micros_ntz
from corpusflow.functions.schedule import (cosine_with_warmup, descale_loss, linear_decay,
                                           perplexity, update_index)
from corpusflow.operators import runlog as R
from corpusflow.operators.ordering import Running, range_bucket, scan
from corpusflow.operators.sizing import broadcast_if_small
from corpusflow.plans.registry import register
from corpusflow.sources.tables import table

ACCUM = 2
BASE_LR, MIN_LR, WARMUP, HORIZON = 5e-4, 1e-6, 50, 300
SAVE_EVERY = 100
VRAM_LIMIT = 8.0
BATCH, SEQ_LEN = 16, 512


def runlog_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    micro = F.col("value") / F.lit(100.0) / F.lit(float(ACCUM))
    loss = descale_loss(micro, ACCUM)
    return e.select(F.col("user_id").alias(R.RUN), "ts", "event_id", "event_type", "value",
                    loss.alias("loss"), perplexity(loss).alias("perplexity"),
                    (F.col("value") / F.lit(50.0)).alias("vram_usage"),
                    (F.lit(SEQ_LEN) * (F.lit(1) + F.pmod(F.col("event_id"), F.lit(4)))).cast("bigint")
                    .alias("tokens"))


def _order() -> list[Column]:
    return [F.col("ts"), F.col("event_id")]


def _micros(c: Column) -> Column:
    return epoch_micros_ntz(c)  # events.ts is TIMESTAMP_NTZ


def time_bucket(spark: SparkSession, sf_dir: str) -> Column:
    """Bucket of the arrival time, from the range of the base table's ts."""
    return range_bucket(table(spark, sf_dir, "events"), _micros(F.col("ts")))


def with_steps(spark, sf_dir, running=(), previous=()) -> DataFrame:
    rl = R.ordered(runlog_rows(spark, sf_dir), _order(), time_bucket(spark, sf_dir),
                   running, previous)
    return rl.withColumn("step", ((F.col("seq") - 1) * 10).cast("bigint"))


def _lr_t() -> Column:
    return update_index(F.col("step"), ACCUM)


_RL_SQL = f"""
SELECT run_id, ts, event_id, event_type, value, loss, exp(least(loss, 20.0::DOUBLE)) AS perplexity,
       value / 50.0::DOUBLE AS vram_usage, (512 * (1 + event_id % 4))::BIGINT AS tokens,
       seq, ((seq - 1) * 10)::BIGINT AS step
FROM (SELECT user_id AS run_id, ts, event_id, event_type, value,
             value / 100.0::DOUBLE / {ACCUM}.0::DOUBLE * {ACCUM}.0::DOUBLE AS loss,
             (row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id))::BIGINT AS seq
      FROM events) e"""

_W_PREV = "OVER (PARTITION BY run_id ORDER BY seq)"
_W_BEFORE = "OVER (PARTITION BY run_id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
_W_UPTO = "OVER (PARTITION BY run_id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"


@register("metric_history", "A1", f"""
SELECT run_id, seq, step, round(loss, 9) AS loss FROM ({_RL_SQL}) r WHERE loss IS NOT NULL""")
def metric_history(spark, sf_dir):
    h = R.history(with_steps(spark, sf_dir), "loss")
    return h.select(R.RUN, "seq", "step", F.round("value", 9).alias("loss"))


@register("latest_row", "A2", f"""
SELECT run_id, n_rows, ((n_rows - 1) * 10)::BIGINT AS step, round(loss, 9) AS loss,
       round(perplexity, 9) AS perplexity, event_type
FROM (SELECT run_id, count(*)::BIGINT AS n_rows, arg_max(loss, seq) AS loss,
             arg_max(perplexity, seq) AS perplexity, arg_max(event_type, seq) AS event_type
      FROM ({_RL_SQL}) r GROUP BY run_id) l""")
def latest_row(spark, sf_dir):
    rl = runlog_rows(spark, sf_dir)
    last = R.latest(rl, _order(), ["loss", "perplexity", "event_type"])
    return last.select(R.RUN, "n_rows", ((F.col("n_rows") - 1) * 10).cast("bigint").alias("step"),
                       F.round("loss", 9).alias("loss"), F.round("perplexity", 9).alias("perplexity"),
                       "event_type")


def _cosine_sql(t: str) -> str:
    r = MIN_LR / BASE_LR
    return (f"({BASE_LR!r}::DOUBLE * CASE WHEN {t} < {WARMUP} THEN {t}::DOUBLE / {WARMUP}.0::DOUBLE "
            f"ELSE {r!r}::DOUBLE + {1.0 - r!r}::DOUBLE * (0.5::DOUBLE * (1.0::DOUBLE + "
            f"cos({math.pi!r}::DOUBLE * (({t}::DOUBLE - {WARMUP}.0::DOUBLE) / {float(HORIZON - WARMUP)!r}::DOUBLE)))) END)")


def _linear_sql(t: str) -> str:
    r = MIN_LR / BASE_LR
    return (f"({BASE_LR!r}::DOUBLE * (1.0::DOUBLE + {r - 1.0!r}::DOUBLE * "
            f"(least({t}::DOUBLE, {float(HORIZON)!r}::DOUBLE) / {float(HORIZON)!r}::DOUBLE)))")


_T_SQL = f"((step + 1) // {ACCUM})"


@register("metric_series", "A3 X3", f"""
SELECT run_id, metric,
       array_to_string(list_transform(string_split(replace(metric, '_', ' '), ' '),
                       lambda w: upper(left(w, 1)) || lower(substr(w, 2))), ' ') AS title,
       step AS x, round(value, 12) AS value
FROM (SELECT run_id, step, loss, perplexity, {_cosine_sql(_T_SQL)} AS learning_rate, vram_usage
      FROM ({_RL_SQL}) r)
UNPIVOT (value FOR metric IN (loss, perplexity, learning_rate, vram_usage)) u
WHERE value IS NOT NULL""")
def metric_series(spark, sf_dir):
    rl = with_steps(spark, sf_dir)
    if not R.has_step(rl):
        return spark.createDataFrame([], "run_id BIGINT, metric STRING, title STRING, x BIGINT, value DOUBLE")
    rl = rl.withColumn("learning_rate", cosine_with_warmup(_lr_t(), BASE_LR, WARMUP, HORIZON, MIN_LR))
    s = R.series(rl, ["loss", "perplexity", "learning_rate", "vram_usage"],
                 F.coalesce(F.col("step"), F.col("seq") - 1))  # a list position counts from 0
    return s.select(R.RUN, "metric", "title", "x", F.round("value", 12).alias("value"))


@register("eval_by_run", "A4 A5 A7", f"""
SELECT run_id, sum(tokens)::BIGINT AS n_tokens,
       round(CASE WHEN sum(tokens) > 0 THEN sum(loss * tokens) / sum(tokens) ELSE 0.0 END, 9) AS val_loss,
       round(exp(least(CASE WHEN sum(tokens) > 0 THEN sum(loss * tokens) / sum(tokens) ELSE 0.0 END,
                       20.0::DOUBLE)), 9) AS val_perplexity
FROM ({_RL_SQL}) r GROUP BY run_id""")
def eval_by_run(spark, sf_dir):
    ev = R.token_weighted_eval(runlog_rows(spark, sf_dir), F.col("loss"), F.col("tokens"))
    return ev.select(R.RUN, "n_tokens", F.round("val_loss", 9).alias("val_loss"),
                     F.round("val_perplexity", 9).alias("val_perplexity"))


def _tps_frame(spark, sf_dir) -> DataFrame:
    rl = with_steps(spark, sf_dir, previous=["ts"])
    secs = (_micros(F.col("ts")) - _micros(F.col("prev_ts"))) / F.lit(1e6)
    return rl.withColumn("tokens_per_second", R.throughput(F.col("tokens"), secs))


_TPS_SQL = f"""
SELECT *, CASE WHEN dt IS NULL THEN NULL WHEN dt <= 0 THEN 0.0 ELSE tokens / dt END AS tokens_per_second
FROM (SELECT *, (epoch_us(ts) - epoch_us(lag(ts) {_W_PREV})) / 1e6 AS dt FROM ({_RL_SQL}) r) x"""


@register("throughput", "A6", f"""
SELECT run_id, seq, round(tokens_per_second, 6) AS tokens_per_second FROM ({_TPS_SQL}) t""")
def throughput(spark, sf_dir):
    t = _tps_frame(spark, sf_dir)
    return t.select(R.RUN, "seq", F.round("tokens_per_second", 6).alias("tokens_per_second"))


MICRO_BATCH = 2


@register("throughput_compat", "A6 Q9", f"""
SELECT run_id, seq, round(CASE WHEN dt IS NULL THEN NULL WHEN dt <= 0 THEN 0.0
                               ELSE ({MICRO_BATCH} * tokens * {ACCUM}) / dt END, 6) AS tokens_per_second,
       round(CASE WHEN dt > 0 THEN {MICRO_BATCH * ACCUM}.0 ELSE 1.0 END, 6) AS ratio
FROM ({_TPS_SQL}) t""")
def throughput_compat(spark, sf_dir):
    """The compat numerator beside the default one: a row's tokens are one sequence of a micro-batch of ``MICRO_BATCH``."""
    rl = with_steps(spark, sf_dir, previous=["ts"])
    secs = (_micros(F.col("ts")) - _micros(F.col("prev_ts"))) / F.lit(1e6)
    compat = R.throughput(R.compat_tokens(F.col("tokens") * MICRO_BATCH, ACCUM), secs)
    plain = R.throughput(F.col("tokens"), secs)
    return rl.select(R.RUN, "seq", F.round(compat, 6).alias("tokens_per_second"),
                     F.round(F.when(plain > 0, compat / plain).otherwise(1.0), 6).alias("ratio"))


@register("running_peak", "W1", f"""
SELECT run_id, seq, round(greatest(max(vram_usage) {_W_UPTO}, 0.0), 9) AS vram_peak FROM ({_RL_SQL}) r""")
def running_peak(spark, sf_dir):
    rl = with_steps(spark, sf_dir, running=[R.running_peak("vram_usage")])
    peak = F.greatest(F.col("vram_usage_peak"), F.lit(0.0))
    return rl.select(R.RUN, "seq", F.round(peak, 9).alias("vram_peak"))


@register("best_flag", "W2", f"""
SELECT run_id, seq, CASE WHEN loss IS NULL THEN false WHEN prev_min IS NULL THEN true
                         ELSE loss < prev_min END AS is_best
FROM (SELECT *, min(loss) {_W_BEFORE} AS prev_min FROM ({_RL_SQL}) r) b""")
def best_flag(spark, sf_dir):
    rl = with_steps(spark, sf_dir, running=[R.best_so_far("loss")])
    return rl.select(R.RUN, "seq", R.is_best(F.col("loss"), F.col("loss_prev_min")).alias("is_best"))


def _arrow_sql(m: str) -> str:
    cur = f"coalesce({m}, 0.0)"
    prev = f"lag({m}) {_W_PREV}"
    return (f"CASE WHEN {prev} IS NULL THEN '' WHEN {cur} < {prev} THEN '↓' "
            f"WHEN {cur} > {prev} THEN '↑' ELSE '→' END AS {m}_trend")


@register("trend", "W3", f"""
SELECT run_id, seq, {_arrow_sql('loss')}, {_arrow_sql('perplexity')}, {_arrow_sql('tokens_per_second')}
FROM ({_TPS_SQL}) t""")
def trend(spark, sf_dir):
    t = _tps_frame(spark, sf_dir).drop("prev_ts")
    metrics = ["loss", "perplexity", "tokens_per_second"]
    # the first scan's output feeds both branches of the second: written once
    t2 = scan(t.select(R.RUN, "seq", "ts", *metrics), [R.RUN], [F.col("seq")], time_bucket(spark, sf_dir), [], metrics)
    return R.trends(t2, metrics).select(R.RUN, "seq", *[f"{m}_trend" for m in metrics])


@register("crossing", "W4", f"""
WITH r AS ({_RL_SQL}),
c AS (SELECT run_id, min(step) FILTER (WHERE step % 10 = 0 AND vram_usage > {VRAM_LIMIT}) AS cross_step
      FROM r GROUP BY run_id)
SELECT c.run_id, c.cross_step IS NOT NULL AS crossed,
       (count(*) FILTER (WHERE c.cross_step IS NULL OR r.step < c.cross_step))::BIGINT AS steps_full_batch,
       (count(*) FILTER (WHERE r.step >= c.cross_step))::BIGINT AS steps_reduced_batch
FROM r JOIN c ON r.run_id = c.run_id GROUP BY c.run_id, c.cross_step""")
def crossing(spark, sf_dir):
    """Per run: whether the running VRAM peak crossed the limit, and how many
    logged steps ran with the full and with the reduced batch size."""
    rl = with_steps(spark, sf_dir)
    first = R.first_crossing(rl, "vram_usage", VRAM_LIMIT, F.col("step"))
    j = rl.select(R.RUN, "step").join(first, R.RUN)
    full = F.col("cross_step").isNull() | (F.col("step") < F.col("cross_step"))
    return j.groupBy(R.RUN).agg(F.max("cross_step").isNotNull().alias("crossed"),
                                F.count_if(full).alias("steps_full_batch"),
                                F.count_if(~full).alias("steps_reduced_batch"))


REDUCED = 8


@register("batches_after_crossing", "W4 C8", f"""
WITH r AS ({_RL_SQL}),
c AS (SELECT run_id, min(step) FILTER (WHERE step % 10 = 0 AND vram_usage > {VRAM_LIMIT}) AS cross_step
      FROM r GROUP BY run_id)
SELECT r.run_id, seq, step, cross_step,
       (CASE WHEN step > cross_step THEN {REDUCED} ELSE {BATCH} END)::BIGINT AS batch_size,
       ({BATCH} * CASE WHEN step > cross_step THEN cross_step + 1 ELSE step END
        + {REDUCED} * CASE WHEN step > cross_step THEN step - cross_step - 1 ELSE 0 END)::BIGINT AS first_sample,
       step AS step_of_first, step AS step_of_last
FROM r JOIN c ON r.run_id = c.run_id""")
def batches_after_crossing(spark, sf_dir):
    """The batch of every logged step: its size, its first sample, and the steps found again from its first and last sample."""
    rl = with_steps(spark, sf_dir).select(R.RUN, "seq", "step", "vram_usage")
    breaks = R.batch_breaks(R.first_crossing(rl, "vram_usage", VRAM_LIMIT, F.col("step")), BATCH, REDUCED)
    at = rl.join(broadcast_if_small(breaks), R.RUN).withColumn("b", R.batch_at(F.col("breaks"), F.col("step")))
    last = F.col("b.first_sample") + F.col("b.batch_size") - 1
    return at.select(R.RUN, "seq", "step", "cross_step", "b.batch_size", "b.first_sample",
                     R.batch_of_sample(F.col("breaks"), F.col("b.first_sample")).alias("step_of_first"),
                     R.batch_of_sample(F.col("breaks"), last).alias("step_of_last"))


@register("monotone", "W5", f"""
SELECT run_id, seq, step > coalesce(max(step) {_W_BEFORE}, 0) AS accepted FROM ({_RL_SQL}) r""")
def monotone(spark, sf_dir):
    rl = with_steps(spark, sf_dir).select(R.RUN, "seq", "ts", "step")
    acc = scan(rl, [R.RUN], [F.col("seq")], time_bucket(spark, sf_dir),
               [Running("_prev_max", "max", F.col("step"), inclusive=False)])
    return acc.select(R.RUN, "seq", R.monotone_accept(F.col("step"), F.col("_prev_max")).alias("accepted"))


@register("lr_audit_cosine", "X1", f"""
SELECT run_id, seq, step, {_T_SQL}::BIGINT AS t, round({_cosine_sql(_T_SQL)}, 12) AS lr FROM ({_RL_SQL}) r""")
def lr_audit_cosine(spark, sf_dir):
    rl = with_steps(spark, sf_dir).withColumn("t", _lr_t())
    lr = cosine_with_warmup(F.col("t"), BASE_LR, WARMUP, HORIZON, MIN_LR)
    return rl.select(R.RUN, "seq", "step", "t", F.round(lr, 12).alias("lr"))


@register("lr_linear", "X2", f"""
SELECT run_id, seq, step, {_T_SQL}::BIGINT AS t, round({_linear_sql(_T_SQL)}, 12) AS lr FROM ({_RL_SQL}) r""")
def lr_linear(spark, sf_dir):
    rl = with_steps(spark, sf_dir).withColumn("t", _lr_t())
    return rl.select(R.RUN, "seq", "step", "t",
                     F.round(linear_decay(F.col("t"), BASE_LR, HORIZON, MIN_LR), 12).alias("lr"))


@register("status_line", "X4 W3", f"""
SELECT run_id, seq, printf('Step: %d Epoch: %d | Loss: %.4f %s | Perplexity: %.2f %s | LR: %.2e | VRAM: %.2f GB | Tokens/sec: %.0f %s',
       step, 0, coalesce(loss, 0.0), loss_trend, coalesce(perplexity, 0.0), perplexity_trend, learning_rate, vram_usage,
       coalesce(tokens_per_second, 0.0), tokens_per_second_trend) AS line
FROM (SELECT *, {_cosine_sql(_T_SQL)} AS learning_rate, {_arrow_sql('loss')}, {_arrow_sql('perplexity')}, {_arrow_sql('tokens_per_second')}
      FROM ({_TPS_SQL}) t) l""")
def status_line_q(spark, sf_dir):
    t = _tps_frame(spark, sf_dir).drop("prev_ts")
    t = t.withColumn("learning_rate", cosine_with_warmup(_lr_t(), BASE_LR, WARMUP, HORIZON, MIN_LR))
    metrics = ["loss", "perplexity", "tokens_per_second"]
    t = t.select(R.RUN, "seq", "ts", "step", "learning_rate", "vram_usage", *metrics)
    t2 = R.trends(scan(t, [R.RUN], [F.col("seq")], time_bucket(spark, sf_dir), [], metrics), metrics)
    line = status_line(F.col("step"), F.lit(0), F.col("loss"), F.col("perplexity"), F.col("learning_rate"),
                       F.col("vram_usage"), F.col("tokens_per_second"), F.col("loss_trend"),
                       F.col("perplexity_trend"), F.col("tokens_per_second_trend"))
    return t2.select(R.RUN, "seq", line.alias("line"))


@register("cadence_audit", "F9", f"""
WITH r AS ({_RL_SQL}),
m AS (SELECT run_id, max(step) AS mx FROM r GROUP BY run_id HAVING max(step) >= {SAVE_EVERY}),
x AS (SELECT run_id, unnest(generate_series({SAVE_EVERY}, mx, {SAVE_EVERY}))::BIGINT AS step FROM m),
h AS (SELECT run_id, step, count(*) AS n FROM r WHERE step > 0 AND step % {SAVE_EVERY} = 0 GROUP BY 1, 2)
SELECT x.run_id, x.step, h.n IS NOT NULL AS present, coalesce(h.n, 0)::BIGINT AS n_logged
FROM x LEFT JOIN h ON x.run_id = h.run_id AND x.step = h.step""")
def cadence_audit(spark, sf_dir):
    rl = with_steps(spark, sf_dir)
    return R.cadence_audit(rl, F.col("step"), SAVE_EVERY)


# A log as runs leave it that were resumed: every fifth row repeats an earlier step (or a step that was
# never logged), every eleventh has no step, every thirteenth no loss; steps of the moved rows are missing.
_RESUMED_SQL = f"""
SELECT run_id, ts, seq, perplexity, CASE WHEN event_id % 13 = 0 THEN NULL ELSE loss END AS loss,
       CASE WHEN event_id % 11 = 0 THEN NULL WHEN event_id % 5 = 0 THEN greatest(step - 50, 0) ELSE step END AS step
FROM ({_RL_SQL}) r"""


def resumed_log(spark, sf_dir) -> DataFrame:
    """Steps that repeat, fall back, are absent or skip a cadence; ``seq`` stays the arrival position."""
    rl, e = with_steps(spark, sf_dir), F.col("event_id")
    step = F.when(e % 11 == 0, F.lit(None)).when(e % 5 == 0, F.greatest(F.col("step") - 50, F.lit(0))).otherwise(F.col("step"))
    loss = F.when(e % 13 == 0, F.lit(None)).otherwise(F.col("loss"))
    return rl.select(R.RUN, "ts", "seq", "perplexity", loss.alias("loss"), step.cast("bigint").alias("step"))


@register("metric_history_gaps", "A1", f"""
SELECT run_id, seq, step, round(loss, 9) AS loss FROM ({_RESUMED_SQL}) r WHERE loss IS NOT NULL""")
def metric_history_gaps(spark, sf_dir):
    h = R.history(resumed_log(spark, sf_dir), "loss")
    return h.select(R.RUN, "seq", "step", F.round("value", 9).alias("loss"))


@register("metric_series_gaps", "A3 X3", f"""
SELECT run_id, seq, metric, upper(left(metric, 1)) || substr(metric, 2) AS title, coalesce(step, seq - 1) AS x, round(value, 9) AS value
FROM (SELECT run_id, seq, step, loss, perplexity FROM ({_RESUMED_SQL}) r)
UNPIVOT (value FOR metric IN (loss, perplexity)) u WHERE value IS NOT NULL""")
def metric_series_gaps(spark, sf_dir):
    """Rows without a step stand at their position, counted from 0."""
    rl = resumed_log(spark, sf_dir)
    s = R.series(rl, ["loss", "perplexity"], F.coalesce(F.col("step"), F.col("seq") - 1), carry=["seq"])
    return s.select(R.RUN, "seq", "metric", "title", "x", F.round("value", 9).alias("value"))


@register("monotone_resumed", "W5", f"""
SELECT run_id, seq, step, coalesce(step, 0) > coalesce(max(step) {_W_BEFORE}, 0) AS accepted FROM ({_RESUMED_SQL}) r""")
def monotone_resumed(spark, sf_dir):
    rl = resumed_log(spark, sf_dir).select(R.RUN, "seq", "ts", "step")
    acc = scan(rl, [R.RUN], [F.col("seq")], time_bucket(spark, sf_dir),
               [Running("_prev_max", "max", F.col("step"), inclusive=False)])
    return acc.select(R.RUN, "seq", "step", R.monotone_accept(F.col("step"), F.col("_prev_max")).alias("accepted"))


@register("cadence_audit_gaps", "F9", f"""
WITH r AS ({_RESUMED_SQL}),
m AS (SELECT run_id, max(step) AS mx FROM r GROUP BY run_id HAVING max(step) >= {SAVE_EVERY}),
x AS (SELECT run_id, unnest(generate_series({SAVE_EVERY}, mx, {SAVE_EVERY}))::BIGINT AS step FROM m),
h AS (SELECT run_id, step, count(*) AS n FROM r WHERE step > 0 AND step % {SAVE_EVERY} = 0 GROUP BY 1, 2)
SELECT x.run_id, x.step, h.n IS NOT NULL AS present, coalesce(h.n, 0)::BIGINT AS n_logged
FROM x LEFT JOIN h ON x.run_id = h.run_id AND x.step = h.step""")
def cadence_audit_gaps(spark, sf_dir):
    return R.cadence_audit(resumed_log(spark, sf_dir), F.col("step"), SAVE_EVERY)


def checkpoint_manifest(rl: DataFrame) -> DataFrame:
    """Checkpoint files a run leaves behind, derived from its log rows:
    'purchase' rows save checkpoint_step_<step>.pt, 'error' rows leave an
    unparsable name, 'signup' rows with value > 450 write latest.pt."""
    path = (F.when(F.col("event_type") == "purchase",
                   F.concat(F.lit("checkpoints/checkpoint_step_"), F.col("step").cast("string"), F.lit(".pt")))
            .when(F.col("event_type") == "error",
                  F.concat(F.lit("checkpoints/checkpoint_step_"), F.col("event_type"), F.lit(".pt")))
            .when((F.col("event_type") == "signup") & (F.col("value") > 450), F.lit("checkpoints/latest.pt")))
    return rl.select(R.RUN, path.alias("path")).filter(F.col("path").isNotNull())


@register("checkpoint_latest", "A8", f"""
WITH r AS ({_RL_SQL}),
m AS (SELECT run_id, CASE WHEN event_type = 'purchase' THEN 'checkpoints/checkpoint_step_' || step::VARCHAR || '.pt'
                          WHEN event_type = 'error' THEN 'checkpoints/checkpoint_step_' || event_type || '.pt'
                          WHEN event_type = 'signup' AND value > 450 THEN 'checkpoints/latest.pt' END AS path
      FROM r),
c AS (SELECT run_id, path, string_split(path, '/')[-1] = 'latest.pt' AS is_latest,
             CASE WHEN string_split(path, '/')[-1] = 'latest.pt' THEN NULL
                  ELSE coalesce(try_cast(string_split(regexp_replace(string_split(path, '/')[-1], '\\.pt$', ''), '_')[-1]
                                AS BIGINT), 0) END AS step
      FROM m WHERE path IS NOT NULL)
SELECT run_id, arg_max(path, (is_latest, coalesce(step, -1), path)) AS path,
       max(is_latest) AS is_latest
FROM c GROUP BY run_id""")
def checkpoint_latest(spark, sf_dir):
    res = R.resolve_checkpoint(checkpoint_manifest(with_steps(spark, sf_dir)))
    return res.select(R.RUN, "path", F.col("step").isNull().alias("is_latest"))
