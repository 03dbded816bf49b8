import datetime as dt
import json
import math
import os

import pytest
from pyspark.sql import functions as F

from corpusflow.functions.schedule import cosine_with_warmup, linear_decay, update_index
from corpusflow.operators import runlog as R
from corpusflow.operators.ordering import range_bucket
from corpusflow.sources.runlog_io import (append_runlog, read_legacy_array, read_runlog,
                                          read_runlog_maps)
from tests.models import checkpoint_loop


def test_history_map_form_keeps_null_drops_absent(spark, tmp_dir):
    path = os.path.join(tmp_dir, "log.jsonl")
    with open(path, "w") as f:
        for d in [{"step": 1, "loss": 2.5}, {"step": 2}, {"step": 3, "loss": None}, {"step": 4, "loss": 2.1}]:
            f.write(json.dumps(d) + "\n")
    m = read_runlog_maps(spark, path)
    h = R.history(m, "loss", map_col="metrics").select("value").collect()
    assert [r["value"] for r in h] == [2.5, None, 2.1]


def test_absent_log_is_empty(spark, tmp_dir):
    df = read_runlog(spark, os.path.join(tmp_dir, "missing"), R.RUNLOG_SCHEMA)
    assert df.count() == 0 and df.columns == R.RUNLOG_SCHEMA.fieldNames()


def test_append_then_read_and_legacy(spark, tmp_dir):
    log = os.path.join(tmp_dir, "log")
    rows = spark.createDataFrame([(1, 1, 2.5), (1, 2, 2.3)], "run_id BIGINT, step BIGINT, loss DOUBLE")
    append_runlog(rows, log)
    append_runlog(spark.createDataFrame([(1, 3, 2.1)], rows.schema), log)
    back = read_runlog(spark, log, rows.schema)
    last = R.latest(back, [F.col("step")], ["step", "loss"]).collect()[0]
    assert back.count() == 3 and last["step"] == 3 and last["loss"] == 2.1
    legacy = os.path.join(tmp_dir, "metrics.json")
    with open(legacy, "w") as f:
        json.dump([{"step": 1, "loss": 2.5}, {"step": 2, "loss": 2.3}], f, indent=2)
    got = read_legacy_array(spark, legacy, R.RUNLOG_SCHEMA).select("step", "loss").collect()
    assert [(r["step"], r["loss"]) for r in got] == [(1, 2.5), (2, 2.3)]


def _log(spark, values, steps=None):
    base = dt.datetime(2024, 1, 1)
    steps = steps or list(range(len(values)))
    rows = [(7, base + dt.timedelta(seconds=i), i, steps[i], v) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "run_id BIGINT, ts TIMESTAMP, event_id BIGINT, step BIGINT, v DOUBLE")


def _ordered(df, **kw):
    return R.ordered(df, [F.col("ts"), F.col("event_id")], range_bucket(df, F.col("event_id"), 3), **kw)


def test_peak_best_monotone(spark):
    df = _log(spark, [3.0, 2.0, 2.0, 5.0, 1.0, None], steps=[0, 10, 10, 5, 20, 30])
    out = _ordered(df, running=[R.running_peak("v"), R.best_so_far("v"),
                                R.Running("pmax", "max", F.col("step"), inclusive=False)])
    rows = out.orderBy("seq").collect()
    assert [max(r["v_peak"] or 0.0, 0.0) for r in rows] == [3.0, 3.0, 3.0, 5.0, 5.0, 5.0]
    best = [r for r in out.select(R.is_best(F.col("v"), F.col("v_prev_min")).alias("b"), "seq")
            .orderBy("seq").collect()]
    assert [r["b"] for r in best] == [True, True, False, False, True, False]  # ties are not best
    acc = out.select(R.monotone_accept(F.col("step"), F.col("pmax")).alias("a"), "seq").orderBy("seq").collect()
    assert [r["a"] for r in acc] == [False, True, False, False, True, True]


def test_throughput_guards(spark):
    secs = spark.createDataFrame([(None,), (0.0,), (-1.0,), (2.0,)], "s DOUBLE")
    got = [r[0] for r in secs.select(R.throughput(F.lit(100), F.col("s"))).collect()]
    assert got == [None, 0.0, 0.0, 50.0]


def test_token_weighted_eval_zero_tokens(spark):
    df = spark.createDataFrame([(1, 2.0, 0), (2, 1.0, 10), (2, 3.0, 30)], "run_id INT, loss DOUBLE, n BIGINT")
    got = {r["run_id"]: (r["val_loss"], r["val_perplexity"]) for r in
           R.token_weighted_eval(df, F.col("loss"), F.col("n")).collect()}
    assert got[1] == (0.0, 1.0)
    assert got[2][0] == pytest.approx(2.5) and got[2][1] == pytest.approx(math.exp(2.5))


@pytest.mark.parametrize("names", [
    ["latest.pt", "checkpoint_step_9.pt"],
    ["checkpoint_step_9.pt", "checkpoint_step_10.pt"],
    ["checkpoint_step_x.pt", "checkpoint_step_3.pt"],
    ["checkpoint_step_x.pt"],
    ["best_model.pt"],
])
def test_checkpoint_resolution(spark, names):
    df = spark.createDataFrame([(1, f"ckpt/{n}") for n in names], "run_id INT, path STRING")
    got = R.resolve_checkpoint(df).collect()
    want = checkpoint_loop(names)
    assert (got[0]["path"].split("/")[-1] if got else None) == want


def test_lr_schedules_match_formula(spark):
    ts = spark.range(0, 40).select(F.col("id").alias("step"))
    t = update_index(F.col("step"), 2)
    got = ts.select("step", cosine_with_warmup(t, 5e-4, 5, 12, 1e-6).alias("c"),
                    linear_decay(t, 5e-4, 12, 1e-6).alias("l")).orderBy("step").collect()
    r = 1e-6 / 5e-4
    for row in got:
        u = (row["step"] + 1) // 2
        c = u / 5 if u < 5 else r + (1 - r) * 0.5 * (1 + math.cos(math.pi * (u - 5) / (12 - 5)))
        lin = 1 + (r - 1) * min(u, 12) / 12
        assert row["c"] == pytest.approx(5e-4 * c) and row["l"] == pytest.approx(5e-4 * lin)


def test_cadence_and_crossing(spark):
    df = spark.createDataFrame([(1, s, 9.0 if s == 40 else 1.0) for s in [0, 10, 20, 40, 50]],
                               "run_id INT, step BIGINT, vram DOUBLE")
    audit = {r["step"]: r["present"] for r in R.cadence_audit(df, F.col("step"), 20).collect()}
    assert audit == {20: True, 40: True}
    cross = R.first_crossing(df, "vram", 8.0, F.col("step")).collect()[0]
    assert cross["cross_step"] == 40


def test_perplexity_cap_and_one_row_log(spark):
    from corpusflow.functions.schedule import perplexity
    df = spark.createDataFrame([(25.0,), (2.0,)], "loss DOUBLE")
    got = [r[0] for r in df.select(perplexity(F.col("loss"))).collect()]
    assert got == [pytest.approx(math.exp(20)), pytest.approx(math.exp(2.0))]
    one = _log(spark, [4.0])
    out = _ordered(one, running=[R.running_peak("v"), R.best_so_far("v")], previous=["v"]).collect()[0]
    assert out["seq"] == 1 and out["v_peak"] == 4.0 and out["v_prev_min"] is None and out["prev_v"] is None


def test_cadence_audit_block_boundaries(spark, monkeypatch):
    monkeypatch.setattr(R, "CADENCE_BLOCK", 3)
    steps = [s for s in range(0, 215, 10) if s != 120]
    df = spark.createDataFrame([(1, s) for s in steps], "run_id INT, step BIGINT")
    audit = sorted((r["step"], r["present"]) for r in R.cadence_audit(df, F.col("step"), 20).collect())
    assert audit == [(s, s != 120) for s in range(20, 211, 20)]
