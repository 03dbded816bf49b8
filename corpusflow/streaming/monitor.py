"""Live run-log monitor (ST1, ST2) as a Structured Streaming query.

The log directory is followed by the JSON file source (one new file set per
append, see ``sources.runlog_io``).  Per run, the state holds the last *shown*
row; in every micro-batch the newest row of a run (highest ``seq``) is shown
only if its step exceeds the last shown step (initially 0), with trend arrows
against the last shown row.  Rows between two polls are skipped, as in a
poller that reads only the last entry.  Every task first keeps the newest row per
run of an Arrow batch, so the stateful step sees one row per run and batch, not
the run's log.  Runs share the state of their bucket, one of ``BUCKETS``: a Python call
compares all runs of a bucket at once, so a trigger makes a bounded number of calls however
many runs there are.  Runs without an id are one run; a row without ``seq`` comes before all others.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupStateTimeout

from corpusflow.functions.format import ARROW_DOWN, ARROW_FLAT, ARROW_UP

TRACKED = ["loss", "perplexity", "tokens_per_second"]

LOG_SCHEMA = T.StructType([
    T.StructField("run_id", T.LongType()),
    T.StructField("seq", T.LongType()),
    T.StructField("step", T.LongType()),
    T.StructField("epoch", T.LongType()),
    T.StructField("loss", T.DoubleType()),
    T.StructField("perplexity", T.DoubleType()),
    T.StructField("learning_rate", T.DoubleType()),
    T.StructField("vram_usage", T.DoubleType()),
    T.StructField("tokens_per_second", T.DoubleType()),
])

OUT_SCHEMA = T.StructType([
    T.StructField("run_id", T.LongType()),
    T.StructField("seq", T.LongType()),
    T.StructField("step", T.LongType()),
] + [T.StructField(f"{m}_trend", T.StringType()) for m in TRACKED])

#: Fixed for the life of a checkpoint.
BUCKETS = 1024
NO_SEQ = -1 << 63

#: The last shown rows of a bucket's runs, by run: run, step (int64) and the metrics (float64, NaN where null).
STATE_SCHEMA = T.StructType([T.StructField(c, T.BinaryType()) for c in ["run_id", "step", *TRACKED]])


def _arrows(cur: np.ndarray, prev: np.ndarray) -> np.ndarray:
    """Trend of each value against the last shown one; none where there was none."""
    cur = np.where(np.isnan(cur), 0.0, cur)
    return np.select([np.isnan(prev), cur < prev, cur > prev], ["", ARROW_DOWN, ARROW_UP], ARROW_FLAT)


def newest_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The row of the highest ``seq`` (nulls lowest) per run of an Arrow batch."""
    for b in batches:
        run, seq = b.column("run_id"), b.column("seq")  # nulls would turn them into floats
        keys = pa.table({"run_id": pc.fill_null(run, 0), "none": pc.is_null(run), "seq": pc.fill_null(seq, NO_SEQ), "at": pa.array(range(b.num_rows))}).to_pandas()
        last = keys.sort_values("seq", kind="stable").drop_duplicates(["run_id", "none"], keep="last")
        yield b.take(pa.array(last["at"].to_numpy()))


def show_latest(key, pdfs, state):
    """applyInPandasWithState function: of each run of a bucket, emit the newest row if
    its step advanced past the last shown step."""
    import pandas as pd

    rows = pd.concat([pdf for pdf in pdfs if len(pdf)] or [pd.DataFrame(columns=["run_id", "seq", "step", *TRACKED])])
    rows = rows.sort_values("seq", kind="stable").drop_duplicates("run_id", keep="last").sort_values("run_id")
    runs, steps = rows["run_id"].to_numpy(np.int64), rows["step"].to_numpy(np.int64)
    cur = {m: rows[m].to_numpy(np.float64) for m in TRACKED}
    old = dict(zip(["run_id", "step", *TRACKED], state.get)) if state.exists else {}
    old_runs, old_steps = (np.frombuffer(old.get(c, b""), np.int64) for c in ("run_id", "step"))
    at = np.searchsorted(old_runs, runs)
    known = np.append(old_runs, 0)[at] == runs if len(old_runs) else np.zeros(len(runs), bool)
    known &= at < len(old_runs)
    before = np.where(known, np.append(old_steps, 0)[at], 0)
    show = steps > before
    if not show.any():
        return
    out = {"run_id": pd.array(runs[show], "Int64"), "seq": pd.array(rows["seq"].to_numpy(np.int64)[show], "Int64"), "step": steps[show]}
    if key[0] < 0:
        out["run_id"][:] = pd.NA
    out["seq"][out["seq"] == NO_SEQ] = pd.NA
    stay = np.ones(len(old_runs), bool)
    stay[at[show & known]] = False
    now = np.concatenate([old_runs[stay], runs[show]])
    order = np.argsort(now, kind="stable")
    kept = [now[order], np.concatenate([old_steps[stay], steps[show]])[order]]
    for m in TRACKED:
        last = np.frombuffer(old.get(m, b""), np.float64)
        out[f"{m}_trend"] = _arrows(cur[m][show], np.where(known, np.append(last, np.nan)[at], np.nan)[show])
        kept.append(np.concatenate([last[stay], cur[m][show]])[order])
    state.update(tuple(x.tobytes() for x in kept))
    yield pd.DataFrame(out)


def monitor_frame(spark: SparkSession, log_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(LOG_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    logs = reader.json(log_dir)
    logs = logs.select("run_id", "seq", "step", *TRACKED)
    logs = logs.mapInArrow(newest_rows, logs.schema)
    bucket = F.when(F.col("run_id").isNull(), -1).otherwise(F.pmod(F.xxhash64("run_id"), F.lit(BUCKETS)).cast("int"))
    # no nulls among the integers: pandas would turn them into floats
    logs = logs.select(bucket.alias("bucket"), F.coalesce("run_id", F.lit(0)).alias("run_id"), F.coalesce("seq", F.lit(NO_SEQ)).alias("seq"),
                       F.coalesce("step", F.lit(0)).alias("step"), *TRACKED)
    return logs.groupBy("bucket").applyInPandasWithState(
        show_latest, OUT_SCHEMA, STATE_SCHEMA, "append", GroupStateTimeout.NoTimeout)


def start_monitor(spark: SparkSession, log_dir: str, out_dir: str, checkpoint: str,
                  interval: str | None = "30 seconds", available_now: bool = False):
    """ST2: poll every ``interval`` (processing-time trigger) or process what
    is available and stop (tests, catch-up).  Output rows land in ``out_dir``."""
    w = (monitor_frame(spark, log_dir).writeStream.format("parquet")
         .option("path", out_dir).option("checkpointLocation", checkpoint).outputMode("append"))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=interval)
    return w.start()
