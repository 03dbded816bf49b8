"""Run-log append (S8) and read.

The reference rewrites the whole JSON file on every append (quadratic I/O).
Here every append is a new set of JSON-lines files in the log directory
(``mode("append")``), which is also what a file stream source can follow.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusflow.operators.ordering import ordinal, range_bucket
from corpusflow.session import path_exists


ARRIVAL = "arrival"
_ROW_BITS = 22  # rows of an append per millisecond since the last one


def stamp_arrival(rows: DataFrame, order: list[str], now_ms: int | None = None) -> DataFrame:
    """Adds ``arrival``: rises with ``order`` (a total order, its first column a number) within
    an append, and from one append to the next, so that the files alone tell the order."""
    base = (int(time.time() * 1000) if now_ms is None else now_ms) << _ROW_BITS
    out = ordinal(rows, [], [F.col(c) for c in order], range_bucket(rows, F.col(order[0])), ARRIVAL, materialize=False)
    return out.withColumn(ARRIVAL, F.lit(base) + F.col(ARRIVAL))


def append_runlog(rows: DataFrame, log_dir: str, order: list[str] | None = None) -> None:
    """Append rows as JSON lines, written where they are, so that one run's rows are not one
    task's; with ``order`` they carry their ``arrival``."""
    out = stamp_arrival(rows, order) if order else rows
    out.write.mode("append").json(log_dir)


def append_runlog_maps(rows: DataFrame, log_dir: str, order: list[str], metrics: str = "metrics", by: str = "run_id") -> None:
    """S8, map form: a line holds the keys of ``metrics`` (MAP<STRING, DOUBLE>), explicit nulls too, the run and ``arrival``."""
    out = stamp_arrival(rows, order)
    own = F.transform_values(metrics, lambda k, v: v.cast("string"))
    keys = F.create_map(F.lit(by), F.col(by).cast("string"), F.lit(ARRIVAL), F.col(ARRIVAL).cast("string"))
    out.select(F.to_json(F.map_concat(own, keys)).alias("value")).write.mode("append").text(log_dir)


def read_runlog(spark: SparkSession, log_dir: str, schema: T.StructType) -> DataFrame:
    """Typed read; an absent log is an empty DataFrame with the schema."""
    if not path_exists(spark, log_dir):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).json(log_dir)


def read_runlog_maps(spark: SparkSession, log_dir: str, key_cols: list[str] = ("run_id",)) -> DataFrame:
    """S9, map form: ``key_cols`` and ``arrival`` (BIGINT, null where a line has none) and the other
    keys of every line as ``metrics`` MAP<STRING, DOUBLE>, so that an absent key
    differs from an explicit null (A1)."""
    keys = [*key_cols, ARRIVAL]
    if not path_exists(spark, log_dir):
        return spark.createDataFrame([], ", ".join([*(f"{k} BIGINT" for k in keys), "metrics MAP<STRING, DOUBLE>"]))
    m = F.from_json("value", T.MapType(T.StringType(), T.StringType()))
    raw = spark.read.text(log_dir).select(m.alias("m"))
    metrics = F.transform_values(F.map_filter("m", lambda k, v: ~k.isin(keys)), lambda k, v: v.cast("double"))
    return raw.select(*[F.col("m")[k].cast("bigint").alias(k) for k in keys], metrics.alias("metrics"))


def read_legacy_array(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """S9 (legacy): a JSON file holding one array of objects -> one row each."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).json(path, multiLine=True)
