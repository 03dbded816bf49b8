"""Tolerance while reading (S4, A2): what a scan could not read is reported, not lost.

``read_files`` skips files that fail while they are read and reconciles the files
listed with those that gave rows; ``read_lines`` keeps the text of every
log line that is no JSON object.  Both give the rows and a report."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BAD_LINE = "_bad_line"


def read_files(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet", **options) -> tuple[DataFrame, DataFrame]:
    """(rows, report): the rows of the files that can be read, and (file, bytes, n_rows) of
    every file under ``path``, n_rows 0 for one that gave none.

    The report joins a listing (names and lengths, no contents) with one row per
    file of an aggregate over ``_metadata``; it reads no column."""
    rows = spark.read.format(fmt).schema(schema).option("ignoreCorruptFiles", "true").option("recursiveFileLookup", "true").options(**options).load(path)
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select(F.col("path").alias("file"), F.col("length").alias("bytes"))
    seen = rows.select(F.col("_metadata.file_path").alias("file")).groupBy("file").agg(F.count(F.lit(1)).alias("n"))
    # both sides write a file's address their own way: compare from the root on
    root = F.regexp_replace("file", "^[a-z0-9]+:/*", "/")
    report = listed.withColumn("file", root).join(seen.withColumn("file", root), "file", "left")
    return rows, report.select("file", "bytes", F.coalesce("n", F.lit(0)).cast("bigint").alias("n_rows"))


def read_lines(spark: SparkSession, path: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """(rows, bad): the JSON lines that ``schema`` fits, and (file, line) of the others."""
    full = T.StructType([*schema.fields, T.StructField(BAD_LINE, T.StringType())])
    parsed = F.from_json("value", full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD_LINE})
    lines = spark.read.option("recursiveFileLookup", "true").text(path).select(parsed.alias("r"), F.col("_metadata.file_path").alias("file"))
    rows = lines.filter(F.col(f"r.{BAD_LINE}").isNull()).select(*[F.col("r").getField(f.name).alias(f.name) for f in schema.fields])
    return rows, lines.filter(F.col(f"r.{BAD_LINE}").isNotNull()).select("file", F.col(f"r.{BAD_LINE}").alias("line"))
