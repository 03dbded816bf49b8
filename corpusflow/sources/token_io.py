"""Token dataset sink (S6) and reader.

The sink is a table of chunks (parquet, partitioned by source by default, or
JSON lines) written by the executors; totals come from an aggregate, not
from the driver.

The flat form is one JSON int array.  ``write_flat`` writes it as text parts whose
bytes, in name order, are that array; ``read_flat`` reads such a folder, or a single file, by byte
ranges: a comma ends a record, so a file of any size is split over tasks, and
every id gets its position from its place in the range and the counts of the ranges before.
(``read_legacy_flat`` takes small files whole.)
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusflow.operators.sizing import broadcast_if_small
from corpusflow.session import stored

PART_TOKENS = 1 << 22  # of a part of the flat form: some 25 MB
WHITESPACE = " \t\n\r"
TOKENS_TYPE = T.ArrayType(T.IntegerType())


def write_tokens(df: DataFrame, path: str, fmt: str = "parquet",
                 partition_by: str | None = "source", mode: str = "overwrite") -> None:
    """Write one row per sequence (its ids plus ordering keys)."""
    w = df.write.mode(mode)
    if partition_by and partition_by in df.columns:
        w = w.partitionBy(partition_by)
    w.format(fmt).save(path)


def read_tokens(spark: SparkSession, path: str, fmt: str = "parquet",
                schema: T.StructType | None = None) -> DataFrame:
    """Read a written token table back (schema given for JSON)."""
    r = spark.read.format(fmt)
    if schema is not None:
        r = r.schema(schema)
    return r.load(path)


def read_legacy_flat(spark: SparkSession, path: str) -> DataFrame:
    """S7 (legacy): files holding one flat JSON int array -> (file, tokens).
    ``read.json(multiLine)`` cannot parse a top-level int array; whole-text +
    ``from_json`` can."""
    raw = spark.read.text(path, wholetext=True)
    return raw.select(F.input_file_name().alias("file"),
                      F.from_json("value", TOKENS_TYPE).alias("tokens"))


def write_flat(df: DataFrame, path: str, total_tokens: int, offset_col: str = "offset", tokens_col: str = "chunk", parts: int | None = None) -> None:
    """S6 (flat): rows with their offsets in the stream, as parts of one array.  A row is a
    line; the first opens the array, the one that ends at ``total_tokens`` closes it.
    ``parts`` fixes the number of parts."""
    off, ids = F.col(offset_col), F.col(tokens_col)
    line = F.concat(F.when(off == 0, "[").otherwise(", "), F.array_join(ids, ", "), F.when(off + F.size(ids) == total_tokens, "]").otherwise(""))
    rows = df.filter(F.size(ids) > 0).select(off.alias("at"), line.alias("value"))
    # parts of equally many tokens: their bounds need no pass over the rows
    parts = parts or max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), total_tokens // PART_TOKENS)
    part = F.expr(f"cast(at * {parts} div {max(total_tokens, 1)} as int)")
    rows.repartitionById(parts, part).sortWithinPartitions("at").select("value").write.text(path)


def _line_ids(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """The ids of each line of a flat array."""
    for lines in batches:
        yield pa.array([json.loads(f"[{t.as_py().strip(',[]' + WHITESPACE)}]", parse_float=int) for t in lines], pa.list_(pa.int64()))


def _read_lines(spark: SparkSession, path: str) -> DataFrame:
    raw = spark.read.text(path).select(F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_block_start").alias("start"),
                                       F.monotonically_increasing_id().alias("row"), F.arrow_udf(_line_ids, "array<bigint>")("value").alias("ids"))
    # stored, so that the rows' numbers stay what they are
    lines = stored(raw, "flat-lines")
    ranges = lines.groupBy("file", "start").agg(F.sum(F.size("ids")).alias("n"))
    before = Window.orderBy("file", "start").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    inside = Window.partitionBy("file", "start").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    # lengths alone are ordered; the ids are joined where they are
    places = lines.select("file", "start", "row", F.size("ids").alias("n")).withColumn("nth", F.coalesce(F.sum("n").over(inside), F.lit(0)))
    places = places.join(broadcast_if_small(stored(ranges, "flat-ranges")), ["file", "start"]).select("row", (F.col("before") + F.col("nth")).alias("at"))
    ids = lines.join(places, "row").select("at", F.posexplode("ids").alias("nth", "id"))
    return ids.select((F.col("at") + F.col("nth")).cast("bigint").alias("pos"), "id")


def read_flat(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """S7 (flat): (pos, id) of a flat JSON int array; anything but integers is an error.

    With ``lines`` a line ends at a comma or at the array's end and is of moderate length, as ``write_flat`` writes it: a record
    is then a line and not an id."""
    if lines:
        return _read_lines(spark, path)
    raw = spark.read.option("lineSep", ",").text(path)
    value, plain = F.regexp_replace("value", r"[\[\]\s]", ""), F.col("value").try_cast("bigint")  # blanks around an id need no regex
    ids = raw.select(F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("row"), "value")
    # stored, so that the rows' numbers stay what they are
    ids = stored(ids.filter(plain.isNotNull() | (value != "")).select("file", "start", "row", F.coalesce(plain, value.cast("bigint")).alias("id")), "flat-ids")
    ranges = ids.groupBy("file", "start").agg(F.count(F.lit(1)).alias("n"), F.min("row").alias("first"), F.max("row").alias("last"))
    # a row per byte range of some megabytes
    before = Window.orderBy("file", "start").rowsBetween(Window.unboundedPreceding, -1)
    ranges = stored(ranges.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))), "flat-ranges")
    if not ranges.filter(F.col("last") - F.col("first") >= F.col("n")).isEmpty():  # blanks within a range
        inside = Window.partitionBy("file", "start").orderBy("row")
        ids = ids.withColumn("first", F.lit(0)).withColumn("row", F.row_number().over(inside) - 1)
        ranges = ranges.drop("first")
    # the ids stay where they are
    ids = ids.join(broadcast_if_small(ranges.drop("n", "last")), ["file", "start"])
    return ids.select((F.col("before") + F.col("row") - F.col("first")).cast("bigint").alias("pos"), "id")
