"""Source catalog (S1), batch and streaming scans (S2, S3), tolerant scan (S4),
multi-source union (S5) and text-column projection (F8)."""

from __future__ import annotations

import logging
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

log = logging.getLogger(__name__)

CATALOG_SCHEMA = T.StructType([
    T.StructField("name", T.StringType(), False),
    T.StructField("path", T.StringType(), False),
    T.StructField("weight", T.DoubleType(), False),
    T.StructField("streaming", T.BooleanType(), True),
    T.StructField("subset", T.StringType(), True),
    T.StructField("config", T.StringType(), True),
    T.StructField("filters", T.ArrayType(T.StringType()), True),
    T.StructField("text_column", T.StringType(), True),
])

# Unified row of every source after S5.
UNION_COLUMNS = ["source", "source_ord", "doc_ord", "text"]


class SourceError(ValueError):
    """A source that is declared in a way that would give wrong rows."""


@dataclass(frozen=True)
class SourceSpec:
    """One weighted text source (DM1) plus how to read and order it."""
    # Names and defaults of the fields up to text_column.
    name: str
    path: str
    weight: float
    streaming: bool = True
    subset: str | None = None
    config: str | None = None
    filters: tuple[str, ...] | None = None
    text_column: str = "text"
    format: str = "parquet"
    # SQL expression giving the arrival order inside the source (BIGINT), different
    # for every row; required, as equal orders leave first-wins dedup undefined.
    order_expr: str | None = None
    # Column holding a per-row language label, used by ``filters``.
    lang_column: str | None = None
    options: dict = field(default_factory=dict, hash=False)

    def __post_init__(self):
        if not self.order_expr or self.order_expr.strip().lstrip("-").isdigit():
            raise SourceError(f"source {self.name} needs an order_expr that tells its rows apart")
        if self.filters and not self.lang_column:
            raise SourceError(f"source {self.name} has filters but no lang_column")

    def variant(self, streaming: bool) -> str | None:
        """Batch reads use ``config``; streaming reads prefer config over subset."""
        if streaming:
            return self.config or self.subset
        return self.config

    def location(self, streaming: bool) -> str:
        v = self.variant(streaming)
        return f"{self.path.rstrip('/')}/{v}" if v else self.path


def catalog_frame(spark: SparkSession, specs: list[SourceSpec]) -> DataFrame:
    """The catalog as a tiny DataFrame (one row per source)."""
    rows = [(s.name, s.path, float(s.weight), s.streaming, s.subset, s.config,
             list(s.filters) if s.filters else None, s.text_column) for s in specs]
    return spark.createDataFrame(rows, CATALOG_SCHEMA)


def _project(df: DataFrame, spec: SourceSpec, source_ord: int) -> DataFrame:
    if spec.filters:
        if spec.lang_column not in df.columns:
            raise SourceError(f"source {spec.name} is filtered by {spec.lang_column}, which it lacks")
        # a source-level predicate; Catalyst pushes IN into the parquet scan.
        df = df.filter(F.col(spec.lang_column).isin(list(spec.filters)))
    if spec.text_column in df.columns:
        text = F.coalesce(F.col(spec.text_column).cast("string"), F.lit(""))
    else:
        log.warning("source %s has no column %s; it contributes no rows",
                    spec.name, spec.text_column)
        text = F.lit("")
        df = df.filter(F.lit(False))  # valid on batch and streaming frames
    cols = [F.lit(spec.name).alias("source"), F.lit(source_ord).alias("source_ord"),
            F.expr(spec.order_expr).cast("bigint").alias("doc_ord"), text.alias("text")]
    if spec.lang_column and spec.lang_column in df.columns:
        cols.append(F.col(spec.lang_column).alias("lang"))
    return df.select(*cols)


def stream_path(spark: SparkSession, path: str) -> str:
    """The file stream source follows directories or globs; a single file is
    turned into a glob that matches exactly that file."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(hpath) and fs.getFileStatus(hpath).isFile():
        head, name = path.rsplit("/", 1)
        return f"{head}/{name[:-1]}[{name[-1]}]"
    return path


def read_source(spark: SparkSession, spec: SourceSpec, source_ord: int = 0,
                streaming: bool = False) -> DataFrame:
    """Scan one source; analysis errors propagate (see ``read_sources``)."""
    where = spec.location(streaming)
    if streaming:
        schema = spark.read.format(spec.format).options(**spec.options).load(where).schema
        df = (spark.readStream.format(spec.format).options(**spec.options)
              .schema(schema).load(stream_path(spark, where)))
    else:
        df = spark.read.format(spec.format).options(**spec.options).load(where)
    return _project(df, spec, source_ord)


def read_sources(spark: SparkSession, specs: list[SourceSpec], streaming: bool = False,
                 with_lang: bool = False) -> tuple[DataFrame | None, list[str]]:
    """Tolerant multi-source union (S4 + S5).

    A source whose read fails at analysis time (missing path, bad format) is
    reported and contributes no rows; the survivors are unioned by name.
    Returns (union or None when nothing could be read, skipped source names).
    """
    frames, skipped = [], []
    for i, spec in enumerate(specs):
        try:
            df = read_source(spark, spec, i, streaming)
            df.schema  # force analysis inside the try
        except SourceError:
            raise
        except Exception as exc:  # noqa: BLE001 - any read failure skips the source
            log.warning("failed to load source %s: %s", spec.name, str(exc).splitlines()[0])
            skipped.append(spec.name)
            continue
        if with_lang and "lang" not in df.columns:
            df = df.withColumn("lang", F.lit(None).cast("string"))
        frames.append(df if with_lang else df.select(*UNION_COLUMNS))
    if not frames:
        return None, skipped
    out = frames[0]
    for df in frames[1:]:
        out = out.unionByName(df)
    return out, skipped
