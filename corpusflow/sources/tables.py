"""The driver's test tables and the source specs that bind them to the corpus
model (documents = main source; conversations, pages, benchmark = extras)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from corpusflow.sources.catalog import SourceSpec


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def documents_spec(sf_dir: str, weight: float = 0.6, filters=None) -> SourceSpec:
    sf_dir = sf_dir.rstrip("/")
    return SourceSpec(name="documents", path=f"{sf_dir}/documents.parquet", weight=weight,
                      order_expr="doc_id", lang_column="lang",
                      filters=tuple(filters) if filters else None)


def corpus_specs(sf_dir: str) -> list[SourceSpec]:
    """Four sources with the reference's default weights 0.6/0.2/0.1/0.05 and a
    fifth that cannot be read (exercises the tolerant scan)."""
    sf_dir = sf_dir.rstrip("/")
    return [
        documents_spec(sf_dir, 0.6),
        SourceSpec(name="conversations", path=f"{sf_dir}/conversations.parquet", weight=0.2,
                   order_expr="conv_id * 1048576 + turn"),
        SourceSpec(name="pages", path=f"{sf_dir}/pages.parquet", weight=0.1,
                   text_column="html", order_expr="page_id"),
        SourceSpec(name="benchmark", path=f"{sf_dir}/benchmark.parquet", weight=0.05,
                   order_expr="item_id"),
        SourceSpec(name="missing", path=f"{sf_dir}/no_such_source.parquet", weight=0.05,
                   order_expr="doc_id"),
    ]
