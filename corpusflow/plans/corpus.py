"""Corpus preparation plans: source rows -> filtered, deduplicated, tokenized,
chunked rows.  Each function returns a lazy DataFrame; nothing is collected.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusflow.operators.chunks import chunk
from corpusflow.operators.dedup import dedup_first
from corpusflow.operators.filters import corpus_filters
from corpusflow.operators.ordering import range_bucket
from corpusflow.operators.tokens import DEFAULT_VOCAB, encode_hashed
from corpusflow.sources.tables import table


@dataclass(frozen=True)
class Thresholds:
    """Token thresholds of the chunker and the character minimum of F2."""
    min_length: int = 256
    max_length: int = 1024
    target_length: int = 512
    min_chars: int = 50


DEFAULT = Thresholds()


def documents_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` in the unified row shape; ``source`` is the weighted source."""
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", F.col("doc_id").alias("doc_ord"), "source",
                    F.regexp_extract("source", r"(\d+)$", 1).cast("int").alias("source_ord"),
                    "text", "lang")


def doc_id_bucket(spark: SparkSession, sf_dir: str) -> "F.Column":
    """Bucket of doc_id for ordered scans, from the range of the base table
    (a one-column scan) rather than of a derived, expensive frame."""
    return range_bucket(table(spark, sf_dir, "documents"), F.col("doc_id"))


def clean_documents(spark: SparkSession, sf_dir: str, language: str | None = "de",
                    dedup: bool = True, th: Thresholds = DEFAULT) -> DataFrame:
    """F1 -> F2 -> F3 (supplied lang) -> D1 over all sources, first by doc_id."""
    rows = corpus_filters(documents_rows(spark, sf_dir), th.min_chars, language)
    return dedup_first(rows, order_cols=["doc_id"], enabled=dedup)


def tokenized(df: DataFrame, vocab_size: int = DEFAULT_VOCAB) -> DataFrame:
    return encode_hashed(df, "text", vocab_size)


def chunks(df: DataFrame, th: Thresholds = DEFAULT) -> DataFrame:
    return chunk(df, th.min_length, th.max_length, th.target_length)


def corpus_chunks(spark: SparkSession, sf_dir: str, language: str | None = "de",
                  dedup: bool = True, th: Thresholds = DEFAULT) -> DataFrame:
    """The minimum slice: documents -> filters -> dedup -> tokens -> chunks."""
    docs = tokenized(clean_documents(spark, sf_dir, language, dedup, th))
    return chunks(docs.drop("text"), th)


def mix_report(chunk_rows: DataFrame) -> DataFrame:
    """M6: chunks, tokens and token share per source (partial + final agg)."""
    per = chunk_rows.groupBy("source").agg(
        F.count(F.lit(1)).alias("n_chunks"),
        F.sum("chunk_len").cast("bigint").alias("n_tokens"),
        # every document with chunks has exactly one chunk_idx 0: no distinct agg
        F.count_if(F.col("chunk_idx") == 0).alias("n_docs"))
    # the per-source result has one row per source: a whole-table window is bounded
    share = F.round(F.col("n_tokens") / F.sum("n_tokens").over(Window.partitionBy()), 6)
    return per.select("source", "n_chunks", "n_tokens", F.col("n_docs").cast("bigint"),
                      share.alias("token_share"))
