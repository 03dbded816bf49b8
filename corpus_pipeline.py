"""Corpus pipeline: five stages over ``documents``, each by one operator of ``corpusflow.llm``.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and
returns a frame, which is written as Parquet and read again as the next one's
``docs``.  All but the last return the columns of ``documents``, further ones included.

Defined results: an empty ``documents`` gives an empty result, an empty ``benchmark``
takes no document; null and empty texts have no language and go with the first stage; rows
with a null id stay or go like others, and repeated rows are near copies, of which one stays.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow.llm.common import read_table, stored
from corpusflow.llm.decontam import decontaminate
from corpusflow.llm.langid import accepted_documents
from corpusflow.llm.line_dedup import dedup_lines
from corpusflow.llm.near_dups import deduplicate
from corpusflow.llm.pieces import sample


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known; the others go."""
    return accepted_documents(docs, docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated line runs are deleted; texts of which nothing is left go."""
    gone = next(name for name in (f"deleted{'_' * i}" for i in range(len(docs.columns) + 1)) if name not in docs.columns)
    out = dedup_lines(docs, key="doc_id", text="text", drop_empty=True, deleted_lines=gone)
    length = F.length("text").cast(docs.schema["n_chars"].dataType)
    return out.withColumn("n_chars", F.when(F.col(gone) > 0, length).otherwise(F.col("n_chars"))).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return deduplicate(docs, key="doc_id", text="text")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark items go."""
    return decontaminate(docs, read_table(spark, sf_dir, "benchmark"), key="doc_id", text="text", item="item_id", item_text="text")


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sampled segmentations of every text that is left."""
    return sample(docs, key="doc_id", text="text")


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("pieces", pieces),
]

#: SQL can't express the stages; the tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to the whole ``documents`` table."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
