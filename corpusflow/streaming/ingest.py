"""Incremental corpus ingest (ST3): the corpus filters, exact dedup, tokens
and chunks on a stream of documents.

Three dedup modes:

* ``"batch"`` (default, skew-safe): ``foreachBatch``.  Inside a micro-batch
  the first copy of every text is chosen by the batch dedup (``dedup_first``:
  a partial+final aggregate of the order key, so a text repeated in a third
  of the rows collapses map-side), so the survivor is deterministic: lowest
  (source_ord, doc_ord).  Texts seen in
  earlier micro-batches are removed with a semi join of the digest table
  against the batch's unique digests, broadcast when their count is under a
  limit.  Outputs and digests are written under ``batch_id=<n>``: a retried
  batch overwrites its own files and only reads earlier batches' digests.
* ``"keyed"``: one streaming query with a keyed state (``transformWithStateInPandas``
  on RocksDB): a value per digest, looked up by key, so a micro-batch costs as much as its own texts
  however many came before.  Every task first keeps one copy of a text per
  Arrow batch, so a text that a third of the rows repeat reaches its key a
  few thousand times less often.  Of a text's copies in the micro-batch that brings it, the
  one of the lowest (source_ord, doc_ord) survives; later copies never do.
* ``"state"``: ``dropDuplicates(["h"])`` in the state store, with
  a watermark column ``dropDuplicatesWithinWatermark``, which bounds the state.  Which copy survives
  inside a micro-batch is not defined.

Mixing and the budget need a global order and run on the landed table.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from corpusflow.functions.text import text_digest
from corpusflow.operators.chunks import chunk
from corpusflow.operators.dedup import dedup_first
from corpusflow.operators.filters import corpus_filters
from corpusflow.operators.sizing import broadcast_if_small
from corpusflow.operators.tokens import encode_hashed
from corpusflow.session import path_exists
from corpusflow.sources.catalog import SourceSpec, read_sources

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
MAX_BROADCAST_DIGESTS = 2_000_000
OUT_COLUMNS = ["h", "source", "source_ord", "doc_ord", "chunk_idx", "chunk_len", "chunk"]


def _chunks(rows: DataFrame, min_len: int, max_len: int, target: int) -> DataFrame:
    toks = encode_hashed(rows.drop("lang"))
    return chunk(toks.drop("text"), min_len, max_len, target).select(*OUT_COLUMNS)


def ingest_frame(stream: DataFrame, language: str | None = "de", min_chars: int = 50,
                 min_len: int = 256, max_len: int = 1024, target: int = 512,
                 watermark_col: str | None = None, watermark: str | None = None) -> DataFrame:
    """State-store mode: unified source rows -> chunks of first-seen texts."""
    rows = corpus_filters(stream, min_chars, language).withColumn("h", text_digest(F.col("text")))
    if watermark_col and watermark:
        rows = rows.withWatermark(watermark_col, watermark).dropDuplicatesWithinWatermark(["h"])
    else:
        rows = rows.dropDuplicates(["h"])
    return _chunks(rows, min_len, max_len, target)


FIRST = ["source_ord", "doc_ord"]
PROVIDER = "spark.sql.streaming.stateStore.providerClass"


def _one_copy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first copy of every text of an Arrow batch."""
    for b in batches:
        keys = pd.DataFrame({c: b.column(c).to_pandas() for c in ("h", *FIRST)})
        yield b.take(pa.array(keys.sort_values(FIRST, kind="stable").drop_duplicates("h").index.to_numpy()))


class FirstText(StatefulProcessor):
    """Lets the first copy of a text through, and remembers its digest, the key."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._seen = handle.getValueState("seen", "seen BOOLEAN")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        if self._seen.exists():
            return
        first = None
        for part in rows:
            best = part.sort_values(FIRST, kind="stable").head(1)
            first = best if first is None else pd.concat([first, best]).sort_values(FIRST, kind="stable").head(1)
        if first is not None:
            self._seen.update((True,))
            yield first

    def close(self) -> None:
        pass


def first_texts(rows: DataFrame) -> DataFrame:
    """First copies (by the digest ``h``) of a stream's texts, over all its micro-batches."""
    one = rows.mapInArrow(_one_copy, rows.schema)
    return one.groupBy("h").transformWithStateInPandas(FirstText(), rows.schema, "Append", "None")


def dedup_micro_batch(batch: DataFrame, batch_id: int, seen_dir: str) -> DataFrame:
    """First copies of texts of one micro-batch not seen in earlier batches."""
    spark = batch.sparkSession
    # the batch version of D1: partial aggregate on digests, losers on the
    # unique key, size-checked broadcast anti join (text rows stay in place)
    firsts = dedup_first(batch, ["source_ord", "doc_ord"])
    if path_exists(spark, seen_dir):
        prior = spark.read.parquet(seen_dir).filter(F.col("batch_id") < F.lit(batch_id)).select("h")
        digests = firsts.select("h")
        digests = broadcast_if_small(digests, MAX_BROADCAST_DIGESTS)
        seen_now = prior.join(digests, "h", "left_semi")
        firsts = firsts.join(seen_now, "h", "left_anti")
    return firsts


def _batch_writer(out_dir: str, seen_dir: str, min_len: int, max_len: int, target: int):
    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            firsts = dedup_micro_batch(batch, batch_id, seen_dir).persist()
            _chunks(firsts, min_len, max_len, target).write.mode("overwrite").parquet(
                f"{out_dir}/batch_id={batch_id}")
            firsts.select("h").write.mode("overwrite").parquet(f"{seen_dir}/batch_id={batch_id}")
            firsts.unpersist()
        finally:
            batch.unpersist()
    return write


def start_ingest(spark: SparkSession, specs: list[SourceSpec], out_dir: str, checkpoint: str,
                 language: str | None = "de", available_now: bool = True,
                 interval: str = "1 minute", mode: str = "batch", seen_dir: str | None = None,
                 min_chars: int = 50, min_len: int = 256, max_len: int = 1024, target: int = 512):
    """S3 + S5 on streams: the catalog's sources read with ``readStream``
    (variant: config over subset), unioned, filtered, deduplicated, chunked."""
    stream, _skipped = read_sources(spark, specs, streaming=True, with_lang=True)
    if stream is None:
        raise ValueError(f"no readable source among {[s.name for s in specs]}")
    digested = corpus_filters(stream, min_chars, language).withColumn("h", text_digest(F.col("text")))
    provider = spark.conf.get(PROVIDER, None)
    if mode == "keyed":
        spark.conf.set(PROVIDER, ROCKSDB)  # taken over by the query when it starts
        w = (_chunks(first_texts(digested), min_len, max_len, target).writeStream
             .format("parquet").option("path", out_dir).outputMode("append"))
    elif mode == "state":
        w = (ingest_frame(stream, language, min_chars, min_len, max_len, target).writeStream
             .format("parquet").option("path", out_dir).outputMode("append"))
    elif mode == "batch":
        w = digested.writeStream.foreachBatch(
            _batch_writer(out_dir, seen_dir or f"{checkpoint.rstrip('/')}-seen", min_len, max_len, target))
    else:
        raise ValueError(f"unknown mode {mode}")
    w = w.option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=interval)
    try:
        return w.start()
    finally:
        if mode == "keyed":
            spark.conf.set(PROVIDER, provider) if provider else spark.conf.unset(PROVIDER)
