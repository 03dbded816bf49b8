"""Registered I/O and streaming queries: token table round trip (S6, S7), run
log append/read round trip (S8, S9), synthetic tokens (S10), the live
monitor (ST1, ST2) and incremental ingest (ST3).  Written tables go to fresh
paths under the shared checkpoint folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusflow.functions.schedule import cosine_with_warmup
from corpusflow.functions.time import epoch_micros_ntz
from corpusflow.operators import runlog as R
from corpusflow.operators.chunks import stream_offsets
from corpusflow.operators.ordering import ordinal, range_bucket
from corpusflow.operators.tokens import token_count
from corpusflow.plans import sql as S
from corpusflow.plans.corpus import clean_documents, corpus_chunks, doc_id_bucket, documents_rows
from corpusflow.plans.corpus_queries import _flat_stream_sql, id_sum
from corpusflow.plans.registry import register
from corpusflow.plans.runlog_queries import (_TPS_SQL, BASE_LR, HORIZON, MIN_LR, WARMUP, _arrow_sql,
                                             _lr_t, _tps_frame, runlog_rows)
from corpusflow.session import shared_path, stored
from corpusflow.sources.catalog import SourceSpec
from corpusflow.sources.runlog_io import append_runlog, append_runlog_maps, read_runlog, read_runlog_maps
from corpusflow.sources.synthetic import synthetic_pieces
from corpusflow.sources.tables import table
from corpusflow.sources.token_io import read_flat, read_tokens, write_flat, write_tokens
from corpusflow.sources.tolerant import read_files, read_lines
from corpusflow.streaming.ingest import start_ingest
from corpusflow.streaming.monitor import LOG_SCHEMA, OUT_SCHEMA, TRACKED, start_monitor

PIECE_LEN = 10 * 512
SYNTH_SEED = 0


@register("token_roundtrip", "S6 S7", f"""
SELECT source, doc_id, chunk_idx, chunk_len, list_sum(chunk)::BIGINT AS id_sum FROM ({S.chunks_sql(None)}) c""")
def token_roundtrip(spark, sf_dir):
    ch = corpus_chunks(spark, sf_dir, language=None).select(
        "source", "doc_id", F.col("chunk_idx").cast("bigint"), "chunk_len", "chunk")
    path = shared_path(spark, "tokens")
    write_tokens(ch, path)
    back = read_tokens(spark, path)
    return back.select("source", "doc_id", "chunk_idx", "chunk_len", id_sum(F.col("chunk")).alias("id_sum"))


FLAT_WINDOW = 512


@register("flat_roundtrip", "S6 S7 C3", f"""
SELECT (pos // {FLAT_WINDOW})::BIGINT AS window_id, count(*)::BIGINT AS n, sum(id)::BIGINT AS id_sum,
       sum(id * (pos % {FLAT_WINDOW} + 1))::BIGINT AS placed_sum
FROM ({_flat_stream_sql()}) t GROUP BY 1""")
def flat_roundtrip(spark, sf_dir):
    """All chunks as one flat JSON array, read back by byte ranges."""
    ch = corpus_chunks(spark, sf_dir, language=None).select("doc_id", "chunk_idx", "chunk_len", "chunk")
    order = [F.col("doc_id"), F.col("chunk_idx")]
    offsets = stored(stream_offsets(ch.drop("chunk"), order, doc_id_bucket(spark, sf_dir)).select("doc_id", "chunk_idx", "offset", "chunk_len"), "offsets")
    total = offsets.agg(F.sum("chunk_len")).first()[0] or 0
    path = shared_path(spark, "flat")
    write_flat(ch.join(offsets.select("doc_id", "chunk_idx", "offset"), ["doc_id", "chunk_idx"]), path, total)
    back = read_flat(spark, path, lines=True)
    at = F.floor(F.col("pos") / FLAT_WINDOW).cast("bigint")
    return back.groupBy(at.alias("window_id")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("id").alias("id_sum"), F.sum(F.col("id") * (F.col("pos") % FLAT_WINDOW + 1)).alias("placed_sum"))


BROKEN_LINE = '{"run_id": 7, "loss": 2.'
_TOLERANT_PARTS = 4


@register("tolerant_scan", "S4 A2", f"""
SELECT 'file' AS kind, 'part=' || (doc_id % {_TOLERANT_PARTS})::VARCHAR AS name, count(*)::BIGINT AS n_rows FROM documents GROUP BY 2
UNION ALL SELECT 'file', 'part=broken', 0
UNION ALL SELECT 'lines', 'read', count(*) FROM events
UNION ALL SELECT 'bad line', '{BROKEN_LINE}', 1""")
def tolerant_scan(spark, sf_dir):
    """Documents with a file among them that is no Parquet, a run log with a line that breaks off: both are named."""
    docs = documents_rows(spark, sf_dir).select("doc_id", "text")
    files, log = shared_path(spark, "tolerant-files"), shared_path(spark, "tolerant-log")
    for k in range(_TOLERANT_PARTS):
        docs.filter(F.col("doc_id") % _TOLERANT_PARTS == k).write.parquet(f"{files}/part={k}")
    spark.range(1).select(F.lit("no parquet").alias("value")).coalesce(1).write.text(f"{files}/part=broken")
    rows, report = read_files(spark, files, docs.schema)
    per_file = report.select(F.lit("file").alias("kind"), F.regexp_extract("file", "(part=[^/]+)/[^/]+$", 1).alias("name"), "n_rows")
    append_runlog(runlog_rows(spark, sf_dir).select("run_id", "loss"), log)
    spark.range(1).select(F.lit(BROKEN_LINE).alias("value")).write.mode("append").text(log)
    good, bad = read_lines(spark, log, T.StructType([T.StructField("run_id", T.LongType()), T.StructField("loss", T.DoubleType())]))
    lines = good.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit("lines").alias("kind"), F.lit("read").alias("name"), "n_rows")
    broken = bad.groupBy(F.col("line").alias("name")).agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit("bad line").alias("kind"), "name", "n_rows")
    return per_file.groupBy("kind", "name").agg(F.sum("n_rows").alias("n_rows")).unionByName(lines).unionByName(broken)


RESUMES = 3
_MAPS_SQL = f"""
SELECT user_id AS run_id, event_id % {RESUMES} AS k, ts, event_id, (event_id % 40 * 10)::BIGINT AS step, event_id % 5 <> 0 AS has_loss,
       CASE WHEN event_id % 7 = 0 THEN NULL ELSE round(value / 100.0::DOUBLE, 9) END AS loss,
       row_number() OVER (PARTITION BY user_id ORDER BY event_id % {RESUMES}, ts, event_id)::BIGINT AS seq FROM events"""


def _map_log(spark, sf_dir) -> DataFrame:
    """A run log of maps written by ``RESUMES`` appends: ``loss`` is absent from every fifth row and null
    in every seventh other, and steps repeat after each resume; read back with ``seq`` from the files alone."""
    e = table(spark, sf_dir, "events")
    step = (F.col("event_id") % 40 * 10).cast("double")
    loss = F.when(F.col("event_id") % 7 == 0, F.lit(None).cast("double")).otherwise(F.round(F.col("value") / 100.0, 9))
    metrics = F.when(F.col("event_id") % 5 == 0, F.create_map(F.lit("step"), step)).otherwise(F.create_map(F.lit("step"), step, F.lit("loss"), loss))
    rows = e.select(F.col("user_id").alias("run_id"), epoch_micros_ntz(F.col("ts")).alias("at"), "event_id", metrics.alias("metrics"))
    log = shared_path(spark, "map-log")
    for k in range(RESUMES):
        append_runlog_maps(rows.filter(F.col("event_id") % RESUMES == k), log, ["at", "event_id"])
    back = stored(read_runlog_maps(spark, log), "map-log-read")
    return ordinal(back, ["run_id"], [F.col("arrival")], range_bucket(back, F.col("arrival")), "seq", materialize=False)


@register("metric_history_map", "A1 S8 S9", f"""
SELECT run_id, seq, step, loss FROM ({_MAPS_SQL}) m WHERE has_loss""")
def metric_history_map(spark, sf_dir):
    h = R.history(_map_log(spark, sf_dir), "loss", map_col="metrics")
    return h.select("run_id", "seq", F.col("metrics")["step"].cast("bigint").alias("step"), F.col("value").alias("loss"))


@register("latest_per_step", "A2 S8 S9", f"""
SELECT run_id, step, count(*)::BIGINT AS n_logged, max(seq) AS seq, arg_max(loss_or, seq) AS loss, arg_max(has_loss, seq) AS has_loss
FROM (SELECT *, CASE WHEN has_loss THEN coalesce(loss, -1.0) ELSE -2.0 END AS loss_or FROM ({_MAPS_SQL}) m) n GROUP BY run_id, step""")
def latest_per_step(spark, sf_dir):
    """The last row of each repeated step; a null loss shows as -1, an absent one as -2."""
    has = F.map_contains_key("metrics", "loss")
    rows = _map_log(spark, sf_dir).select("run_id", "seq", "arrival", F.col("metrics")["step"].cast("bigint").alias("step"), has.alias("has_loss"),
                                          F.when(has, F.coalesce(F.col("metrics")["loss"], F.lit(-1.0))).otherwise(F.lit(-2.0)).alias("loss"))
    return R.latest_per_step(rows, [F.col("arrival")], ["seq", "loss", "has_loss"])


def runlog_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run-log rows as the trainer would log them, with the append they
    belong to (day of month div 10), cut from lineage by a reliable checkpoint."""
    t = _tps_frame(spark, sf_dir)
    t = t.withColumn("learning_rate", cosine_with_warmup(_lr_t(), BASE_LR, WARMUP, HORIZON, MIN_LR))
    rows = t.select("run_id", "seq", "step", F.lit(0).cast("bigint").alias("epoch"), "loss", "perplexity",
                    "learning_rate", "vram_usage", "tokens_per_second",
                    F.floor(F.dayofmonth("ts") / 10).cast("int").alias("append_id"))
    return rows.checkpoint(eager=True)


def _append_ids(rows: DataFrame) -> list[int]:
    return sorted(r[0] for r in rows.select("append_id").distinct().collect())  # a handful of keys


@register("runlog_roundtrip", "S8 S9", f"""
SELECT run_id, count(*)::BIGINT AS n_rows, max(step)::BIGINT AS max_step, round(sum(loss), 6) AS loss_sum,
       count(tokens_per_second)::BIGINT AS n_tps
FROM ({_TPS_SQL}) t GROUP BY run_id""")
def runlog_roundtrip(spark, sf_dir):
    rows = runlog_table(spark, sf_dir)
    log_dir = shared_path(spark, "runlog")
    for k in _append_ids(rows):
        append_runlog(rows.filter(F.col("append_id") == k).drop("append_id"), log_dir)
    back = read_runlog(spark, log_dir, LOG_SCHEMA)
    return back.groupBy("run_id").agg(
        F.count(F.lit(1)).alias("n_rows"), F.max("step").alias("max_step"),
        F.round(F.sum("loss"), 6).alias("loss_sum"), F.count("tokens_per_second").alias("n_tps"))


@register("monitor_stream", "ST1 ST2 W3 W5", f"""
WITH a AS (SELECT *, day(ts) // 10 AS append_id FROM ({_TPS_SQL}) t),
n AS (SELECT * FROM a QUALIFY row_number() OVER (PARTITION BY run_id, append_id ORDER BY seq DESC) = 1),
s AS (SELECT * FROM n WHERE step > 0)
SELECT run_id, seq, step, {', '.join(_arrow_sql(m) for m in TRACKED)} FROM s""")
def monitor_stream(spark, sf_dir):
    rows = runlog_table(spark, sf_dir)
    log_dir, out_dir = shared_path(spark, "monitor-log"), shared_path(spark, "monitor-out")
    ckpt = shared_path(spark, "monitor-ckpt")
    for k in _append_ids(rows):
        append_runlog(rows.filter(F.col("append_id") == k).drop("append_id"), log_dir)
        q = start_monitor(spark, log_dir, out_dir, ckpt, available_now=True)
        q.awaitTermination()
    return spark.read.schema(OUT_SCHEMA).parquet(out_dir)


FEEDS = 3


@register("ingest_stream", "ST3 D1 F1 F2 T1 C1", f"""
SELECT d.h, count(*)::BIGINT AS n_chunks, sum(c.chunk_len)::BIGINT AS chunk_tokens,
       sum(list_sum(c.chunk))::BIGINT AS id_sum, min(d.feed)::BIGINT AS first_feed
FROM ({S.chunks_sql(None)}) c
JOIN (SELECT sha256(text) AS h, min(doc_id % {FEEDS}) AS feed FROM ({S.filtered_docs_sql(None)}) f GROUP BY 1) d
  ON d.h = (SELECT sha256(text) FROM documents WHERE documents.doc_id = c.doc_id)
GROUP BY d.h""")
def ingest_stream(spark, sf_dir):
    """All documents arrive in ``FEEDS`` appends, each at least one micro-batch of its own; copies of a text come in several of them."""
    docs = documents_rows(spark, sf_dir).select("doc_id", "source", "text", "lang")
    landing, out_dir, ckpt = (shared_path(spark, f"ingest-{x}") for x in ("landing", "out", "ckpt"))
    spec = SourceSpec("documents", landing, 1.0, order_expr=f"doc_id % {FEEDS} * {1 << 40} + doc_id", lang_column="lang")
    for feed in range(FEEDS):
        docs.filter(F.col("doc_id") % FEEDS == feed).write.mode("append").parquet(landing)
        start_ingest(spark, [spec], out_dir, ckpt, language=None, mode="keyed").awaitTermination()
    landed = spark.read.schema("h STRING, source STRING, source_ord INT, doc_ord BIGINT, chunk_idx INT, chunk_len BIGINT, chunk ARRAY<INT>").parquet(out_dir)
    return landed.groupBy("h").agg(F.count(F.lit(1)).alias("n_chunks"),
                                   F.sum("chunk_len").cast("bigint").alias("chunk_tokens"),
                                   F.sum(id_sum(F.col("chunk"))).cast("bigint").alias("id_sum"),
                                   F.shiftright(F.min("doc_ord"), 40).cast("bigint").alias("first_feed"))


@register("synthetic_tokens", "S10", f"""
WITH n AS (SELECT sum(len(regexp_extract_all(text, '{S.PIECE_PATTERN}'))) AS n FROM ({S.clean_docs_sql(None)}) c),
p AS (SELECT unnest(generate_series(0, (SELECT n FROM n)::BIGINT - 1)) AS pos)
SELECT (pos // {PIECE_LEN})::BIGINT AS piece_id, count(*)::BIGINT AS n_tokens,
       sum((('0x' || substr(md5('{SYNTH_SEED}:' || pos::VARCHAR), 1, 8))::BIGINT) % 50257)::BIGINT AS id_sum
FROM p GROUP BY 1""")
def synthetic_tokens(spark, sf_dir):
    n = token_count(clean_documents(spark, sf_dir, None)).agg(F.sum("n_tokens")).first()[0] or 0
    pieces = synthetic_pieces(spark, int(n), PIECE_LEN, seed=SYNTH_SEED)
    return pieces.select(F.col("piece_id").cast("bigint"), F.size("tokens").cast("bigint").alias("n_tokens"),
                         id_sum(F.col("tokens")).alias("id_sum"))
