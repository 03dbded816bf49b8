"""Registered corpus queries over ``documents`` and the extra text tables:
filters, dedup, union of sources, tokens, vocabulary, chunks, pairs, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow.functions.text import STRIP_PATTERN, stripped_length
from corpusflow.operators import chunks as C
from corpusflow.operators.dedup import dedup_first
from corpusflow.operators.filters import corpus_filters, keep_nonempty
from corpusflow.operators.subwords import encode_subwords, read_merge_table
from corpusflow.operators.tokens import build_vocab, encode_vocab
from corpusflow.plans import sql as S
from corpusflow.plans.corpus import (DEFAULT, chunks, clean_documents, corpus_chunks, doc_id_bucket,
                                     documents_rows, mix_report, tokenized)
from corpusflow.plans.registry import register
from corpusflow.session import stored
from corpusflow.sources.catalog import read_sources
from corpusflow.sources.tables import corpus_specs, documents_spec, table

SMALL_VOCAB = 4096
#: A public byte-level merge table; never copied into this repository.
MERGE_FILE = "/opt/tokenizers/byte_bpe_50k.tiktoken"
PACK_LEN, PACK_STRIDE = 512, 384
PAIR_LEN = 512
CAPPED_PAIRS = 100
BATCH, ACCUM = 16, 2


def id_sum(arr) -> F.Column:
    return F.aggregate(arr, F.lit(0).cast("bigint"), lambda acc, x: acc + x.cast("bigint"))


# --------------------------------------------------------------------- filters

@register("corpus_by_source", "S5 F1 F2 F3 D1 T1 C1 C2 M6", f"""
SELECT source, count(*)::BIGINT AS n_chunks, sum(chunk_len)::BIGINT AS n_tokens,
       (count(*) FILTER (WHERE chunk_idx = 0))::BIGINT AS n_docs,
       round(sum(chunk_len) / sum(sum(chunk_len)) OVER (), 6) AS token_share
FROM ({S.chunks_sql('de')}) c GROUP BY source""")
def corpus_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_report(corpus_chunks(spark, sf_dir, language="de"))


@register("nonempty", "F1", """
SELECT doc_id, source FROM documents WHERE text IS NOT NULL AND text <> ''""")
def nonempty_q(spark, sf_dir):
    return keep_nonempty(table(spark, sf_dir, "documents")).select("doc_id", "source")


@register("min_chars", "F1 F2 X5", f"""
SELECT doc_id, length(regexp_replace(text, '{STRIP_PATTERN}', '', 'g'))::BIGINT AS stripped_len
FROM ({S.filtered_docs_sql(None)}) f""")
def min_chars_q(spark, sf_dir):
    rows = corpus_filters(documents_rows(spark, sf_dir), 50, None)
    return rows.select("doc_id", stripped_length(F.col("text")).cast("bigint").alias("stripped_len"))


@register("dedup_first_wins", "D1 D2", f"""
SELECT doc_id, source, lang FROM ({S.clean_docs_sql(None, True)}) c""")
def dedup_first_wins(spark, sf_dir):
    return clean_documents(spark, sf_dir, language=None, dedup=True).select("doc_id", "source", "lang")


@register("dedup_off", "D4", f"""
SELECT doc_id, source, lang FROM ({S.clean_docs_sql(None, False)}) c""")
def dedup_off(spark, sf_dir):
    return clean_documents(spark, sf_dir, language=None, dedup=False).select("doc_id", "source", "lang")


@register("dedup_cross_source", "D1 D2", f"""
WITH f AS ({S.filtered_docs_sql(None)}),
g AS (SELECT source, count(*) AS n FROM f WHERE doc_id IN
      (SELECT min(doc_id) FROM f GROUP BY sha256(text)) GROUP BY source),
p AS (SELECT source, count(*) AS n FROM f WHERE doc_id IN
      (SELECT min(doc_id) FROM f GROUP BY source, sha256(text)) GROUP BY source)
SELECT p.source, coalesce(g.n, 0)::BIGINT AS kept_global, p.n::BIGINT AS kept_per_source
FROM p LEFT JOIN g ON p.source = g.source""")
def dedup_cross_source(spark, sf_dir):
    rows = corpus_filters(documents_rows(spark, sf_dir), 50, None)
    glob = dedup_first(rows, ["doc_id"]).groupBy("source").agg(F.count(F.lit(1)).alias("kept_global"))
    per = (dedup_first(rows, ["doc_id"], per_source=True).groupBy("source")
           .agg(F.count(F.lit(1)).alias("kept_per_source")))
    return (per.join(glob, "source", "left")
            .select("source", F.coalesce("kept_global", F.lit(0)).cast("bigint").alias("kept_global"),
                    F.col("kept_per_source").cast("bigint")))


@register("union_sources", "S1 S2 S4 S5 F8", """
SELECT source, count(*)::BIGINT AS n_rows, (count(*) FILTER (WHERE text <> ''))::BIGINT AS n_nonempty,
       sum(length(text))::BIGINT AS n_chars
FROM (SELECT 'documents' AS source, coalesce(text, '') AS text FROM documents
      UNION ALL SELECT 'conversations', coalesce(text, '') FROM conversations
      UNION ALL SELECT 'pages', coalesce(html, '') FROM pages
      UNION ALL SELECT 'benchmark', coalesce(text, '') FROM benchmark) u
GROUP BY source""")
def union_sources(spark, sf_dir):
    union, _skipped = read_sources(spark, corpus_specs(sf_dir))
    return union.groupBy("source").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col("text") != "").alias("n_nonempty"),
        F.sum(F.length("text")).cast("bigint").alias("n_chars"))


@register("source_filters", "F5", """
SELECT lang, count(*)::BIGINT AS n_rows FROM documents WHERE lang IN ('de', 'fr') GROUP BY lang""")
def source_filters(spark, sf_dir):
    union, _ = read_sources(spark, [documents_spec(sf_dir, filters=("de", "fr"))], with_lang=True)
    return union.groupBy("lang").agg(F.count(F.lit(1)).alias("n_rows"))


# ---------------------------------------------------------------------- tokens

@register("token_counts", "T1 T3", f"""
SELECT doc_id, len(tokens)::BIGINT AS n_tokens FROM ({S.tokens_sql(None)}) t""")
def token_counts(spark, sf_dir):
    return tokenized(clean_documents(spark, sf_dir, None)).select("doc_id", "n_tokens")


@register("token_ids", "T1 T2(hashed)", f"""
SELECT doc_id, len(tokens)::BIGINT AS n_tokens, coalesce(list_sum(tokens), 0)::BIGINT AS id_sum,
       tokens[1] AS first_id, tokens[-1] AS last_id
FROM ({S.tokens_sql(None)}) t""")
def token_ids(spark, sf_dir):
    t = tokenized(clean_documents(spark, sf_dir, None))
    return t.select("doc_id", "n_tokens", id_sum(F.col("tokens")).alias("id_sum"),
                    F.get("tokens", 0).alias("first_id"),
                    F.get("tokens", F.size("tokens") - 1).alias("last_id"))


_PIECES_SQL = f"""
SELECT doc_id, regexp_extract_all(text, '{S.PIECE_PATTERN}') AS ps FROM ({S.clean_docs_sql(None)}) c"""

_VOCAB_SQL = f"""
SELECT piece, id, cnt FROM (
  SELECT piece, (row_number() OVER (ORDER BY cnt DESC, piece))::INTEGER AS id, cnt
  FROM (SELECT piece, count(*)::BIGINT AS cnt
        FROM (SELECT unnest(ps) AS piece FROM ({_PIECES_SQL}) a) b GROUP BY piece) c) d
WHERE id <= {SMALL_VOCAB - 1}"""


@register("token_ids_subword", "T1 T3")
def token_ids_subword(spark, sf_dir):
    """Subword ids of every document (null texts are empty)."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    t = encode_subwords(docs, read_merge_table(spark, MERGE_FILE))
    return t.select("doc_id", "n_tokens", id_sum(F.col("tokens")).alias("id_sum"), F.get("tokens", 0).alias("first_id"),
                    F.get("tokens", F.size("tokens") - 1).alias("last_id"), F.sha2(F.array_join("tokens", ","), 256).alias("ids_sha256"))


@register("vocab_topk", "T2", _VOCAB_SQL)
def vocab_topk(spark, sf_dir):
    return build_vocab(clean_documents(spark, sf_dir, None), SMALL_VOCAB)


@register("vocab_encode", "T1 T2", f"""
WITH v AS ({_VOCAB_SQL}),
e AS (SELECT doc_id, unnest(ps) AS piece FROM ({_PIECES_SQL}) a)
SELECT d.doc_id, count(e.piece)::BIGINT AS n_tokens,
       (count(e.piece) FILTER (WHERE e.piece IS NOT NULL AND v.id IS NULL))::BIGINT AS n_unknown,
       coalesce(sum(v.id), 0)::BIGINT AS id_sum
FROM ({S.clean_docs_sql(None)}) d LEFT JOIN e ON d.doc_id = e.doc_id
LEFT JOIN v ON e.piece = v.piece
GROUP BY d.doc_id""")
def vocab_encode(spark, sf_dir):
    docs = clean_documents(spark, sf_dir, None)
    vocab = build_vocab(docs, SMALL_VOCAB)
    enc = encode_vocab(docs.select("doc_id", "text"), vocab, key=["doc_id"])
    return enc.select("doc_id", "n_tokens",
                      F.size(F.filter("tokens", lambda x: x == 0)).cast("bigint").alias("n_unknown"),
                      id_sum(F.col("tokens")).alias("id_sum"))


# ---------------------------------------------------------------------- chunks

@register("chunk_windows", "C1 C2 F6 F7", f"""
SELECT doc_id, chunk_idx, chunk_start::BIGINT AS chunk_start, chunk_len::BIGINT AS chunk_len,
       list_sum(chunk)::BIGINT AS id_sum
FROM ({S.chunks_sql(None)}) c""")
def chunk_windows(spark, sf_dir):
    ch = corpus_chunks(spark, sf_dir, language=None)
    return ch.select("doc_id", F.col("chunk_idx").cast("bigint"),
                     F.col("chunk_start").cast("bigint"), "chunk_len", id_sum(F.col("chunk")).alias("id_sum"))


def _pairs_sql(extra: int = 0) -> str:
    return f"""
SELECT doc_id, chunk_idx, pair_idx, pair_start,
       chunk[pair_start + 1 : pair_start + {PAIR_LEN}] AS x,
       chunk[pair_start + 2 : pair_start + {PAIR_LEN} + 1] AS y
FROM (SELECT doc_id, chunk_idx, chunk, (p - 1)::BIGINT AS pair_idx, ((p - 1) * {PAIR_LEN})::BIGINT AS pair_start
      FROM (SELECT *, unnest(generate_series(1, ceil((chunk_len - {PAIR_LEN}) / {PAIR_LEN})::BIGINT)) AS p
            FROM ({S.chunks_sql(None, extra=extra)}) c WHERE chunk_len > {PAIR_LEN}) a) b"""


def _pair_summary_sql(src: str) -> str:
    return f"""
SELECT doc_id, chunk_idx, pair_idx, len(x)::BIGINT AS x_len, len(y)::BIGINT AS y_len,
       list_sum(x)::BIGINT AS x_sum, list_sum(y)::BIGINT AS y_sum FROM ({src}) s"""


def _pairs(spark, sf_dir) -> DataFrame:
    ch = corpus_chunks(spark, sf_dir, language=None)
    return C.pairs_per_chunk(ch, PAIR_LEN)


def _pair_summary(df: DataFrame) -> DataFrame:
    return df.select("doc_id", F.col("chunk_idx").cast("bigint"), F.col("pair_idx").cast("bigint"),
                     F.size("x").cast("bigint").alias("x_len"), F.size("y").cast("bigint").alias("y_len"),
                     id_sum(F.col("x")).alias("x_sum"), id_sum(F.col("y")).alias("y_sum"))


@register("pairs_per_chunk", "C5 C6", _pair_summary_sql(_pairs_sql()))
def pairs_per_chunk(spark, sf_dir):
    return _pair_summary(_pairs(spark, sf_dir))


@register("pairs_wider_windows", "C2 C5 C6 Q6", _pair_summary_sql(_pairs_sql(extra=1)))
def pairs_wider_windows(spark, sf_dir):
    """Windows of a token more than the pair length: long documents give pairs too."""
    docs = tokenized(clean_documents(spark, sf_dir, None)).drop("text")
    wide = C.chunk(docs, DEFAULT.min_length, DEFAULT.max_length, DEFAULT.target_length, extra=1)
    return _pair_summary(C.pairs_per_chunk(wide, PAIR_LEN))


@register("pairs_capped", "C5 C6 C7", _pair_summary_sql(
    f"SELECT * FROM ({_pairs_sql()}) p ORDER BY doc_id, chunk_idx, pair_idx LIMIT {CAPPED_PAIRS}"))
def pairs_capped(spark, sf_dir):
    """The pairs are chosen by keys and lengths; only their documents are encoded."""
    docs = clean_documents(spark, sf_dir, None)
    keys = chunks(tokenized(docs).drop("text")).select("doc_id", "chunk_idx", "chunk_len")
    picked = stored(C.first_pairs(keys, ["doc_id", "chunk_idx"], PAIR_LEN, CAPPED_PAIRS), "picked-pairs")
    own = docs.join(F.broadcast(picked.select("doc_id").distinct()), "doc_id", "left_semi")  # at most CAPPED_PAIRS
    built = chunks(tokenized(own).drop("text")).select("doc_id", "chunk_idx", "chunk")
    return _pair_summary(C.pair_arrays(picked.join(built, ["doc_id", "chunk_idx"]), PAIR_LEN))


@register("batches", "C8", f"""
SELECT doc_id, chunk_idx, pair_idx, sample_ord,
       ((sample_ord - 1) // {BATCH})::BIGINT AS batch_id,
       (((sample_ord - 1) // {BATCH}) // {ACCUM})::BIGINT AS update_id
FROM (SELECT doc_id, chunk_idx, pair_idx,
             (row_number() OVER (ORDER BY doc_id, chunk_idx, pair_idx))::BIGINT AS sample_ord
      FROM ({_pairs_sql()}) p) q""")
def batches(spark, sf_dir):
    p = _pairs(spark, sf_dir).select("doc_id", F.col("chunk_idx").cast("bigint"),
                                     F.col("pair_idx").cast("bigint"))
    out = C.assign_batches(p, [], [F.col("doc_id"), F.col("chunk_idx"), F.col("pair_idx")],
                           doc_id_bucket(spark, sf_dir), BATCH, ACCUM)
    return out.select("doc_id", "chunk_idx", "pair_idx", "sample_ord", "batch_id", "update_id")


def _flat_stream_sql() -> str:
    """Token positions of all chunks concatenated in (doc_id, chunk_idx) order."""
    return f"""
SELECT (off + k - 1)::BIGINT AS pos, chunk[k] AS id
FROM (SELECT chunk, coalesce(sum(chunk_len) OVER (ORDER BY doc_id, chunk_idx
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS off,
             unnest(generate_series(1, chunk_len)) AS k
      FROM ({S.chunks_sql(None)}) c) s"""


@register("pack_flat", "C3 C4 C5", f"""
WITH t AS ({_flat_stream_sql()}),
nt AS (SELECT count(*) AS n FROM t),
w AS (SELECT unnest(generate_series(0, (SELECT (n - {PACK_LEN}) // {PACK_STRIDE} FROM nt))) AS window_id)
SELECT w.window_id::BIGINT AS window_id,
       (count(*) FILTER (WHERE t.pos < w.window_id * {PACK_STRIDE} + {PACK_LEN}))::BIGINT AS x_len,
       (count(*) FILTER (WHERE t.pos > w.window_id * {PACK_STRIDE}))::BIGINT AS y_len,
       (sum(t.id) FILTER (WHERE t.pos < w.window_id * {PACK_STRIDE} + {PACK_LEN}))::BIGINT AS x_sum,
       (sum(t.id) FILTER (WHERE t.pos > w.window_id * {PACK_STRIDE}))::BIGINT AS y_sum,
       arg_min(t.id, t.pos) AS x_first, arg_max(t.id, t.pos) AS z_last
FROM w JOIN t ON t.pos >= w.window_id * {PACK_STRIDE} AND t.pos <= w.window_id * {PACK_STRIDE} + {PACK_LEN}
GROUP BY w.window_id""")
def pack_flat(spark, sf_dir):
    ch = corpus_chunks(spark, sf_dir, language=None)
    order = [F.col("doc_id"), F.col("chunk_idx")]
    # offsets are computed on narrow rows (no ids), the arrays joined on the unique key (never broadcast)
    keys = ch.select("doc_id", "chunk_idx", "chunk_len")
    with_off = C.stream_offsets(keys, order, doc_id_bucket(spark, sf_dir))
    total = with_off.agg(F.sum("chunk_len")).first()[0] or 0
    stream = with_off.join(ch.select("doc_id", "chunk_idx", "chunk").hint("merge"), ["doc_id", "chunk_idx"])
    w = C.pack_windows(stream, int(total), PACK_LEN, PACK_STRIDE)
    z_last = F.coalesce(F.get("y", F.size("y") - 1), F.get("x", F.size("x") - 1))
    return w.select("window_id", F.size("x").cast("bigint").alias("x_len"),
                    F.size("y").cast("bigint").alias("y_len"),
                    id_sum(F.col("x")).alias("x_sum"), id_sum(F.col("y")).alias("y_sum"),
                    F.get("x", 0).alias("x_first"), z_last.alias("z_last"))


@register("pretoken_counts", "T1(b) T3")
def pretoken_counts(spark, sf_dir):
    """Byte-level pre-split piece count per document (published look-ahead
    pattern: Java regex only, so no SQL oracle; tests compare it with the
    Python ``regex`` module)."""
    from corpusflow.functions.text import BYTE_LEVEL_PATTERN
    from corpusflow.operators.tokens import token_count
    docs = keep_nonempty(table(spark, sf_dir, "documents")).select("doc_id", "text")
    return token_count(docs, pattern=BYTE_LEVEL_PATTERN).select("doc_id", "n_tokens")
