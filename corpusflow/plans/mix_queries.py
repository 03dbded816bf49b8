"""Registered mixing queries: ``documents.source`` (src0..src19) plays the
source catalog with the weight rule w(src_i) = 1 / (1 + i)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow.operators import mixing as M
from corpusflow.operators.dedup import with_digest
from corpusflow.plans import sql as S
from corpusflow.plans.corpus import clean_documents, corpus_chunks, doc_id_bucket
from corpusflow.plans.registry import register
from corpusflow.sources.tables import table

TARGET_TOKENS = 100_000
TARGET_LEN = 512
RACE_SEED = 7


def source_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per source seen in ``documents`` (a grouped, tiny table)."""
    src = table(spark, sf_dir, "documents").groupBy("source").agg(F.count(F.lit(1)).alias("n_docs"))
    idx = F.regexp_extract("source", r"(\d+)$", 1).cast("int")
    return src.select("source", idx.alias("source_ord"),
                      (F.lit(1.0) / (idx + F.lit(1))).alias("weight"))


def _catalog_sql() -> str:
    return """
SELECT source, idx AS source_ord, 1.0::DOUBLE / (idx + 1) AS weight,
       (1.0::DOUBLE / (idx + 1)) / sum(1.0::DOUBLE / (idx + 1)) OVER () AS weight_norm
FROM (SELECT DISTINCT source, regexp_extract(source, '(\\d+)$', 1)::INTEGER AS idx FROM documents) s"""


@register("weights_norm", "M1", f"""
SELECT source, round(weight, 6) AS weight, round(weight_norm, 6) AS weight_norm FROM ({_catalog_sql()}) c""")
def weights_norm(spark, sf_dir):
    w = M.normalize_weights(source_catalog(spark, sf_dir))
    return w.select("source", F.round("weight", 6).alias("weight"),
                    F.round("weight_norm", 6).alias("weight_norm"))


@register("source_caps", "M2 M8", f"""
SELECT source, floor({TARGET_TOKENS}::DOUBLE / {TARGET_LEN}::DOUBLE * weight_norm)::BIGINT AS cap,
       floor({TARGET_TOKENS}::DOUBLE / {TARGET_LEN}::DOUBLE * weight)::BIGINT AS cap_compat
FROM ({_catalog_sql()}) c""")
def source_caps(spark, sf_dir):
    w = M.normalize_weights(source_catalog(spark, sf_dir))
    budget = M.budget_from_subset(None, TARGET_LEN, TARGET_TOKENS)
    a = M.source_caps(w, budget, TARGET_LEN).select("source", "cap")
    b = M.source_caps(w, budget, TARGET_LEN, compat=True).select("source", F.col("cap").alias("cap_compat"))
    return a.join(b, "source")


OVERRIDE = {"src0": 0.25, "src3": 2.0, "src7": 0.0}


def _override_sql() -> str:
    cases = " ".join(f"WHEN '{s}' THEN {w!r}::DOUBLE" for s, w in OVERRIDE.items())
    return f"SELECT source, weight AS configured, CASE source {cases} ELSE weight END AS weight FROM ({_catalog_sql()}) c"


@register("source_caps_override", "M1 M2", f"""
SELECT source, floor({TARGET_TOKENS}::DOUBLE / {TARGET_LEN}::DOUBLE * (weight / sum(weight) OVER ()))::BIGINT AS cap,
       nullif(floor({TARGET_TOKENS}::DOUBLE / {TARGET_LEN}::DOUBLE * configured)::BIGINT, 0) AS cap_compat
FROM ({_override_sql()}) o""")
def source_caps_override(spark, sf_dir):
    """Explicit weights change the caps by normalized weight, not the compat caps."""
    w = M.normalize_weights(source_catalog(spark, sf_dir), OVERRIDE)
    a = M.source_caps(w, TARGET_TOKENS, TARGET_LEN).select("source", "cap")
    b = M.source_caps(w, TARGET_TOKENS, TARGET_LEN, compat=True).select("source", F.col("cap").alias("cap_compat"))
    return a.join(b, "source")


def _chunk_rows(spark, sf_dir) -> DataFrame:
    return (corpus_chunks(spark, sf_dir, language=None)
            .select("source", "doc_id", F.col("chunk_idx").cast("bigint"), "chunk_len"))


def _order():
    return [F.col("doc_id"), F.col("chunk_idx")]


def _src_ord_sql() -> str:
    return f"""
SELECT c.source, c.doc_id, c.chunk_idx, c.chunk_len, k.source_ord, k.weight, k.weight_norm,
       (row_number() OVER (PARTITION BY c.source ORDER BY c.doc_id, c.chunk_idx))::BIGINT AS src_ord
FROM ({S.chunks_sql(None)}) c JOIN ({_catalog_sql()}) k ON c.source = k.source"""


@register("capped_chunks", "M2 M3", f"""
SELECT source, doc_id, chunk_idx, src_ord FROM ({_src_ord_sql()}) o
WHERE src_ord <= floor({TARGET_TOKENS}::DOUBLE / {TARGET_LEN}::DOUBLE * weight_norm)""")
def capped_chunks(spark, sf_dir):
    w = M.normalize_weights(source_catalog(spark, sf_dir))
    caps = M.source_caps(w, TARGET_TOKENS, TARGET_LEN)
    first = M.first_arrivals(_chunk_rows(spark, sf_dir), caps, _order(), doc_id_bucket(spark, sf_dir), "doc_id", mode=None)
    return first.select("source", "doc_id", "chunk_idx", "src_ord")


def _det_sql() -> str:
    return f"""
SELECT *, (row_number() OVER (ORDER BY mix_t, source_ord, doc_id, chunk_idx))::BIGINT AS mix_ord,
       sum(chunk_len) OVER (ORDER BY mix_t, source_ord, doc_id, chunk_idx
                            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)::BIGINT AS mix_cum
FROM (SELECT *, (src_ord - 0.5::DOUBLE) / weight AS mix_t FROM ({_src_ord_sql()}) o) t"""


def _det_mix(spark, sf_dir, target_tokens: int | None = None) -> DataFrame:
    """The interleave in order; with a budget, only as far as that can reach."""
    cat = source_catalog(spark, sf_dir)
    rows = M.catalog_weights(cat)
    arr = M.first_arrivals(_chunk_rows(spark, sf_dir), cat, _order(), doc_id_bucket(spark, sf_dir), "doc_id", target_tokens=target_tokens)
    tie = [F.col("source_ord"), F.col("doc_id"), F.col("chunk_idx")]
    return M.mix_order(arr, M.mix_bucket(rows), tie)


@register("interleave_det", "M4", f"""
SELECT source, doc_id, chunk_idx, mix_ord FROM ({_det_sql()}) d""")
def interleave_det(spark, sf_dir):
    return _det_mix(spark, sf_dir).select("source", "doc_id", "chunk_idx", "mix_ord")


@register("budget_cut", "M4 M5", f"""
SELECT source, doc_id, chunk_idx, mix_ord, mix_cum FROM ({_det_sql()}) d
WHERE mix_cum - chunk_len < {TARGET_TOKENS}""")
def budget_cut(spark, sf_dir):
    return M.budget_cut(_det_mix(spark, sf_dir, TARGET_TOKENS), TARGET_TOKENS).select(
        "source", "doc_id", "chunk_idx", "mix_ord", "mix_cum")


SUBSET_SAMPLES = 120


@register("budget_subset", "M5 M8", f"""
SELECT source, doc_id, chunk_idx, mix_ord, mix_cum FROM ({_det_sql()}) d
WHERE mix_cum - chunk_len < {SUBSET_SAMPLES * TARGET_LEN}""")
def budget_subset(spark, sf_dir):
    """The budget that a number of samples sets in place of the configured one."""
    budget = M.budget_from_subset(SUBSET_SAMPLES, TARGET_LEN, TARGET_TOKENS)
    return M.budget_cut(_det_mix(spark, sf_dir, budget), budget).select(
        "source", "doc_id", "chunk_idx", "mix_ord", "mix_cum")


@register("interleave_race", "M4", f"""
SELECT source, doc_id, chunk_idx, mix_t FROM (
  SELECT source, doc_id, chunk_idx,
         sum(floor(-ln((('0x' || substr(md5(source || ':' || doc_id::VARCHAR || ':' || chunk_idx::VARCHAR
                   || ':' || '{RACE_SEED}'), 1, 12))::BIGINT + 1.0::DOUBLE) / 281474976710657.0::DOUBLE)
             / weight * {M.TIME_UNITS}.0::DOUBLE)::BIGINT)
           OVER (PARTITION BY source ORDER BY doc_id, chunk_idx
                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)::BIGINT::DOUBLE
           / {M.TIME_UNITS}.0::DOUBLE AS mix_t
  FROM ({_src_ord_sql()}) o) r""")
def interleave_race(spark, sf_dir):
    ch = _chunk_rows(spark, sf_dir)
    arr = M.arrivals(ch, source_catalog(spark, sf_dir), _order(), doc_id_bucket(spark, sf_dir),
                     mode="race", seed=RACE_SEED)
    return arr.select("source", "doc_id", "chunk_idx", "mix_t")


@register("split_hash", "M7 D3", f"""
SELECT doc_id, CASE WHEN (('0x' || substr(md5(sha256(text)), 1, 8))::BIGINT % 10000) < 500
                    THEN 'val' ELSE 'train' END AS split
FROM ({S.clean_docs_sql(None)}) c""")
def split_hash(spark, sf_dir):
    docs = with_digest(clean_documents(spark, sf_dir, None))
    return M.split_by_hash(docs).select("doc_id", "split")


# ------------------------------------------------------------- end to end

MIX_BUDGET = 30_000
MIX_LEN = 512


def _windows_sql(stream: str, seq_len: int, stride: int) -> str:
    """Window summaries over a flat stream table (pos, id)."""
    return f"""
WITH t AS ({stream}),
nt AS (SELECT count(*) AS n FROM t),
w AS (SELECT unnest(generate_series(0, (SELECT (n - {seq_len}) // {stride} FROM nt))) AS window_id)
SELECT w.window_id::BIGINT AS window_id, (w.window_id // 16)::BIGINT AS batch_id,
       (w.window_id // 16 // 2)::BIGINT AS update_id,
       (count(*) FILTER (WHERE t.pos < w.window_id * {stride} + {seq_len}))::BIGINT AS x_len,
       (count(*) FILTER (WHERE t.pos > w.window_id * {stride}))::BIGINT AS y_len,
       (sum(t.id) FILTER (WHERE t.pos < w.window_id * {stride} + {seq_len}))::BIGINT AS x_sum,
       (sum(t.id) FILTER (WHERE t.pos > w.window_id * {stride}))::BIGINT AS y_sum
FROM w JOIN t ON t.pos >= w.window_id * {stride} AND t.pos <= w.window_id * {stride} + {seq_len}
GROUP BY w.window_id"""


def _mix_kept_sql(lang: str | None = "de") -> str:
    """Chunks that the training mix keeps."""
    return f"""
SELECT * FROM (
  SELECT *, sum(chunk_len) OVER (ORDER BY mix_t, source_ord, doc_id, chunk_idx
                                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS mix_cum
  FROM (SELECT *, (src_ord - 0.5::DOUBLE) / weight AS mix_t
        FROM (SELECT c.*, k.source_ord, k.weight, k.weight_norm,
                     row_number() OVER (PARTITION BY c.source ORDER BY c.doc_id, c.chunk_idx) AS src_ord
              FROM ({S.chunks_sql(lang)}) c JOIN ({_catalog_sql()}) k ON c.source = k.source
              WHERE c.doc_id IN (SELECT doc_id FROM documents
                                 WHERE (('0x' || substr(md5(sha256(text)), 1, 8))::BIGINT % 10000) >= 500)) o
        WHERE src_ord <= floor({MIX_BUDGET}::DOUBLE / {MIX_LEN}::DOUBLE * weight_norm)) m) mo
WHERE mix_cum - chunk_len < {MIX_BUDGET}"""


def _corpus_mix_sql() -> str:
    stream = f"""
SELECT (mix_cum - chunk_len + k - 1)::BIGINT AS pos, chunk[k] AS id
FROM (SELECT *, unnest(generate_series(1, chunk_len)) AS k FROM ({_mix_kept_sql()}) kk) s"""
    return _windows_sql(stream, MIX_LEN, MIX_LEN)


def _mix_config(**changes):
    from corpusflow.plans.prepare import PrepareConfig
    return PrepareConfig(**{"language": "de", "target_tokens": MIX_BUDGET, "mode": "deterministic", "seq_len": MIX_LEN, "dedup_order": ("doc_ord",)} | changes)


def _window_sums(w: DataFrame) -> DataFrame:
    from corpusflow.plans.corpus_queries import id_sum
    return w.select("window_id", "batch_id", "update_id",
                    F.size("x").cast("bigint").alias("x_len"), F.size("y").cast("bigint").alias("y_len"),
                    id_sum(F.col("x")).alias("x_sum"), id_sum(F.col("y")).alias("y_sum"))


@register("corpus_mix", "S1 F1 F2 F3 D1 M7 T1 C1 C2 M1 M2 M3 M4 M5 C3 C4 C5 C8", _corpus_mix_sql())
def corpus_mix(spark, sf_dir):
    from corpusflow.plans.corpus import documents_rows
    from corpusflow.plans.prepare import prepare
    out = prepare(documents_rows(spark, sf_dir), source_catalog(spark, sf_dir), _mix_config())
    return _window_sums(out.train_windows)


@register("corpus_mix_subword", "T1 C1-C5 C8 M1-M5")
def corpus_mix_subword(spark, sf_dir):
    """``corpus_mix`` with all lengths, budgets and windows counted in subword ids."""
    from corpusflow.operators.subwords import read_merge_table
    from corpusflow.plans.corpus import documents_rows
    from corpusflow.plans.corpus_queries import MERGE_FILE
    from corpusflow.plans.prepare import prepare
    out = prepare(documents_rows(spark, sf_dir), source_catalog(spark, sf_dir), _mix_config(merges=read_merge_table(spark, MERGE_FILE)))
    return _window_sums(out.train_windows)


VALIDATION_SAMPLES, VALIDATION_PAIRS = 10_000, 100


def _validation_sql() -> str:
    mixed = f"""
SELECT *, sum(chunk_len) OVER (ORDER BY mix_t, source_ord, doc_id, chunk_idx ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS mix_cum
FROM (SELECT *, (src_ord - 0.5::DOUBLE) / weight AS mix_t
      FROM (SELECT c.*, k.source_ord, k.weight, k.weight_norm,
                   row_number() OVER (PARTITION BY c.source ORDER BY c.doc_id, c.chunk_idx) AS src_ord
            FROM ({S.chunks_sql(None)}) c JOIN ({_catalog_sql()}) k ON c.source = k.source
            WHERE c.doc_id NOT IN (SELECT doc_id FROM ({_mix_kept_sql(None)}) used)) o
      WHERE src_ord <= floor({VALIDATION_SAMPLES * MIX_LEN}::DOUBLE / {MIX_LEN}::DOUBLE * weight_norm)) m"""
    pairs = f"""
SELECT doc_id, chunk_idx, mix_t, source_ord, (p - 1)::BIGINT AS pair_idx,
       chunk[(p - 1) * {MIX_LEN} + 1 : p * {MIX_LEN}] AS x, chunk[(p - 1) * {MIX_LEN} + 2 : p * {MIX_LEN} + 1] AS y
FROM (SELECT *, unnest(generate_series(1, (chunk_len - 1) // {MIX_LEN})) AS p FROM ({mixed}) mm
      WHERE mix_cum - chunk_len < {VALIDATION_SAMPLES * MIX_LEN} AND chunk_len > {MIX_LEN}) q"""
    return f"""
SELECT doc_id, chunk_idx, pair_idx, (row_number() OVER (ORDER BY mix_t, source_ord, doc_id, chunk_idx, pair_idx))::BIGINT AS sample_ord,
       list_sum(x)::BIGINT AS x_sum, list_sum(y)::BIGINT AS y_sum, len(y)::BIGINT AS y_len
FROM ({pairs}) z ORDER BY mix_t, source_ord, doc_id, chunk_idx, pair_idx LIMIT {VALIDATION_PAIRS}"""


@register("validation_pass", "M7 D3 M2-M5 C6 C7", _validation_sql())
def validation_pass_q(spark, sf_dir):
    """The pass after the training mix: documents that it took part of are out, then an own budget and the first pairs."""
    from corpusflow.plans.corpus import documents_rows
    from corpusflow.plans.corpus_queries import id_sum
    from corpusflow.plans.prepare import prepare, validation_pass
    rows, catalog, cfg = documents_rows(spark, sf_dir), source_catalog(spark, sf_dir), _mix_config(language=None)
    used = prepare(rows, catalog, cfg).consumed
    p = validation_pass(rows, catalog, cfg, used, VALIDATION_SAMPLES, VALIDATION_PAIRS)
    return p.select(F.col("doc_ord").alias("doc_id"), "chunk_idx", "pair_idx", "sample_ord", id_sum(F.col("x")).alias("x_sum"),
                    id_sum(F.col("y")).alias("y_sum"), F.size("y").cast("bigint").alias("y_len"))


def catalog_from_specs(spark: SparkSession, specs) -> DataFrame:
    """The configured catalog (one row per source, including unreadable ones)."""
    return spark.createDataFrame([(s.name, i, float(s.weight)) for i, s in enumerate(specs)],
                                 "source STRING, source_ord INT, weight DOUBLE")


def _mix_sources(spark, sf_dir):
    """All text tables as weighted sources (0.6/0.2/0.1/0.05 + one unreadable),
    language detected by the trigram profile, race interleave, 200k budget."""
    from corpusflow.plans.lang_queries import profile
    from corpusflow.plans.prepare import prepare
    from corpusflow.sources.catalog import read_sources
    from corpusflow.sources.tables import corpus_specs
    specs = corpus_specs(sf_dir)
    rows, _skipped = read_sources(spark, specs, with_lang=True)
    cfg = _mix_config(target_tokens=200_000, mode="race", seed=RACE_SEED, dedup_order=("source_ord", "doc_ord"))
    return prepare(rows, catalog_from_specs(spark, specs), cfg, profile=profile(spark, sf_dir, materialize=True))


@register("corpus_mix_sources", "S1-S5 F1-F4 D1 D2 M7 T1 C1 M1-M5 C3-C5 C8 M6")
def corpus_mix_sources(spark, sf_dir):
    return _mix_sources(spark, sf_dir).report


@register("corpus_mix_windows", "S1-S5 F1-F4 D1 D2 M7 T1 C1 M1-M5 C3-C5 C8")
def corpus_mix_windows(spark, sf_dir):
    """The training windows of ``corpus_mix_sources``, whole."""
    return _mix_sources(spark, sf_dir).train_windows
