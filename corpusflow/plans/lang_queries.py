"""Registered language-detection queries: the profile is trained on the
labelled documents (all documents passing F1/F2 with a label) and scores
every document.  Held-out accuracy is measured by the tests, not here."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow.operators.filters import corpus_filters
from corpusflow.operators.language import profile_stats, score_languages, train_profile
from corpusflow.operators.tokens import token_count
from corpusflow.plans import sql as S
from corpusflow.plans.corpus import clean_documents, documents_rows
from corpusflow.plans.registry import register

LANGS = ["de", "en", "es", "fr"]


def training_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = corpus_filters(documents_rows(spark, sf_dir), 50, None)
    return rows.filter(F.col("lang").isNotNull())


def profile(spark: SparkSession, sf_dir: str, materialize: bool = False) -> DataFrame:
    """The trained profile; ``materialize`` writes it once to the shared
    checkpoint folder when it is read several times (stats + scoring)."""
    p = train_profile(training_rows(spark, sf_dir))
    return p.checkpoint() if materialize else p


def _grams(key: str, src: str) -> str:
    return f"""
SELECT {key}, substring(' ' || w || ' ', i, 3) AS gram
FROM (SELECT {key}, w, unnest(generate_series(1, length(w))) AS i
      FROM (SELECT {key}, unnest(regexp_extract_all(text, '{S.PIECE_PATTERN}')) AS w FROM ({src}) s0) s1) s2"""


_TRAIN_SRC = f"SELECT * FROM ({S.filtered_docs_sql(None)}) f WHERE lang IS NOT NULL"
_PROFILE_SQL = (f"SELECT lang, gram, count(*)::BIGINT AS cnt FROM ("
                + _grams("lang", _TRAIN_SRC) + ") g GROUP BY lang, gram")


def _detect_sql(src: str) -> str:
    """Predicted language per doc_id of ``src`` (docs needing >= 10 stripped chars)."""
    scores = ", ".join(
        f"coalesce(sum(lc) FILTER (WHERE lang = '{l}'), 0) - "
        f"g_total * ln((SELECT n FROM tot WHERE lang = '{l}') + (SELECT v FROM nv)) AS s_{l}"
        for l in LANGS)
    pick = "'de'"
    best = "s_de"
    for l in LANGS[1:]:
        pick = f"CASE WHEN s_{l} > {best} THEN '{l}' ELSE {pick} END"
        best = f"greatest(s_{l}, {best})"
    return f"""
WITH p AS ({_PROFILE_SQL}),
tot AS (SELECT lang, sum(cnt) AS n FROM p GROUP BY lang),
nv AS (SELECT count(DISTINCT gram) AS v FROM p),
d AS (SELECT doc_id, text FROM ({src}) s
      WHERE length(regexp_replace(text, '{S.STRIP_PATTERN}', '', 'g')) >= 10),
dg AS ({_grams('doc_id', 'SELECT doc_id, text FROM d')}),
gt AS (SELECT doc_id, count(*) AS g_total FROM dg GROUP BY doc_id),
sc AS (SELECT dg.doc_id, gt.g_total, {scores}
       FROM dg JOIN gt ON dg.doc_id = gt.doc_id
       LEFT JOIN (SELECT gram, lang, ln(cnt + 1.0) AS lc FROM p) pp ON dg.gram = pp.gram
       GROUP BY dg.doc_id, gt.g_total)
SELECT doc_id, {pick} AS pred_lang FROM sc"""


@register("lang_profile", "F4 (train)", _PROFILE_SQL)
def lang_profile(spark, sf_dir):
    return profile(spark, sf_dir)


@register("lang_detect", "F4", f"""
SELECT f.doc_id, f.lang, x.pred_lang
FROM ({S.filtered_docs_sql(None)}) f LEFT JOIN ({_detect_sql(S.filtered_docs_sql(None))}) x
ON f.doc_id = x.doc_id""")
def lang_detect(spark, sf_dir):
    docs = corpus_filters(documents_rows(spark, sf_dir), 50, None).select("doc_id", "lang", "text")
    prof = profile(spark, sf_dir, materialize=True)
    scored = score_languages(docs, ["doc_id"], prof, profile_stats(prof), carry=["lang"])
    return scored.select("doc_id", "lang", "pred_lang")


@register("lang_filter", "F4 F3", f"""
SELECT c.doc_id, len(regexp_extract_all(c.text, '{S.PIECE_PATTERN}'))::BIGINT AS n_tokens
FROM ({S.clean_docs_sql(None)}) c JOIN ({_detect_sql(S.clean_docs_sql(None))}) x ON c.doc_id = x.doc_id
WHERE x.pred_lang = 'de'""")
def lang_filter(spark, sf_dir):
    docs = token_count(clean_documents(spark, sf_dir, language=None).select("doc_id", "text"))
    prof = profile(spark, sf_dir, materialize=True)
    scored = score_languages(docs, ["doc_id"], prof, profile_stats(prof), carry=["n_tokens"])
    return scored.filter(F.col("pred_lang") == "de").select("doc_id", "n_tokens")

