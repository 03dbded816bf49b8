"""Language identification by Bayesian evidence fusion.

The posterior of a language multiplies four kinds of evidence:

* the text: byte n-gram likelihoods of the whole text, tempered to at most
  ``MAX_GRAMS`` independent n-grams; an ``und`` class that finds all n-grams
  equally likely stands for everything that wasn't learned;
* the language that the markup declares, by how often documents of each
  text language declare it;
* the address suffix, by the same count;
* the host: a prior smoothed from the host's counts towards its parent
  domain's and from there towards the corpus's.  A row's own count is left out.

All counts are grouped aggregates over the whole corpus; only the n-gram
model is fitted on a bounded sample, at most ``max_train`` labelled rows per
language with the smallest hashes.  All labelled languages are learned; more
than a table of ``MAX_TABLE_BYTES`` holds (2^18 bytes each) are an error.

A row is accepted if its best language isn't ``und`` and its posterior is at
least ``least``.  Defined results: null, empty and letterless texts are ``und``
and rejected; null declarations, suffixes and hosts are no evidence; rows stay
one to one, also repeated ones and those with null keys; ties go to the first
language in alphabetical order; with no labelled rows all is ``und``; an
empty table gives an empty result; extra columns stay as they are.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusflow.llm.common import blocks, content_key, lowered, mix64, read_table, small_batches, stored, without
from corpusflow.llm.registry import query
from corpusflow.operators.sizing import broadcast_if_small

GRAM, BITS = 3, 16
MAX_TRAIN, MAX_TABLE_BYTES = 1_500, 1 << 27
MAX_GRAMS = 60
UND, UND_PRIOR = "und", 0.01
HOST_STRENGTH, DOMAIN_STRENGTH = 10.0, 50.0

_LETTER = np.zeros(256, bool)
_LETTER[128:] = True
for _a in (65, 97):
    _LETTER[_a:_a + 26] = True
_MIX = mix64(np.arange(256, dtype=np.uint64) + np.uint64(7))


def grams(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashed n-grams of letters and blanks that hold two letters or more, and each text's first."""
    letter = _LETTER[data]
    clean = np.where(letter, lowered(data), np.uint8(32))
    n = len(data) - GRAM + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(len(off), np.int64)
    h = np.zeros(n, np.uint64)
    letters = np.zeros(n, np.int8)
    for j in range(GRAM):
        h = h * np.uint64(0x100000001B3) + _MIX[clean[j:n + j]]
        letters += letter[j:n + j]
    ok = letters >= 2
    for cut in off[1:-1]:  # not across texts
        ok[max(cut - GRAM + 1, 0):cut] = False
    at = np.flatnonzero(ok)
    return (mix64(h[at]) >> np.uint64(64 - BITS)).astype(np.int64), np.searchsorted(at, off)


def _gram_counts(languages: list[str]):
    index = {x: i for i, x in enumerate(languages)}

    def run(batches):
        total = np.zeros((len(languages), 1 << BITS), np.int64)
        for b in batches:
            label = [index[x] for x in b.column(0).to_pylist()]
            for lo, hi, data, off in blocks(b.column(1)):
                g, first = grams(data, off)
                for i in range(hi - lo):
                    total[label[lo + i]] += np.bincount(g[first[i]:first[i + 1]], minlength=1 << BITS)
        for i, row in enumerate(total):
            seen = np.flatnonzero(row)
            if len(seen):
                yield pa.RecordBatch.from_arrays([pa.array([i] * len(seen), pa.int64()), pa.array(seen), pa.array(row[seen])], names=["i", "gram", "n"])
    return run


def train(docs: DataFrame, *, key: str, text: str, lang: str, max_train: int = MAX_TRAIN, max_bytes: int = MAX_TABLE_BYTES) -> dict:
    """Log likelihoods of hashed n-grams: 2^16 numbers a language, ``max_bytes`` at most."""
    small_batches(docs.sparkSession)
    known = docs.select(F.col(key).cast("string").alias("key"), F.lower(F.col(lang).cast("string")).alias("lang")).filter("lang is not null and key is not null and lang <> ''")
    most = max_bytes // (4 << BITS) - 1  # one column is und
    languages = sorted(r.lang for r in known.select("lang").distinct().limit(most + 1).collect())
    if len(languages) > most:
        raise ValueError(f"more than {most} labelled languages: their table needs more than max_bytes = {max_bytes}")
    if not languages:
        return {"languages": [], "table": np.zeros((1 << BITS, 0), np.float32)}
    # smallest hashes per language, by a threshold on a uniform hash: no ordering of all rows
    unit = F.pmod(F.xxhash64("key", F.lit(1)), F.lit(1 << 40)) / float(1 << 40)
    share = known.groupBy("lang").agg(F.least(F.lit(1.0), max_train * 1.2 / F.count("*")).alias("share"))
    picked = known.withColumn("u", unit).join(F.broadcast(share), "lang").filter("u <= share")
    picked = picked.withColumn("rn", F.row_number().over(Window.partitionBy("lang").orderBy("u", "key"))).filter(F.col("rn") <= max_train)
    rows = docs.select(F.col(key).cast("string").alias("key"), F.col(text).cast("string").alias("text")).join(F.broadcast(picked.select("key", "lang").distinct()), "key")
    counts = rows.select("lang", "text").mapInArrow(_gram_counts(languages), "i long, gram long, n long").groupBy("i", "gram").agg(F.sum("n").alias("n")).toArrow()
    n = np.zeros((len(languages), 1 << BITS), np.int64)
    n[np.asarray(counts["i"]), np.asarray(counts["gram"])] = np.asarray(counts["n"])
    seen = max((n.sum(0) > 0).sum(), 1)
    table = np.empty((1 << BITS, len(languages) + 1), np.float32)
    for i, row in enumerate(n):
        table[:, i] = np.log((row + 0.1) / (row.sum() + 0.1 * (1 << BITS)))
    table[:, -1] = -np.log(2.0 * seen)  # und: spread over twice the known n-grams
    return {"languages": languages, "table": table}


def _likelihoods(model: dict, max_grams: int):
    def run(batches):
        table = model["table"]
        width = table.shape[1]
        step = (1 << 24) // max(width, 64)
        for b in batches:
            parts, counts = [], []
            for lo, hi, data, off in blocks(b.column(1), step):
                g, first = grams(data, off)
                n = np.diff(first)
                total = np.zeros((hi - lo, width))
                rows = np.flatnonzero(n)
                if len(rows) and width:
                    if len(g) <= step:
                        sums = np.add.reduceat(table[g], first[rows], axis=0, dtype=np.float64)
                    else:  # one long text
                        sums = sum(table[g[at:at + step]].sum(0, dtype=np.float64) for at in range(0, len(g), step))[None]
                    total[rows] = sums * (np.minimum(n[rows], max_grams) / n[rows])[:, None]
                parts.append(total)
                counts.append(n)
            total = np.concatenate(parts) if parts else np.zeros((0, width))
            n = np.concatenate(counts) if counts else np.zeros(0, np.int64)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(total) + 1, dtype=np.int32) * width), pa.array(total.ravel()))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n.astype(np.int64)), lists], names=["e", "n_grams", "ll"])
    return run


def _counted(rows: DataFrame, by: list[str], languages: list[str]) -> DataFrame:
    """Rows per language of ``by`` as an array in the order of ``languages``."""
    counts = [F.sum(F.when(F.col("text_lang") == x, 1).otherwise(0)).cast("double") for x in languages]
    return rows.filter(F.col("text_lang") != UND).groupBy(*by).agg(F.array(*counts).alias("counts"))


def _sum(array: Column) -> Column:
    return F.aggregate(array, F.lit(0.0), lambda a, x: a + x)


def identify(docs: DataFrame, model: dict, *, key: str, text: str, declared: Column | None = None, suffix: Column | None = None, host: Column | None = None,
             domain: Column | None = None, least: float = 0.5, max_grams: int = MAX_GRAMS) -> DataFrame:
    """One narrow row per row of ``docs``: the key, its content key, the evidence, lang_id, posterior, text_lang, accepted."""
    spark = docs.sparkSession
    small_batches(spark)
    languages = model["languages"]
    none = F.lit(None).cast("string")
    lower = lambda c: none if c is None else F.nullif(F.lower(F.trim(c.cast("string"))), F.lit(""))
    names = F.array(*[F.lit(x) for x in [*languages, UND]])
    kept = F.struct(F.col(key).alias("key"), content_key(*docs.columns).alias("content"), lower(declared).alias("declared"), lower(suffix).alias("suffix"),
                    lower(host).alias("host"), lower(domain).alias("domain"))
    evidence = docs.select(kept.alias("e"), F.col(text).cast("string").alias("text"))
    # what is known of a row goes along with its text, so that no join is needed
    rows = stored(evidence.mapInArrow(_likelihoods(model, max_grams), f"e {evidence.schema['e'].dataType.simpleString()}, n_grams long, ll array<double>")
                  .select("e.*", "n_grams", "ll"), "text-likelihoods")
    if not languages:
        return rows.select(F.col("key").alias(key), "content", "declared", "suffix", "host", F.lit(UND).alias("lang_id"), F.lit(1.0).alias("posterior"), F.lit(UND).alias("text_lang"), F.lit(False).alias("accepted"))
    rows = rows.withColumn("text_lang", F.when(F.col("n_grams") == 0, UND).otherwise(F.get(names, F.array_position("ll", F.array_max("ll")).cast("int") - 1)))
    size = len(languages)
    flat = F.array(*[F.lit(0.0)] * size)
    total = {r.text_lang: float(r["count"]) for r in rows.groupBy("text_lang").count().collect()}  # a row per language
    of_lang = [total.get(x, 0.0) for x in languages]
    rows = rows.withColumns({"p0": F.array(*[F.lit((n + 1) / (sum(of_lang) + size)) for n in of_lang]), "of_lang": F.array(*[F.lit(n) for n in of_lang])})
    for name in ("declared", "suffix", "host", "domain"):
        seen = _counted(rows.filter(F.col(name).isNotNull()), [name], languages).withColumnRenamed("counts", f"by_{name}")
        rows = rows.join(broadcast_if_small(seen, 20_000), name, "left")
    own = F.transform(names, lambda x: (x == F.col("text_lang")).cast("double"))
    rows = rows.withColumn("own", F.slice(own, 1, size))
    for name in ("declared", "suffix", "host", "domain"):
        others = F.zip_with(F.coalesce(f"by_{name}", flat), "own", lambda n, o: F.when(F.col(name).isNull(), 0.0).otherwise(F.greatest(n - o, F.lit(0.0))))
        rows = rows.withColumn(f"by_{name}", others)

    def toward(counts: str, prior: Column, strength: float) -> Column:
        return F.zip_with(F.col(counts), prior, lambda n, p: (n + strength * p) / (_sum(F.col(counts)) + strength))
    rows = rows.withColumn("p_domain", toward("by_domain", F.col("p0"), DOMAIN_STRENGTH)).withColumn("p_host", toward("by_host", F.col("p_domain"), HOST_STRENGTH))

    def given(name: str) -> Column:  # log of P(value | language), but for what all languages share
        rate = F.zip_with(f"by_{name}", "of_lang", lambda n, m: F.log((n + 0.1) / (m + 1.0)))
        return F.when(F.col(name).isNull(), flat).otherwise(rate)
    rows = rows.withColumns({"e_declared": given("declared"), "e_suffix": given("suffix")})
    prior = F.zip_with("p_host", F.zip_with("e_declared", "e_suffix", lambda a, b: a + b), lambda p, e: F.log(p) + F.log(F.lit(1 - UND_PRIOR)) + e)
    # und has no counts of its own: it takes the mean evidence of a value
    mean_evidence = _sum(F.zip_with("e_declared", "e_suffix", lambda a, b: a + b)) / size
    rows = rows.withColumn("log_post", F.zip_with("ll", F.concat(prior, F.array(F.log(F.lit(UND_PRIOR)) + mean_evidence)), lambda a, b: a + b))
    best = F.array_max("log_post")
    rows = rows.withColumn("posterior", 1 / _sum(F.transform("log_post", lambda x: F.exp(x - best))))
    lang = F.when(F.col("n_grams") == 0, UND).otherwise(F.get(names, F.array_position("log_post", best).cast("int") - 1))
    return rows.select(F.col("key").alias(key), "content", "declared", "suffix", "host", lang.alias("lang_id"), F.round("posterior", 9).alias("posterior"), "text_lang",
                       ((lang != UND) & (F.col("posterior") >= least)).alias("accepted"))


def identify_documents(docs: DataFrame, labelled: DataFrame) -> DataFrame:
    """Documents: the row's language is what is declared, its source stands for the host."""
    model = train(labelled, key="doc_id", text="text", lang="lang")
    return identify(docs, model, key="doc_id", text="text", declared=F.col("lang"), host=F.col("source"))


def accepted_documents(docs: DataFrame, labelled: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are accepted, with their own columns."""
    found = identify_documents(docs, labelled)
    return without(docs, found.filter(~F.col("accepted")).select("content.*"), *docs.columns)


def page_evidence(pages: DataFrame) -> DataFrame:
    """Text without markup, declared language, host, domain and suffix of web pages."""
    html = F.col("html").cast("string")
    body = F.regexp_replace(F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1\s*>", " "), r"(?s)<[^>]*>", " ")
    host = F.lower(F.try_parse_url(F.col("url").cast("string"), F.lit("HOST")))
    path = F.regexp_extract(F.try_parse_url(F.col("url").cast("string"), F.lit("PATH")), r"^/([A-Za-z]{2})(?:/|$)", 1)
    return pages.select("page_id", body.alias("text"), F.nullif(F.regexp_extract(html, r"(?i)<html[^>]*\blang=[\"']?([A-Za-z]{2,3})", 1), F.lit("")).alias("declared"),
                        host.alias("host"), F.regexp_extract(host, r"([^.]+\.[^.]+)$", 1).alias("domain"),
                        F.coalesce(F.nullif(path, F.lit("")), F.regexp_extract(host, r"\.([a-z]+)$", 1)).alias("suffix"))


@query("op1_language_id")
def op1_language_id(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    return identify_documents(docs, docs).select("doc_id", "lang_id", "posterior", "text_lang", "accepted")


@query("language_id_pages")
def language_id_pages(spark, sf_dir):
    model = train(read_table(spark, sf_dir, "documents"), key="doc_id", text="text", lang="lang")
    pages = page_evidence(read_table(spark, sf_dir, "pages"))
    return identify(pages, model, key="page_id", text="text", declared=F.col("declared"), suffix=F.col("suffix"), host=F.col("host"), domain=F.col("domain")).select(
        "page_id", "declared", "suffix", "host", "lang_id", "posterior", "text_lang", "accepted")
