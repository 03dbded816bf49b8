"""Toxicity: weighted lexicon matched by Aho-Corasick.

Texts are lower-cased and decomposed by compatibility; accents, strokes and other marks
go, homoglyphs become Latin letters and digit substitutions are undone inside words that
hold a letter; all else becomes a blank.  Lexicon entries are whole words or word beginnings with weights (log
odds of the documents that hold them), learned from labelled training rows;
words that begin like an entry but stand in harmless documents become
exception phrases, and callers may add phrases of their own.  A match inside
an exception phrase doesn't count.  The weight of all matches and its share of
the text's length go through a logistic that is fitted on other training rows
than the lexicon was.

The model is fitted on a bounded sample: at most ``max_train`` labelled rows,
those with the smallest hashes.  That bounds the lexicon and the exceptions, of which
none is dropped: an entry stands in four or more toxic documents of the sample.
Everything else covers all rows and whole texts.

Defined results: a null text is an empty one and has the score of no match;
rows stay one to one, also repeated ones and those with null keys; with no
labelled rows of a class the score is the other's share, or 0; an empty table
gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusflow.llm.common import read_table, small_batches, stored
from corpusflow.llm.quality import held_out
from corpusflow.llm.registry import query

MAX_TRAIN = 24_000
STEM = range(4, 9)  # lengths of word beginnings

# Letters of other scripts that look like Latin ones.
HOMOGLYPHS = {
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "һ": "h", "і": "i", "ј": "j", "к": "k", "ӏ": "l", "м": "m", "н": "h", "о": "o",
    "р": "p", "ԛ": "q", "ѕ": "s", "т": "t", "ѵ": "v", "ԝ": "w", "х": "x", "у": "y", "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i",
    "ґ": "r", "ԍ": "g", "ү": "y", "ҽ": "e", "ѡ": "w", "ϲ": "c", "ϳ": "j", "γ": "y", "σ": "o", "ω": "w", "օ": "o", "ս": "u", "հ": "h", "ց": "g",
    "ո": "n", "զ": "q", "ք": "p", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ı": "i", "ⅼ": "l", "ɑ": "a", "ɡ": "g",
}
DIGITS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s"}


# Letters that Unicode doesn't decompose say in their names which Latin letter they are.
_NAMED = re.compile(r"(?:LATIN (?:SMALL|CAPITAL) LETTER|LATIN LETTER SMALL CAPITAL|LATIN SMALL LETTER SCRIPT|NEGATIVE (?:CIRCLED|SQUARED) LATIN CAPITAL LETTER"
                    r"|REGIONAL INDICATOR SYMBOL LETTER|LATIN SMALL LETTER (?:DOTLESS|SIDEWAYS|TURNED)) ([A-Z])(?: WITH .*)?")


def _letter(c: str) -> str:
    """Folded form of a decomposed, lower-cased character."""
    if "\u0300" <= c <= "\u036f" or c in "\xad\u200b\u200c\u200d\u2060\ufe0e\ufe0f\ufeff":
        return ""  # combining and invisible characters
    c = HOMOGLYPHS.get(c, c)
    if c >= "\x80":
        named = _NAMED.fullmatch(unicodedata.name(c, ""))
        c = named[1].lower() if named else c
    return DIGITS.get(c, c) if c in DIGITS or c.isalnum() else " "


class _Folding(dict):
    """Code points to folded text, made when first seen."""

    def __missing__(self, code: int) -> str:
        c = chr(code)
        parts = c if 0xAC00 <= code <= 0xD7A3 else unicodedata.normalize("NFKD", c).lower()  # syllables stay whole
        self[code] = out = HOMOGLYPHS.get(c) or "".join(map(_letter, parts))
        return out


_FOLD = _Folding()
_PLAIN_NUMBER = re.compile(r"(?<![^\W_])[\d@$]+(?![^\W_])")


def fold(text: str | None) -> str:
    """Folded text, with a blank before, after and between words."""
    low = (text or "").lower()
    if not low.isascii():
        low = unicodedata.normalize("NFKC", low).lower()
    if any(c in low for c in "0134578@$"):
        low = _PLAIN_NUMBER.sub(" ", low)
    return " " + " ".join(low.translate(_FOLD).split()) + " "


def _terms(word: str):
    yield f" {word} "
    for n in STEM:
        if len(word) > n:
            yield f" {word[:n]}"


def _counts(batches):
    seen: dict[int, Counter] = {0: Counter(), 1: Counter()}
    for b in batches:
        for y, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            seen[y].update({t for w in set(fold(text).split()) for t in _terms(w)})
            seen[y][""] += 1
    for y, c in seen.items():
        items = list(c.items())
        for lo in range(0, len(items), 20_000):
            part = items[lo:lo + 20_000]
            yield pa.RecordBatch.from_arrays([pa.array([t for t, _ in part]), pa.array([y] * len(part), pa.int64()), pa.array([n for _, n in part], pa.int64())], names=["term", "y", "n"])


def learn_lexicon(train: DataFrame, exceptions: tuple[str, ...] = (), support: int = 4) -> tuple[dict[str, float], list[str], float]:
    """Weights of terms, exception phrases, and the share of class 1; from (y, text)."""
    per = stored(train.mapInArrow(_counts, "term string, y long, n long").groupBy("term").agg(
        F.sum(F.when(F.col("y") == 1, F.col("n")).otherwise(0)).alias("bad"), F.sum(F.when(F.col("y") == 0, F.col("n")).otherwise(0)).alias("good")),
        "toxic-terms")  # read three times, counted once
    total = per.filter("term = ''").first()
    if total is None or not total.bad or not total.good:
        return {}, list(exceptions), float(bool(total and total.bad))
    odds = F.log((F.col("bad") + 0.1) / total.bad) - F.log((F.col("good") + 0.5) / total.good)
    # a term must stand in enough toxic documents, and mostly in those
    found = per.filter((F.col("term") != "") & (F.col("bad") >= support) & (F.col("bad") >= F.col("good"))).withColumn("w", odds)
    found = found.filter("w >= 2").collect()
    terms: dict[str, float] = {}
    for r in sorted(found, key=lambda r: (len(r.term), r.term)):
        if not any(r.term[:n] in terms for n in range(2, len(r.term))):  # its beginning is an entry
            terms[r.term] = float(r.w)
    stems = [t for t in terms if not t.endswith(" ")]
    harmless = list(exceptions)
    if stems:
        whole = per.filter((F.col("good") >= 3) & (F.col("good") > 4 * F.col("bad")) & F.col("term").endswith(" "))
        hit = F.lit(False)
        for n in STEM:
            own = [s for s in stems if len(s) == n + 1]
            if own:
                hit = hit | F.substring("term", 1, n + 1).isin(own)
        harmless += [r.term.strip() for r in whole.filter(hit).orderBy("term").collect()]
    return terms, harmless, total.bad / (total.bad + total.good)


def automaton(terms: dict[str, float], exceptions: list[str]):
    """One automaton of entries and exception phrases; None where there are no entries."""
    if not terms:
        return None
    a = ahocorasick.Automaton()
    for t, w in terms.items():
        a.add_word(t, (len(t), w))
    for phrase in exceptions:
        p = fold(phrase)
        if p.strip():
            a.add_word(p, (len(p), 0.0 if p not in terms else -1.0))
    a.make_automaton()
    return a


def matched(folded: str, a) -> tuple[float, int]:
    """Sum of weights and number of matches outside exception phrases."""
    if a is None:
        return 0.0, 0
    hits = [(end - n + 1, end, w) for end, (n, w) in a.iter(folded)]
    spared = [(s, e) for s, e, w in hits if w <= 0]
    kept = [w for s, e, w in hits if w > 0 and not any(x <= s and e <= y for x, y in spared)]
    return sum(kept), len(kept)


def measures(text: str | None, a) -> tuple[float, float]:
    folded = fold(text)
    total, _ = matched(folded, a)
    return math.log1p(total), math.log1p(100 * total / folded.count(" "))


def fit_logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights by Newton's method with a small ridge."""
    x = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hess = (x * (p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(len(w))
        step = np.linalg.solve(hess, x.T @ (y - p) - 0.1 * w)
        w += step
        if np.abs(step).max() < 1e-9:
            break
    return w


def _scores(model: dict):
    def run(batches):
        a = automaton(model["terms"], model["exceptions"])
        for b in batches:
            m = np.array([measures(t, a) for t in b.column(1).to_pylist()]).reshape(-1, 2)
            if model["weights"] is None:
                p = np.full(len(m), model["share"])
            else:
                p = 1 / (1 + np.exp(-np.clip(np.column_stack([np.ones(len(m)), m]) @ model["weights"], -30, 30)))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(p, pa.float64())], names=["key", "score"])
    return run


def _measured(model: dict):
    def run(batches):
        a = automaton(model["terms"], model["exceptions"])
        for b in batches:
            m = np.array([measures(t, a) for t in b.column(1).to_pylist()]).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(m[:, 0]), pa.array(m[:, 1])], names=["y", "a", "b"])
    return run


def learn(docs: DataFrame, labels: DataFrame, *, key: str, text: str, label: str, mod: int = 4, rest: int = 2,
          max_train: int = MAX_TRAIN, exceptions: tuple[str, ...] = ()) -> dict:
    """The model, from at most ``max_train`` labelled rows that aren't held out:
    two thirds give the lexicon and the rest the logistic."""
    y = labels.select(F.col(key).cast("long").alias("key"), F.col(label).cast("long").alias("y"))
    y = y.filter(F.col("y").isin(0, 1) & F.col("key").isNotNull() & ~held_out(F.col("key"), mod, rest))
    y = y.orderBy(F.xxhash64("key", F.lit(8)), "key", "y").limit(max_train)
    t = docs.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text")).join(F.broadcast(y), "key")
    part = F.pmod(F.xxhash64("key", F.lit(88)), F.lit(3))
    terms, harmless, share = learn_lexicon(t.filter(part < 2).select("y", "text"), exceptions)
    model = {"terms": terms, "exceptions": harmless, "share": share, "weights": None}
    rows = t.filter(part == 2).select("y", "text").mapInArrow(_measured(model), "y long, a double, b double").collect()  # at most max_train
    target = np.array([r.y for r in rows], float)
    if terms and 0 < target.sum() < len(target):
        order = np.lexsort((target, [r.b for r in rows], [r.a for r in rows]))
        model["weights"] = fit_logistic(np.array([(r.a, r.b) for r in rows])[order], target[order])
    return model


def toxicity(docs: DataFrame, model: dict, *, key: str, text: str, threshold: float = 0.3) -> DataFrame:
    small_batches(docs.sparkSession)
    scored = docs.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text")).mapInArrow(_scores(model), "key long, score double")
    return scored.select(F.col("key").alias(key), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


@query("op8_toxicity")
def op8_toxicity(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    model = learn(docs, read_table(spark, sf_dir, "labels"), key="doc_id", text="text", label="toxic")
    return toxicity(docs, model, key="doc_id", text="text").select("doc_id", held_out(F.col("doc_id"), 4, 2).alias("held_out"), "score", "predicted")
