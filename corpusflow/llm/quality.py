"""Quality classifier: regularised quadratic discriminant analysis.

Each whole text gives transformed statistics (logs of lengths, roots of
character and word shares).  Per class, mean and covariance come from moment
sums over all labelled training rows; the covariance is shrunk towards the
pooled one and its scaled identity.  A score is the logistic of the tempered
difference of the classes' log densities, by Mahalanobis distances with
Cholesky factors that are computed once and sent to the tasks (a few KB).

Defined results: a null text is an empty one, and an empty one has a score of
its own like any other; rows stay one to one, also repeated ones and those
with null keys (they're not labelled); contradicting labels of one id all
count; with no labelled rows of a class the score is the other's share, or
0.5; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusflow.llm.common import blocks, lowered, read_table, small_batches, span_hashes, spans, stored
from corpusflow.llm.registry import query

FEATURES = ("log_bytes", "log_words", "log_lines", "word_length", "word_length_spread", "upper", "digit", "symbol", "stop_mark", "comma",
            "pipe", "exclaim", "line_length", "distinct_words", "top_word", "repeat_next", "short_words", "marked_words", "long_words", "capital_words")
D = len(FEATURES)
SHRINK_POOLED, SHRINK_IDENTITY, TEMPER = 0.2, 0.05, 0.5

_CLASS = np.full(256, 0, np.uint8)  # 0 letters and other bytes of words
for _i, _chars in enumerate((" \t\r\n\v\f", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", ".;:?", ",", "|", "!", "#$%&*@^~_=+<>{}[]\\/`\"'()-"), 1):
    for _c in _chars:
        _CLASS[ord(_c)] = _i
_NOT_SPACE = _CLASS != 1


def features(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """One row of statistics per text of a block."""
    n = len(off) - 1
    size = np.diff(off).astype(float)
    kind = _CLASS[data]
    # a text's counts are differences of running counts
    def per_text(mask):
        total = np.zeros(len(data) + 1, np.int64)
        np.cumsum(mask, out=total[1:])
        return (total[off[1:]] - total[off[:-1]]).astype(float)
    chars = {name: per_text(kind == i) for i, name in enumerate(("space", "upper", "digit", "stop", "comma", "pipe", "exclaim", "symbol"), 1)}
    lines = per_text(data == 10) + (size > 0)
    # an accented capital is 0xC3 and a byte of 0x80 to 0x9E
    chars["upper"] += per_text(np.concatenate([(data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E), [False]]) if len(data) else np.zeros(0, bool))
    starts, ends = spans(_NOT_SPACE[data], off)
    first = np.searchsorted(starts, off)
    count = np.diff(first).astype(float)
    w = np.maximum(count, 1)
    length = (ends - starts).astype(float)

    def summed(x):
        total = np.concatenate([[0.0], np.cumsum(x)])
        return total[first[1:]] - total[first[:-1]]
    mean = summed(length) / w
    spread = np.sqrt(np.maximum(summed(length ** 2) / w - mean ** 2, 0))
    h = span_hashes(lowered(data), starts, ends)
    text = np.repeat(np.arange(n), np.diff(first))
    order = np.lexsort((h, text))
    hs, ts = h[order], text[order]
    new = np.ones(len(hs), bool)
    new[1:] = (hs[1:] != hs[:-1]) | (ts[1:] != ts[:-1])
    distinct = np.bincount(ts[new], minlength=n).astype(float)
    most = np.zeros(n)
    if len(hs):
        at = np.flatnonzero(new)
        np.maximum.at(most, ts[at], np.diff(np.append(at, len(hs))).astype(float))
    again = np.zeros(len(h))
    if len(h) > 1:
        again[1:] = (h[1:] == h[:-1]) & (text[1:] == text[:-1])
    last = kind[ends - 1] if len(ends) else kind[:0]
    s = np.maximum(size, 1)
    root = np.sqrt
    return np.column_stack([
        np.log1p(size), np.log1p(count), np.log1p(lines), np.log1p(mean), np.log1p(spread), root(chars["upper"] / s), root(chars["digit"] / s),
        root(chars["symbol"] / s), root(chars["stop"] / s), root(chars["comma"] / s), root(chars["pipe"] / s), root(chars["exclaim"] / s),
        np.log1p(size / np.maximum(lines, 1)), distinct / w / (1 + np.log1p(count)), root(most / w), root(summed(again) / w),
        root(summed(length <= 3) / w), root(summed((last == 8) | (last == 7)) / w), root(summed(length >= 14) / w), root(summed(kind[starts] == 2) / w)])


def _featurise(batches):
    for b in batches:
        rows = [features(data, off) for _, _, data, off in blocks(b.column(1))]
        x = np.concatenate(rows) if rows else np.zeros((0, D))
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * D), pa.array(x.ravel()))
        yield pa.RecordBatch.from_arrays([b.column(0), lists], names=["key", "x"])


def statistics(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, x): the transformed statistics of every whole text."""
    small_batches(docs.sparkSession)
    return docs.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text")).mapInArrow(_featurise, "key long, x array<double>")


def _moments(batches):
    got: dict[int, np.ndarray] = {}
    for b in batches:
        y = np.asarray(b.column(0))
        x = np.asarray(b.column(1).flatten()).reshape(-1, D)
        x = np.column_stack([np.ones(len(x)), x])
        for c in (0, 1):
            got[c] = got.get(c, 0) + x[y == c].T @ x[y == c]
    for c, m in got.items():
        yield pa.RecordBatch.from_arrays([pa.array([c] * m.size), pa.array(range(m.size)), pa.array(m.ravel())], names=["y", "i", "v"])


def fit(labelled: DataFrame) -> dict:
    """Parameters from (y, x): moment sums are added up by Spark, 2 x 21 x 21 numbers reach the driver."""
    sums = labelled.mapInArrow(_moments, "y long, i long, v double").groupBy("y", "i").agg(F.sum(F.col("v").cast("decimal(38,9)")).cast("double").alias("v")).collect()
    m = {c: np.zeros((D + 1) ** 2) for c in (0, 1)}
    for r in sums:
        m[r.y][r.i] = r.v
    m = {c: v.reshape(D + 1, D + 1) for c, v in m.items()}
    n = {c: v[0, 0] for c, v in m.items()}
    if min(n.values()) < 2:
        total = sum(n.values())
        return {"share": n[1] / total if total else 0.5}
    mean = {c: m[c][0, 1:] / n[c] for c in m}
    scatter = {c: m[c][1:, 1:] - n[c] * np.outer(mean[c], mean[c]) for c in m}
    pooled = (scatter[0] + scatter[1]) / (n[0] + n[1])
    scale = np.sqrt(np.maximum(np.diag(pooled), 1e-8))
    out = {"scale": scale, "prior": float(np.log(n[1] / n[0]))}
    for c in m:
        cov = (1 - SHRINK_POOLED) * scatter[c] / n[c] + SHRINK_POOLED * pooled
        cov = cov / np.outer(scale, scale)
        cov = (1 - SHRINK_IDENTITY) * cov + SHRINK_IDENTITY * np.eye(D) * max(np.trace(cov) / D, 1e-3)
        low = np.linalg.cholesky(cov)
        out[c] = (mean[c], np.linalg.inv(low), 2 * np.log(np.diag(low)).sum())
    return out


def score_rows(x: np.ndarray, model: dict) -> np.ndarray:
    if "share" in model:
        return np.full(len(x), model["share"])
    dens = {}
    for c in (0, 1):
        mean, inverse, logdet = model[c]
        z = ((x - mean) / model["scale"]) @ inverse.T
        dens[c] = -0.5 * ((z ** 2).sum(1) + logdet)
    gap = np.clip(TEMPER * (dens[1] - dens[0]) + model["prior"], -30, 30)
    return 1 / (1 + np.exp(-gap))


def _scorer(model: dict):
    def run(batches):
        for b in batches:
            x = np.asarray(b.column(1).flatten()).reshape(-1, D)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(score_rows(x, model))], names=["key", "score"])
    return run


def held_out(key: F.Column, mod: int, rest: int) -> F.Column:
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % mod == rest, F.lit(False))


def classify(docs: DataFrame, labels: DataFrame, *, key: str, text: str, label: str, mod: int = 3, rest: int = 1) -> DataFrame:
    """(key, held_out, score, predicted) of every row; learned from rows that aren't held out."""
    x = stored(statistics(docs, key, text), "quality-statistics")
    y = labels.select(F.col(key).cast("long").alias("key"), F.col(label).cast("long").alias("y")).filter("y in (0, 1)")
    train = x.filter(~held_out(F.col("key"), mod, rest)).join(y, "key").select("y", "x")
    scored = x.mapInArrow(_scorer(fit(train)), "key long, score double")
    return scored.select(F.col("key").alias(key), held_out(F.col("key"), mod, rest).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query("op4_quality")
def op4_quality(spark, sf_dir):
    return classify(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"), key="doc_id", text="text", label="quality")
