"""Language detection (F4) as a Spark job: a character-trigram naive-Bayes
profile trained on labelled rows, scored inside the row.

Features: trigrams of every whitespace piece padded with one space on each
side (a piece of k characters gives k trigrams), over the whole text.

Train: every task counts the trigrams of its texts by language and sends one row
per distinct (language, trigram) of a block of text; one aggregation adds them up.
Score: a text's trigrams are looked up in the profile and summed per language:

    score(l) = sum_g n_g * ln(c_lg + 1) - G * ln(N_l + V)

(add-one smoothing; G = trigrams in the document, N_l = trigrams of language
l, V = distinct trigrams).  A profile within ``MAX_PROFILE_BYTES`` goes to all tasks as one table, so
one row per document leaves the stage and nothing is shuffled.  Of a larger one every block of about
``LOOKUP_CHARS`` characters of text gets the grams that it holds, by a join on the block's distinct
grams; the scores are the same to the last bit.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusflow.functions.text import stripped_length
from corpusflow.session import stored

MIN_DETECT_CHARS = 10
MAX_PROFILE_BYTES = 32 << 20
BLOCK_CHARS = 1 << 19
LOOKUP_CHARS = 1 << 21
_BITS = 21  # of a code point

#: The characters of ``WHITESPACE_CLASS``, by code point.
_SPACE = np.zeros(0x3001, bool)
for _lo, _hi in ((0x09, 0x0D), (0x1C, 0x20), (0x85, 0x85), (0xA0, 0xA0), (0x1680, 0x1680), (0x2000, 0x200A), (0x2028, 0x2029), (0x202F, 0x202F), (0x205F, 0x205F), (0x3000, 0x3000)):
    _SPACE[_lo:_hi + 1] = True


def gram_code(gram: Column) -> Column:
    """The three code points of a trigram as one BIGINT."""
    at = [F.ascii(F.substring(gram, i, 1)).cast("bigint") for i in (1, 2, 3)]
    return F.shiftleft(at[0], 2 * _BITS) + F.shiftleft(at[1], _BITS) + at[2]


def gram_text(code: int) -> str:
    mask = (1 << _BITS) - 1
    return chr(code >> 2 * _BITS) + chr(code >> _BITS & mask) + chr(code & mask)


def gram_codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Codes of all trigrams of some texts, and the text of each: a character that
    isn't whitespace with its neighbours, where whitespace counts as a space."""
    points = np.frombuffer(" ".join(["", *texts, ""]).encode("utf-32-le"), np.uint32).astype(np.int64)
    ends = np.cumsum([len(t) + 1 for t in texts])  # of each text and the space before it
    space = _SPACE[np.minimum(points, len(_SPACE) - 1)] & (points < len(_SPACE))
    points[space] = 32
    middle = np.flatnonzero(~space)
    codes = (points[middle - 1] << 2 * _BITS) + (points[middle] << _BITS) + points[middle + 1]
    return codes, np.searchsorted(ends, middle, "right")


def _blocks(texts: list[str], most: int = BLOCK_CHARS) -> Iterator[tuple[int, int]]:
    """Ranges of whole texts of about ``most`` characters."""
    lo = size = 0
    for i, t in enumerate(texts):
        if size and size + len(t) > most:
            yield lo, i
            lo, size = i, 0
        size += len(t)
    if lo < len(texts):
        yield lo, len(texts)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        langs = b.column(0).to_pylist()
        texts = [t or "" for t in b.column(1).to_pylist()]
        by_lang: dict[str, list[str]] = {}
        for lang, text in zip(langs, texts, strict=True):
            by_lang.setdefault(lang, []).append(text)
        for lang, own in by_lang.items():
            for lo, hi in _blocks(own):
                grams, n = np.unique(gram_codes(own[lo:hi])[0], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(grams), pa.string()), pa.array([gram_text(g) for g in grams.tolist()], pa.string()), pa.array(n.astype(np.int64))],
                                                 names=["lang", "gram", "cnt"])


def train_profile(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(lang, gram, cnt) over labelled rows."""
    rows = labelled.filter(F.col(lang_col).isNotNull()).select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(_count, "lang string, gram string, cnt long").groupBy("lang", "gram").agg(F.sum("cnt").alias("cnt"))


@dataclass(frozen=True)
class ProfileStats:
    totals: dict[str, int]  # lang -> number of trigrams
    distinct: int           # V
    rows: int


def profile_stats(profile: DataFrame) -> ProfileStats:
    """Per-language totals (one row per language) and the distinct gram count."""
    per = profile.groupBy("lang").agg(F.sum("cnt").alias("n"), F.count(F.lit(1)).alias("k")).collect()
    distinct = profile.select("gram").distinct().count()
    return ProfileStats({r["lang"]: int(r["n"]) for r in per}, int(distinct),
                        int(sum(r["k"] for r in per)))


@dataclass(frozen=True)
class ProfileTable:
    """``codes`` rising, ``logs`` of ln(count + 1) per code and language, each language's
    ``penalty`` per trigram."""
    langs: list[str]
    codes: np.ndarray
    logs: np.ndarray
    penalty: np.ndarray

    def scores(self, texts: list[str]) -> np.ndarray:
        """Texts x languages."""
        codes, text = gram_codes(texts)
        at = np.minimum(np.searchsorted(self.codes, codes), max(len(self.codes) - 1, 0))
        known = self.codes[at] == codes if len(self.codes) else np.zeros(len(codes), bool)
        at, owner = at[known], text[known]
        total = np.bincount(text, minlength=len(texts))
        sums = [np.bincount(owner, weights=self.logs[at, i], minlength=len(texts)) for i in range(len(self.langs))]
        return np.stack(sums, 1) - total[:, None] * self.penalty


def _counts(profile: DataFrame, langs: list[str]) -> DataFrame:
    """(code, c0, c1, ...): a row per gram, its count in each language."""
    counts = [F.coalesce(F.sum(F.when(F.col("lang") == x, F.col("cnt"))), F.lit(0)).cast("double").alias(f"c{i}") for i, x in enumerate(langs)]
    return profile.select(gram_code(F.col("gram")).alias("code"), "lang", "cnt").groupBy("code").agg(*counts)


def profile_table(counts: pa.Table, stats: ProfileStats) -> ProfileTable:
    """The rows of ``_counts``, all or those of some texts, as a table to look up."""
    langs = sorted(stats.totals)
    codes = np.asarray(counts["code"])
    order = np.argsort(codes)
    logs = np.log(np.stack([np.asarray(counts[f"c{i}"]) for i in range(len(langs))], 1) + 1)
    penalty = np.array([math.log(stats.totals[x] + stats.distinct) for x in langs])
    return ProfileTable(langs, codes[order], logs[order], penalty)


def _score(table: ProfileTable):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(b.num_columns - 1).to_pylist()  # null: not to be scored
            scores = np.zeros((len(texts), len(table.langs)))
            asked = [i for i, t in enumerate(texts) if t is not None]
            for lo, hi in _blocks([texts[i] for i in asked]):
                scores[asked[lo:hi]] = table.scores([texts[i] for i in asked[lo:hi]])
            none = np.ones(len(texts), bool)
            none[asked] = False
            best = pa.array(np.array(table.langs, object)[scores.argmax(1)], pa.string(), mask=none)  # ties: the first language
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], *(pa.array(scores[:, i], mask=none) for i in range(len(table.langs))), best],
                                             names=[*b.schema.names[:-1], *(f"score_{x}" for x in table.langs), "pred_lang"])
    return run


def _cut(most: int):
    """Rows with the number of their block of text; the first row of a block has the block's distinct grams."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        for b in batches:
            texts = [t or "" for t in b.column(b.num_columns - 1).to_pylist()]
            blocks, codes = np.zeros(len(texts), np.int64), [None] * len(texts)
            for lo, hi in _blocks(texts, most):
                blocks[lo:hi] = block
                codes[lo] = np.unique(gram_codes(texts[lo:hi])[0])
                block += 1
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(blocks), pa.array(codes, pa.list_(pa.int64()))], names=[*b.schema.names, "_block", "_codes"])
    return run


def _score_block(stats: ProfileStats):
    """Scores the rows of a block by the grams found for it."""
    def run(rows: pa.Table, found: pa.Table) -> pa.Table:
        given = rows.drop_columns(["_block"]).combine_chunks().to_batches()
        return pa.Table.from_batches(_score(profile_table(found, stats))(given))
    return run


def score_languages(df: DataFrame, key: list[str], profile: DataFrame, stats: ProfileStats | None = None,
                    text_col: str = "text", carry: list[str] = (), max_bytes: int = MAX_PROFILE_BYTES) -> DataFrame:
    """key + ``carry`` columns + ``score_<lang>`` + ``pred_lang`` for every row
    of ``df`` (null prediction for texts under 10 stripped characters).

    With a profile within ``max_bytes`` one pass without a shuffle: a row's columns travel with its
    text.  A larger one is joined to the texts by block, which gives the same scores."""
    if stats is None:
        profile = stored(profile, "profile")
        stats = profile_stats(profile)
    columns = list(dict.fromkeys([*key, *carry]))
    if not stats.totals:  # nothing was trained: no prediction
        return df.select(*columns).withColumn("pred_lang", F.lit(None).cast("string"))
    langs = sorted(stats.totals)
    text = F.col(text_col).cast("string")
    rows = df.select(*columns, F.when(stripped_length(text) >= MIN_DETECT_CHARS, text).alias("_text"))
    given = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields]
    kind = ", ".join([*given[:-1], *(f"`score_{x}` double" for x in langs), "pred_lang string"])
    counts = _counts(profile, langs)
    if stats.distinct * 8 * (len(langs) + 1) <= max_bytes:
        return rows.mapInArrow(_score(profile_table(counts.toArrow(), stats)), kind)
    cut = stored(rows.mapInArrow(_cut(LOOKUP_CHARS), ", ".join([*given, "_block long", "_codes array<long>"])), "text-blocks")
    asked = cut.filter("_codes is not null").select(F.col("_block").alias("_of"), F.explode("_codes").alias("code"))
    found = asked.join(counts, "code")
    scored = cut.drop("_codes").groupBy("_block").cogroup(found.groupBy("_of")).applyInArrow(_score_block(stats), kind)
    return stored(scored, "language-scores")
