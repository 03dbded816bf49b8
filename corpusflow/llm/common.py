"""Shared helpers of the ``llm`` operators.

Text-heavy operators read Arrow batches and work on the UTF-8 buffers with
numpy, so no Python string is built per token.  A batch is cut into blocks of
a quarter of a megabyte; a longer text makes a block of its own, whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow.operators.joins import spread_join  # noqa: F401
from corpusflow.operators.sizing import broadcast_if_small
from corpusflow.session import batch_rows, shared_path, stored  # noqa: F401

BLOCK_BYTES = 1 << 18
_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INV = pow(_BASE, -1, 1 << 64)
_pow: dict[str, np.ndarray] = {}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def small_batches(spark: SparkSession) -> None:
    """Bound the memory of a Python task: batches of 1,000 rows rather than 10,000."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")


def row_id() -> F.Column:
    """A key of rows that stays fixed once the frame is stored."""
    return F.monotonically_increasing_id()


def content_key(*columns: str) -> F.Column:
    """A 128-bit key of a row's content: rows with equal content share it, and
    so share every decision that depends on the content alone."""
    return F.struct(F.xxhash64(F.lit(1), *columns).alias("a"), F.xxhash64(F.lit(2), *columns).alias("b"))


def numbered(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with the columns u0, u1, ..., which no operator uses for its own, and their names by those of ``docs``."""
    own = {c: f"u{i}" for i, c in enumerate(docs.columns)}
    return docs.toDF(*own.values()), own


def without(docs: DataFrame, bad: DataFrame, *columns: str, most: int = 500_000) -> DataFrame:
    """Rows of ``docs`` whose content key isn't in ``bad`` (columns a and b); the
    rows stay where they are as long as the keys are few enough to broadcast."""
    bad = broadcast_if_small(bad.select("a", "b").distinct(), most)
    rows, own = numbered(docs)
    keyed = rows.withColumn("content", content_key(*(own[c] for c in columns)))
    kept = keyed.join(bad, (F.col("content.a") == F.col("a")) & (F.col("content.b") == F.col("b")), "left_anti")
    return kept.select(*own.values()).toDF(*docs.columns)


def mix64(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser, elementwise."""
    x = x.astype(_U, copy=True)
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


def _powers(base: int, n: int, key: str) -> np.ndarray:
    have = _pow.get(key)
    if have is None or len(have) < n:
        size = max(n, BLOCK_BYTES + 1)
        steps = np.full(size, _U(base))
        steps[0] = 1
        have = np.multiply.accumulate(steps)
        if size <= 4 * BLOCK_BYTES:
            _pow[key] = have
    return have[:n]


def utf8(column) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; nulls count as empty texts."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, off, data = column.buffers()
    offsets = np.frombuffer(off, np.int64)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw, offsets


def blocks(column, most: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets from 0) of whole texts, about ``most`` bytes each."""
    raw, off = utf8(column)
    n, lo = len(off) - 1, 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + most, "right")) - 1)
        yield lo, hi, raw[off[lo]:off[hi]], off[lo:hi + 1] - off[lo]
        lo = hi


def word_table() -> np.ndarray:
    """Bytes inside words: ASCII letters and digits, and all bytes of other characters."""
    t = np.zeros(256, bool)
    t[128:] = True
    for a, b in (("0", "9"), ("A", "Z"), ("a", "z")):
        t[ord(a):ord(b) + 1] = True
    return t


def lower_table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint8)
    t[ord("A"):ord("Z") + 1] += 32
    return t


WORD, LOWER = word_table(), lower_table()
_BYTE_MIX = mix64(np.arange(1, 257, dtype=_U) * _U(_BASE))
BYTE_MIX_2 = mix64(np.arange(1001, 1257, dtype=_U) * _U(_BASE))


def lowered(data: np.ndarray) -> np.ndarray:
    """Lower-cased bytes: ASCII and the Latin-1 letters of UTF-8."""
    out = LOWER[data]
    if len(data) > 1:
        up = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
        out[1:][up] += 32
    return out


def spans(inside: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal true runs, cut at the texts' bounds."""
    n = len(inside)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    before = np.zeros(n, bool)
    before[1:] = inside[:-1]
    after = np.zeros(n, bool)
    after[:-1] = inside[1:]
    inner = off[1:-1]
    before[inner[inner < n]] = False
    after[inner[inner > 0] - 1] = False
    return np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, table: np.ndarray = _BYTE_MIX) -> np.ndarray:
    """64-bit hashes of byte spans, equal for equal bytes wherever they stand;
    another table gives independent ones."""
    n = len(data)
    total = np.zeros(n + 1, _U)
    np.cumsum(table[data] * _powers(_BASE, n, "p"), out=total[1:])
    return mix64((total[ends] - total[starts]) * _powers(_BASE_INV, n + 1, "i")[starts])


def words(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased words of a block: starts, ends, hashes, and each text's first word."""
    starts, ends = spans(WORD[data], off)
    return starts, ends, span_hashes(lowered(data), starts, ends), np.searchsorted(starts, off)


def windows(hashes: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all runs of k words inside one text, their word positions in
    the block, and each text's first run."""
    n = len(hashes)
    if n < k:
        return np.zeros(0, _U), np.zeros(0, np.int64), np.zeros(len(first), np.int64)
    h = np.zeros(n - k + 1, _U)
    for j in range(k):
        h = h * _U(_BASE) + hashes[j:n - k + 1 + j]
    at = np.arange(n - k + 1)
    text = np.searchsorted(first, at, "right")
    ok = at + k <= first[np.minimum(text, len(first) - 1)]
    h, at = mix64(h[ok]), at[ok]
    return h, at, np.searchsorted(at, first)
