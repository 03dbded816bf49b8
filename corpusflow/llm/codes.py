"""Vector code compression: product codes over Hilbert-sorted flat blocks.

Components become the integers floor(4096 x), vectors are cut into ``parts``
consecutive parts, and every part position has a codebook of ``entries``
entries, refined by ``rounds`` of nearest-entry assignment and floored means.
All arithmetic is in integers, so no order of work changes a result.

A task packs its vectors into chunks of about ``CELLS`` components.  Within a
chunk the subvectors of each part position are sorted along a Hilbert curve and
cut into flat blocks of ``BLOCK`` rows; a block stores the minimum and maximum
of every component (its box) and the components' sums.  Chunks are written once
and read by every round; no vector is ever shuffled.  In a round, an entry is on a
block's shortlist unless the box distances show that the entry nearest to the box's
middle is nearer all over the box.  A block with one entry on its
shortlist adds its stored sums; the others go through exact integer kernels, one for all
blocks of equal shortlist length.  A task gives one partial sum per entry and component.

Defined results: rows whose vector is null or has a null or non-finite component (or one of
2^70 or more in size) are dropped; a length that ``parts`` doesn't divide is cut at
floor(i d / parts); the length is that of the smallest key's vector, vectors
of other lengths have a null code and error and take no part; with fewer
vectors than entries the codebooks are shorter; equal keys start in order of their
vectors and null keys come last; repeated rows count each time; errors beyond 64 bits
are null; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusflow.llm.common import read_table, spread_join, stored
from corpusflow.llm.registry import query

SCALE, PARTS, ENTRIES, ROUNDS = 4096, 8, 16, 6
CELLS, BLOCK = 1 << 20, 16
GROUP_BYTES = 16 << 20  # of a row group of chunks
MOST = float(2**70)
LONG = 2**63 - 1


def part_bounds(d: int, parts: int) -> list[tuple[int, int]]:
    return [(i * d // parts, (i + 1) * d // parts) for i in range(parts)]


def hilbert_keys(x: np.ndarray, bits: int = 10) -> np.ndarray:
    """Places of points along a Hilbert curve of their bounding cube, of at most ``bits`` levels."""
    n, w = x.shape
    keys = np.zeros(n, np.uint64)
    if not n or not w:
        return keys
    w = min(w, 63)
    bits = min(bits, 63 // w)
    low = x[:, :w].min(0).astype(float)
    span = float((x[:, :w].max(0).astype(float) - low).max()) or 1.0
    cube = ((x[:, :w].astype(float) - low) / span * ((1 << bits) - 1)).astype(np.int64)
    axes = [cube[:, i].copy() for i in range(w)]
    for level in range(bits - 1, 0, -1):  # undo the rotations of each level
        bit, below = 1 << level, (1 << level) - 1
        for a in axes:
            inside = (a & bit) != 0
            swap = np.where(inside, 0, (axes[0] ^ a) & below)
            axes[0] ^= np.where(inside, below, swap)
            a ^= swap
    for i in range(1, w):  # Gray code
        axes[i] ^= axes[i - 1]
    turn = np.zeros(n, np.int64)
    for level in range(bits - 1, 0, -1):
        turn ^= np.where(axes[-1] & (1 << level), (1 << level) - 1, 0)
    for level in range(bits - 1, -1, -1):
        for a in axes:
            keys = (keys << np.uint64(1)) | (((a ^ turn) >> level) & 1).astype(np.uint64)
    return keys


def _narrow(d: int) -> int:
    """Size below which squared distances over d components fit 64 bits, doubled ones too."""
    return math.isqrt((1 << 62) // (16 * max(d, 1)))


@dataclass
class Flat:
    """One part position of a chunk: rows in Hilbert order and their blocks."""
    rows: np.ndarray   # n x w
    order: np.ndarray  # the rows' places in the chunk
    low: np.ndarray    # blocks x w
    high: np.ndarray
    total: np.ndarray

    @classmethod
    def build(cls, x: np.ndarray) -> Flat:
        order = np.argsort(hilbert_keys(x), kind="stable").astype(np.int32)
        return cls.over(x[order], order)

    @classmethod
    def over(cls, rows: np.ndarray, order: np.ndarray) -> Flat:
        at = np.arange(0, len(rows), BLOCK)
        if rows.shape[1] == 0:
            none = np.zeros((len(at), 0), rows.dtype)
            return cls(rows, order, none, none, none)
        return cls(rows, order, np.minimum.reduceat(rows, at), np.maximum.reduceat(rows, at), np.add.reduceat(rows, at))

    def shortlists(self, book: np.ndarray) -> np.ndarray:
        """Blocks x entries: which entries may be nearest to some row of the block.

        The entry nearest to the box's middle is on it.  Another one is compared
        with that at the box's corner that favours the other most: the
        difference of their squared distances is linear, so an entry that is farther there
        is farther in the whole box."""
        middle = self.low + self.high
        away = 2 * book - middle[:, None, :]
        first = (away * away).sum(2).argmin(1)
        chosen = book[first][:, None, :]
        corner = np.where(book > chosen, self.high[:, None, :], self.low[:, None, :])
        own, other = corner - book, corner - chosen
        own, other = (own * own).sum(2), (other * other).sum(2)
        return (own < other) | ((own == other) & (np.arange(len(book)) <= first[:, None]))

    def nearest(self, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Every row's nearest entry (ties: the lower), and the length of every block's shortlist."""
        n, w = self.rows.shape
        listed = self.shortlists(book)
        lengths = listed.sum(1)
        out = np.repeat(listed.argmax(1), BLOCK)[:n].astype(np.int64)
        short = n % BLOCK and BLOCK - n % BLOCK
        padded = np.concatenate([self.rows, np.repeat(self.rows[-1:], short, 0)]).reshape(len(lengths), BLOCK, w)
        for length in np.unique(lengths[lengths > 1]):
            blocks = np.flatnonzero(lengths == length)
            entries = np.nonzero(listed[blocks])[1].reshape(len(blocks), length)
            away = np.zeros((len(blocks), BLOCK, length), self.rows.dtype)
            for k in range(w):
                gap = padded[blocks, :, k][:, :, None] - book[entries, k][:, None, :]
                away += gap * gap
            best = np.take_along_axis(entries, away.argmin(2), 1)
            at = blocks[:, None] * BLOCK + np.arange(BLOCK)
            inside = at < n
            out[at[inside]] = best[inside]
        return out, lengths

    def sums(self, book: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Rows and component sums per entry, and how many distances of rows the kernels took."""
        n, w = self.rows.shape
        entry, lengths = self.nearest(book)
        single = lengths == 1
        counts = np.bincount(entry, minlength=len(book))
        totals = np.zeros((len(book), w), self.rows.dtype)
        whole = np.flatnonzero(single)
        np.add.at(totals, entry[whole * BLOCK], self.total[whole])
        looked = np.repeat(~single, BLOCK)[:n]
        for e in np.unique(entry[looked]):
            totals[e] += self.rows[looked & (entry == e)].sum(0)
        return counts, totals, int(np.repeat(np.where(single, 0, lengths), BLOCK)[:n].sum())


def _pack(parts: int, d: int, cells: int):
    """Batches of (key, label, vector) to chunks; vectors of other lengths to bare rows."""
    bounds = part_bounds(d, parts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            vectors = b.column(2)
            fits = np.asarray(pa.compute.list_value_length(vectors)) == d
            for same in (True, False):
                rows = np.flatnonzero(fits == same)
                for at in range(0, len(rows), max(BLOCK, cells // max(d, 1))):
                    pick = pa.array(rows[at:at + max(BLOCK, cells // max(d, 1))])
                    keys, labels = b.column(0).take(pick), b.column(1).take(pick)
                    n = len(pick)
                    order = values = boxes = None
                    wide = False
                    if same:
                        x = np.floor(SCALE * np.asarray(vectors.take(pick).flatten(), float).reshape(n, d))
                        wide = bool(x.size) and float(np.abs(x).max()) >= min(_narrow(d), 2**31 - 1)
                        if wide:  # as exact doubles, in the rows' own order
                            values = x.tobytes()
                        else:
                            flats = [Flat.build(x[:, lo:hi].astype(np.int64)) for lo, hi in bounds]
                            order = np.concatenate([f.order for f in flats]).tobytes()
                            values = b"".join(f.rows.astype(np.int32).tobytes() for f in flats)
                            boxes = b"".join(v.astype(np.int64).tobytes() for f in flats for v in (f.low, f.high, f.total))
                    yield pa.RecordBatch.from_arrays(
                        [_one_list(keys), _one_list(labels), pa.array([wide]), pa.array([order], pa.binary()), pa.array([values], pa.binary()), pa.array([boxes], pa.binary())],
                        names=["keys", "labels", "wide", "place", "cells", "boxes"])
    return run


def _one_list(values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def _flats(row: dict, n: int, d: int, parts: int, wide: bool) -> list[Flat]:
    """A chunk's part positions; in Python integers where 64 bits may not do."""
    bounds = part_bounds(d, parts)
    if row["wide"]:
        x = np.array([[int(v) for v in r] for r in np.frombuffer(row["cells"]).reshape(n, d)], object).reshape(n, d)
        return [Flat.over(x[:, lo:hi], np.arange(n)) for lo, hi in bounds]
    order = np.frombuffer(row["place"], np.int32).reshape(parts, n)
    cells, boxes = np.frombuffer(row["cells"], np.int32), np.frombuffer(row["boxes"], np.int64)
    blocks, at, box, out = math.ceil(n / BLOCK), 0, 0, []
    for i, (lo, hi) in enumerate(bounds):
        w = hi - lo
        rows = cells[at:at + n * w].reshape(n, w).astype(np.int64)
        low, high, total = boxes[box:box + 3 * blocks * w].reshape(3, blocks, w)
        at, box = at + n * w, box + 3 * blocks * w
        f = Flat(rows, order[i], low, high, total)
        out.append(Flat(*(v.astype(object) for v in (f.rows,)), f.order, *(v.astype(object) for v in (low, high, total))) if wide else f)
    return out


def _books(books: list[list[list[int]]], d: int, parts: int) -> tuple[list[np.ndarray], bool]:
    wide = max((abs(v) for book in books for c in book for v in c), default=0) >= _narrow(d)
    return [np.array(book, object if wide else np.int64).reshape(len(book), hi - lo) for book, (lo, hi) in zip(books, part_bounds(d, parts), strict=True)], wide


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, pa.Array, dict]]:
    for b in batches:
        for i in range(b.num_rows):
            yield b.column("keys")[i].values, b.column("labels")[i].values, {c: b.column(c)[i].as_py() for c in ("wide", "place", "cells", "boxes")}


def _round(books: list, d: int, parts: int):
    """Partial sums of a task: (part, entry, position or -1 for the count, total); entry -1 counts the distances the kernels took."""
    def run(batches):
        arrays, wide = _books(books, d, parts)
        counts = np.zeros((parts, len(books[0])), np.int64)
        totals = [np.zeros(a.shape, object) for a in arrays]
        looked = 0
        for keys, _, row in _chunks(batches):
            if row["cells"] is None:
                continue
            for p, f in enumerate(_flats(row, len(keys), d, parts, wide)):
                book = arrays[p].astype(object) if f.rows.dtype == object else arrays[p]
                n, s, some = f.sums(book)
                counts[p] += n
                totals[p] += s
                looked += some
        out = [(p, e, -1, int(counts[p, e])) for p in range(parts) for e in range(counts.shape[1])]
        out += [(p, e, i, int(v)) for p, t in enumerate(totals) for (e, i), v in np.ndenumerate(t)]
        out.append((-1, -1, -1, looked))
        part, entry, pos, total = zip(*out, strict=True)
        yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(entry, pa.int32()), pa.array(pos, pa.int32()), pa.array([Decimal(v) for v in total], pa.decimal128(38, 0))],
                                         names=["part", "entry", "pos", "total"])
    return run


def _encode(books: list, d: int, parts: int):
    def run(batches):
        arrays, wide = _books(books, d, parts)
        for keys, labels, row in _chunks(batches):
            n = len(keys)
            code = error = None
            if row["cells"] is None:
                code = error = [None] * n
            else:
                places = np.zeros((n, parts), np.uint8 if len(books[0]) <= 256 else np.uint16)
                away = np.zeros(n, object)
                for p, f in enumerate(_flats(row, n, d, parts, wide)):
                    book = arrays[p].astype(object) if f.rows.dtype == object else arrays[p]
                    entry, _ = f.nearest(book)
                    gap = f.rows - book[entry]
                    places[f.order, p] = entry
                    away[f.order] += (gap * gap).sum(1)
                digits = 2 if len(books[0]) <= 256 else 4
                code = ["".join(f"{e:0{digits}x}" for e in r) for r in places.tolist()]
                error = [v if v <= LONG else None for v in map(int, away)]
            yield pa.RecordBatch.from_arrays([keys, labels, pa.array(code, pa.string()), pa.array(error, pa.int64())], names=["key", "label", "code", "error"])
    return run


@dataclass
class Compressed:
    codes: DataFrame                   # key, label, code, error
    codebooks: list[list[list[int]]]   # part, entry, position
    looked: list[float]                # distances that kernels took, as a share of all rows and entries, by round

    def digest(self) -> str:
        return hashlib.sha256(",".join(str(v) for book in self.codebooks for c in book for v in c).encode()).hexdigest()


def compress(vectors: DataFrame, *, key: str, vector: str, label: str, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, cells: int = CELLS) -> Compressed:
    """Codes of all kept vectors, and the final codebooks."""
    spark = vectors.sparkSession
    rows = vectors.select(F.col(key).alias("key"), F.col(label).alias("label"), F.col(vector).cast("array<double>").alias("x"))
    rows = rows.filter(F.col("x").isNotNull() & ~F.exists("x", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) >= MOST)))
    types = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    first = rows.select("key", "x").orderBy(F.col("key").asc_nulls_last(), "x").limit(entries).collect()
    d = len(first[0].x) if first else 0
    starts = [[math.floor(v) if abs(v) < 2**52 else int(v) for v in (SCALE * float(v) for v in r.x)] for r in first if len(r.x) == d]
    books = [[c[lo:hi] for c in starts] for lo, hi in part_bounds(d, parts)]
    if not first:
        return Compressed(spark.createDataFrame([], f"key {types['key']}, label {types['label']}, code string, error long"), books, [])
    path = f"keys array<{types['key']}>, labels array<{types['label']}>, wide boolean, place binary, cells binary, boxes binary"
    chunks = stored(rows.mapInArrow(_pack(parts, d, cells), path), "code-chunks", **{"parquet.block.size": GROUP_BYTES})
    looked = []
    for _ in range(rounds):
        sums = chunks.mapInArrow(_round(books, d, parts), "part int, entry int, pos int, total decimal(38,0)").groupBy("part", "entry", "pos").agg(F.sum("total").alias("total"))
        got = {(r.part, r.entry, r.pos): int(r.total) for r in sums.collect()}  # as many as the codebooks have numbers
        rows_seen = sum(got.get((0, e, -1), 0) for e in range(len(starts)))
        looked.append(got.get((-1, -1, -1), 0) / max(1, parts * rows_seen * len(starts)))
        books = [[[got[p, e, i] // got[p, e, -1] for i in range(len(c))] if got.get((p, e, -1)) else c for e, c in enumerate(book)] for p, book in enumerate(books)]
    codes = chunks.mapInArrow(_encode(books, d, parts), f"key {types['key']}, label {types['label']}, code string, error long")
    return Compressed(codes, books, looked)


def with_label_error(codes: DataFrame) -> DataFrame:
    """``label_error``: the errors' sum over equal labels, nulls together (null beyond 64 bits)."""
    codes = stored(codes, "codes")
    total = codes.groupBy("label").agg(F.sum(F.col("error").cast("decimal(38,0)")).try_cast("long").alias("label_error"))
    return spread_join(codes, total, "label")


def _sql() -> str:
    """The same by plain joins with every entry."""
    steps = ["""
k AS MATERIALIZED (SELECT row_number() OVER (ORDER BY vec_id, embedding) AS rid, vec_id, label,
     list_transform(embedding, lambda x: floor(4096 * x::DOUBLE)::BIGINT) AS v FROM embeddings
     WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
x AS MATERIALIZED (SELECT rid, p, v[p * len(v) // 8 + 1:(p + 1) * len(v) // 8] AS s FROM k, (SELECT unnest(range(8)) AS p) t),
b0 AS MATERIALIZED (SELECT p, rid - 1 AS e, s AS c FROM x WHERE rid <= 16)"""]
    for r in range(ROUNDS + 1):
        steps.append(f"""
a{r} AS MATERIALIZED (SELECT rid, x.p, any_value(s) AS s,
     min(list_sum(list_transform(range(1, len(s) + 1), lambda i: (s[i] - c[i]) * (s[i] - c[i])))::HUGEINT * 16 + e) AS m
     FROM x JOIN b{r} USING (p) GROUP BY rid, x.p)""")
        if r < ROUNDS:
            steps.append(f"""
n{r} AS MATERIALIZED (SELECT p, e, list(CASE WHEN t >= 0 THEN t // n ELSE -((n - 1 - t) // n) END ORDER BY i) AS c
     FROM (SELECT p, m % 16 AS e, i, sum(s[i])::HUGEINT AS t, count(*) AS n FROM (SELECT *, unnest(range(1, len(s) + 1)) AS i FROM a{r}) u GROUP BY p, m % 16, i) g GROUP BY p, e),
b{r + 1} AS MATERIALIZED (SELECT b{r}.p, b{r}.e, coalesce(n{r}.c, b{r}.c::HUGEINT[]) AS c FROM b{r} LEFT JOIN n{r} ON b{r}.p = n{r}.p AND b{r}.e = n{r}.e)""")
    return "WITH" + ",".join(steps) + f"""
, f AS (SELECT rid, string_agg(printf('%02x', (m % 16)::INTEGER), '' ORDER BY p) AS code, sum(m // 16)::BIGINT AS error FROM a{ROUNDS} GROUP BY rid)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
       (SELECT sha256(string_agg(v::VARCHAR, ',' ORDER BY p, e, i)) FROM (SELECT p, e, unnest(c) AS v, unnest(range(len(c))) AS i FROM b{ROUNDS}) z) AS codebooks_sha256
FROM k JOIN f USING (rid)"""


@query("op11_vector_codes", _sql())
def op11_vector_codes(spark, sf_dir):
    found = compress(read_table(spark, sf_dir, "embeddings"), key="vec_id", vector="embedding", label="label")
    return with_label_error(found.codes).select(F.col("key").alias("vec_id"), "code", "error", "label_error", F.lit(found.digest()).alias("codebooks_sha256"))
