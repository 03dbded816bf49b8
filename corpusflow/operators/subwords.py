"""Subword ids (T1) by the merge ranks of a given table.

A text is cut into pieces by the tokenizer's published pattern, and every
piece is merged on its own: from single bytes, the adjacent pair of lowest rank
is joined until no pair is in the table.  As equal pieces have equal ids, the work is
split into Spark jobs over pieces, not texts:

1. neighbouring rows make batches, stored once with their distinct pieces and, for each row,
   its pieces' numbers among these (a piece that every text holds is one entry per batch);
2. the distinct pieces of all batches by an aggregation;
3. the merge loop runs once per distinct piece, giving a piece-to-ids table;
4. the batches' pieces are joined with that table; a batch has a row per distinct piece, so none stands out;
5. a batch's rows meet its part of the table and are expanded by array lookups.

The merge table is a file of bounded size (``MAX_MERGES``), read by Spark from a path that
the caller gives; no tokenizer library is used.
"""

from __future__ import annotations

import base64
import heapq
import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusflow.functions.text import BYTE_LEVEL_PATTERN, pieces
from corpusflow.session import batch_rows, stored

MAX_MERGES = 2_000_000
BATCH_PIECES = 1 << 17  # of neighbouring rows to a batch; a longer row is a batch of its own
BATCH_ROWS = 1000


@dataclass(frozen=True)
class MergeTable:
    """``single``: the id of each byte; ``pairs``: (left id, right id) to (rank, merged id)."""
    single: dict[int, int]
    pairs: dict[tuple[int, int], tuple[int, int]]

    @classmethod
    def from_merges(cls, merges: list[tuple[bytes, bytes]], ids: dict[bytes, int]) -> MergeTable:
        """An ordered list of merges and the ids of all tokens."""
        pairs = {(ids[a], ids[b]): (rank, ids[a + b]) for rank, (a, b) in reversed(list(enumerate(merges)))}
        return cls._checked({t[0]: i for t, i in ids.items() if len(t) == 1}, pairs)

    @classmethod
    def from_ranks(cls, ranks: dict[bytes, int]) -> MergeTable:
        """Tokens and their ranks, which are their ids: any two tokens whose bytes together are a token merge at its rank."""
        pairs = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    pairs[left, right] = (rank, rank)
        return cls._checked({t[0]: i for t, i in ranks.items() if len(t) == 1}, pairs)

    @classmethod
    def _checked(cls, single: dict, pairs: dict) -> MergeTable:
        if len(single) != 256:
            raise ValueError(f"the table holds {len(single)} of 256 bytes")
        if len(pairs) > MAX_MERGES:
            raise ValueError(f"{len(pairs)} merges, more than {MAX_MERGES}")
        return cls(single, pairs)

    def ids(self, piece: bytes) -> list[int]:
        """Ids of one piece; the pairs wait in a heap by rank and place."""
        ids: list[int | None] = [self.single[b] for b in piece]
        after = list(range(1, len(ids) + 1))
        before = list(range(-1, len(ids) - 1))
        heap: list[tuple[int, int, int, int, int]] = []

        def offer(at: int) -> None:
            right = after[at]
            if right < len(ids):
                found = self.pairs.get((ids[at], ids[right]))
                if found:
                    heapq.heappush(heap, (found[0], at, ids[at], ids[right], found[1]))
        for at in range(len(ids) - 1):
            offer(at)
        while heap:
            _, at, left, right, merged = heapq.heappop(heap)
            other = after[at]
            if ids[at] != left or other >= len(ids) or ids[other] != right:
                continue  # one of the two has merged since
            ids[at], ids[other] = merged, None
            after[at] = after[other]
            if after[at] < len(ids):
                before[after[at]] = at
            if before[at] >= 0:
                offer(before[at])
            offer(at)
        return [i for i in ids if i is not None]


def byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in JSON tables: printable ones for
    themselves, the others in order from code point 256 on."""
    plain = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def read_merge_table(spark: SparkSession, path: str) -> MergeTable:
    """A table of ranks (lines of a base64 token and its rank) or a JSON file with byte-level ``vocab`` and ``merges``."""
    if path.endswith(".json"):
        model = json.loads(spark.read.text(path, wholetext=True).first()[0])["model"]
        letters = byte_letters()

        def raw(token: str) -> bytes:
            return bytes(letters[c] for c in token)
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        return MergeTable.from_merges([(raw(a), raw(b)) for a, b in merges], {raw(t): i for t, i in model["vocab"].items()})
    lines = spark.read.text(path).limit(MAX_MERGES + 1).collect()  # a tokenizer file, bounded
    return MergeTable.from_ranks({base64.b64decode(t): int(r) for t, r in (line[0].split() for line in lines if line[0].strip())})


def _merge(table: MergeTable):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = [table.ids(p.encode()) for p in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(ids, pa.list_(pa.int32()))], names=["_piece", "_ids"])
    return run


def _batched(columns: list[str]):
    """Rows of about ``BATCH_PIECES`` pieces as one: their distinct pieces, and the rows with the numbers of theirs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ends = np.concatenate([[0], np.cumsum(np.asarray(pc.list_value_length(b.column("_pieces"))))])
            lo = 0
            while lo < b.num_rows:
                hi = max(lo + 1, int(np.searchsorted(ends, ends[lo] + BATCH_PIECES, "right")) - 1)
                part = b.slice(lo, hi - lo)
                coded = part.column("_pieces").flatten().dictionary_encode()
                codes = pa.ListArray.from_arrays(pa.array((ends[lo:hi + 1] - ends[lo]).astype(np.int32)), coded.indices)
                rows = pa.StructArray.from_arrays([*(part.column(c) for c in columns), codes], names=[*columns, "_codes"])
                one = [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in (coded.dictionary, rows)]
                yield pa.RecordBatch.from_arrays([part.column("_row").slice(0, 1), *one], names=["_batch", "_dictionary", "_rows"])
                lo = hi
    return run


def _expand(columns: list[str], out: str):
    def run(batch: pa.Table, known: pa.Table) -> pa.Table:
        rows = batch["_rows"].combine_chunks().flatten()
        codes, own = rows.field("_codes"), known["_ids"].combine_chunks()
        place = np.empty(len(own), np.int64)
        place[np.asarray(known["_at"])] = np.arange(len(own))
        ids = own.take(pa.array(place[np.asarray(codes.flatten())]))
        sizes = np.concatenate([[0], np.cumsum(np.asarray(pc.list_value_length(ids)))])
        ends = np.concatenate([[0], np.cumsum(np.asarray(pc.list_value_length(codes)))])
        tokens = pa.ListArray.from_arrays(pa.array(sizes[ends].astype(np.int32)), ids.flatten())
        return pa.table([*(rows.field(c) for c in columns), tokens, pc.cast(pc.list_value_length(tokens), pa.int64())], names=[*columns, out, "n_tokens"])
    return run


def piece_ids(found: DataFrame, table: MergeTable) -> DataFrame:
    """(_piece, _ids) of distinct pieces."""
    return found.select("_piece").distinct().mapInArrow(_merge(table), "_piece string, _ids array<int>")


def encode_pieces(df: DataFrame, ids_of: Callable[[DataFrame], DataFrame], text_col: str, out: str, pattern: str, missing: list[int] | None = None) -> DataFrame:
    """The columns of ``df`` but its text, the ids ``out`` and ``n_tokens``; ``ids_of`` makes (_piece, _ids), a row per
    piece, from a table that holds the pieces to look up, and ``missing`` stands for a piece without a row.

    A null text is an empty one.  Names that begin with ``_piece`` and
    ``_batch``, ``_dictionary``, ``_row``, ``_codes``, ``_of``, ``_at``, ``_ids``, ``out`` and ``n_tokens`` are taken."""
    taken = {"_pieces", "_piece", "_batch", "_row", "_codes", "_of", "_at", "_ids", out, "n_tokens"} & set(df.columns) - {text_col}
    if taken:
        raise ValueError(f"columns {sorted(taken)} have names of this operator")
    own = [f for f in df.schema.fields if f.name != text_col]
    columns = [f.name for f in own]
    nullable = [T.StructField(f.name, f.dataType) for f in own]
    rows = df.select(*columns, pieces(F.col(text_col), pattern).alias("_pieces"), F.monotonically_increasing_id().alias("_row"))
    schema = T.StructType([T.StructField("_batch", T.LongType()), T.StructField("_dictionary", T.ArrayType(T.StringType())),
                           T.StructField("_rows", T.ArrayType(T.StructType([*nullable, T.StructField("_codes", T.ArrayType(T.IntegerType()))])))])
    with batch_rows(df.sparkSession, BATCH_ROWS):
        # stored, so that a batch's number stays what it is
        batches = stored(rows.mapInArrow(_batched(columns), schema), "pieces", **{"parquet.block.size": 16 << 20})
    found = batches.select(F.col("_batch").alias("_of"), F.posexplode("_dictionary").alias("_at", "_piece"))
    # a piece has at most one row per batch, so that no key of the join stands out
    held = found.join(stored(ids_of(found), "piece-ids"), "_piece", "left")
    if missing is not None:
        held = held.withColumn("_ids", F.coalesce("_ids", F.array(*[F.lit(i) for i in missing])))
    schema = T.StructType([*nullable, T.StructField(out, T.ArrayType(T.IntegerType())), T.StructField("n_tokens", T.LongType())])
    held = held.select("_of", "_at", "_ids")
    return batches.select("_batch", "_rows").groupBy("_batch").cogroup(held.groupBy("_of")).applyInArrow(_expand(columns, out), schema)


def encode_subwords(df: DataFrame, table: MergeTable, text_col: str = "text", out: str = "tokens", pattern: str = BYTE_LEVEL_PATTERN) -> DataFrame:
    """The columns of ``df`` but its text, the ids ``out`` of a merge table and ``n_tokens`` (T3); see ``encode_pieces``."""
    return encode_pieces(df, lambda found: piece_ids(found, table), text_col, out, pattern)
