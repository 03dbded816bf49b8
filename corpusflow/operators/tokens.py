"""Text -> token ids (T1), vocabulary (T2), token counts.

Encoders:
* ``encode_hashed``: stateless id = md5(piece) mod V, computed inside the row
  (no shuffle, no lookup table; a task hashes each of its pieces once) - the default of the corpus plan;
* ``build_vocab`` + ``encode_vocab``: a frequency vocabulary computed on the
  cluster (top V-1 pieces by count, id 0 = unknown) and an encoder that joins distinct pieces.

Subword ids by a tokenizer's merge table are in ``subwords``.
"""

from __future__ import annotations

from array import array
from collections import Counter
from collections.abc import Iterator
from hashlib import md5

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusflow.functions.text import PIECE_PATTERN, n_pieces, pieces, split_texts
from corpusflow.operators.ordering import Running, range_bucket, scan
from corpusflow.operators.subwords import encode_pieces

# Fixed value: the vocabulary size of the reference configuration.
DEFAULT_VOCAB = 50257


def hashed_id(piece: Column, vocab_size: int = DEFAULT_VOCAB, id_fn: str = "md5") -> Column:
    """Stateless piece id in [0, vocab_size).  ``md5`` (default) is
    reproducible in plain SQL engines; ``xxhash64`` is a native 64-bit hash,
    much cheaper per token, for runs that do not need an external check."""
    if id_fn == "xxhash64":
        return F.pmod(F.xxhash64(piece), F.lit(vocab_size)).cast("int")
    if id_fn != "md5":
        raise ValueError(f"unknown id function {id_fn}")
    return F.pmod(F.conv(F.substring(F.md5(piece), 1, 8), 16, 10).cast("bigint"),
                  F.lit(vocab_size)).cast("int")


KNOWN_PIECES = 1 << 18  # of a task: some tens of megabytes


class _Md5Ids(dict):
    """Ids of the pieces met so far."""

    def __init__(self, vocab_size: int):
        super().__init__()
        self.vocab_size = vocab_size

    def __missing__(self, piece: str) -> int:
        if len(self) >= KNOWN_PIECES:
            self.clear()
        found = self[piece] = int(md5(piece.encode(), usedforsecurity=False).hexdigest()[:8], 16) % self.vocab_size
        return found


def md5_ids(text: Column, vocab_size: int = DEFAULT_VOCAB) -> Column:
    """``hashed_id`` by md5 of a text's whitespace pieces."""
    def ids(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known = _Md5Ids(vocab_size)
        for texts in batches:
            flat, ends = array("i"), [0]
            for own in split_texts(texts):
                flat.extend(map(known.__getitem__, own))
                ends.append(len(flat))
            yield pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.array(flat, np.int32)))
    return F.arrow_udf(ids, "array<int>")(text)


def encode_hashed(df: DataFrame, text_col: str = "text", vocab_size: int = DEFAULT_VOCAB,
                  pattern: str = PIECE_PATTERN, out: str = "tokens", id_fn: str = "md5") -> DataFrame:
    """ARRAY<INT> of hashed piece ids plus ``n_tokens``.

    ``n_tokens`` does not reference the id array, so plans that only need
    lengths (chunk spans, budgets, mixing) never compute the md5 ids: column
    pruning removes them."""
    if id_fn == "md5" and pattern == PIECE_PATTERN:
        ids = md5_ids(F.col(text_col), vocab_size)
    else:
        ids = F.transform(pieces(F.col(text_col), pattern), lambda p: hashed_id(p, vocab_size, id_fn))
    return (df.withColumn(out, ids)
            .withColumn("n_tokens", n_pieces(F.col(text_col), pattern)))


def token_count(df: DataFrame, text_col: str = "text", pattern: str = PIECE_PATTERN) -> DataFrame:
    """T3 without materialising ids."""
    return df.withColumn("n_tokens", n_pieces(F.col(text_col), pattern))


PREFIX_BYTES = 7  # 56 bits: what a BIGINT holds


def utf8_prefix_bucket(piece: Column) -> Column:
    """BIGINT of the first seven UTF-8 bytes (zero padded): non-decreasing in
    the byte-wise order Spark uses to compare strings."""
    head = F.hex(F.substring(F.encode(piece, "UTF-8"), 1, PREFIX_BYTES))
    return F.conv(F.rpad(head, 2 * PREFIX_BYTES, "0"), 16, 10).cast("bigint")


def _count_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        counts = Counter()
        for own in split_texts(b.column(0)):
            counts.update(own)
        yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["piece", "n"])


def piece_counts(df: DataFrame, text_col: str = "text", pattern: str = PIECE_PATTERN) -> DataFrame:
    """(piece, cnt); of whitespace pieces a task sends one row per Arrow batch and distinct piece."""
    if pattern == PIECE_PATTERN:
        rows = df.select(text_col).mapInArrow(_count_pieces, "piece string, n long")
    else:
        rows = df.select(F.explode(pieces(F.col(text_col), pattern)).alias("piece"), F.lit(1).cast("long").alias("n"))
    return rows.groupBy("piece").agg(F.sum("n").alias("cnt"))


def build_vocab(df: DataFrame, vocab_size: int = DEFAULT_VOCAB, text_col: str = "text",
                pattern: str = PIECE_PATTERN) -> DataFrame:
    """(piece, id, cnt) for the vocab_size-1 most frequent pieces, ranked by
    count desc then piece; id 0 is reserved for unknown pieces.

    No global sort of all distinct pieces: a histogram of counts (at most
    vocab_size rows reach the driver) gives the cut-off count; pieces above it
    are in, the tie tier at it is ranked by piece with a bucketed scan, and
    only the <= V chosen rows are ranked in one window."""
    slots = vocab_size - 1
    # read three times below: computed once and cut from lineage (a reliable
    # checkpoint in the shared folder survives lost executors)
    counts = piece_counts(df, text_col, pattern).checkpoint()
    hist = (counts.groupBy("cnt").agg(F.count(F.lit(1)).alias("k"))
            .orderBy(F.desc("cnt")).limit(slots).collect())
    taken, cutoff = 0, None
    for row in hist:
        if taken + row["k"] >= slots:
            cutoff = row["cnt"]
            break
        taken += row["k"]
    if cutoff is None:
        chosen = counts
    else:
        above = counts.filter(F.col("cnt") > cutoff)
        # the tie tier at the cut-off can be large: rank it with a bucketed
        # scan (quantile buckets of the first UTF-8 bytes, monotone in Spark's byte
        # order) instead of an ordered limit that funnels rows into one task
        tier = counts.filter(F.col("cnt") == cutoff)
        ranked = scan(tier, [], [F.col("piece")], range_bucket(tier, utf8_prefix_bucket(F.col("piece"))),
                      [Running("_r", "count", F.lit(1))], materialize=False)
        at = ranked.filter(F.col("_r") <= slots - taken).select("piece", "cnt")
        chosen = above.unionByName(at)
    # At most vocab_size-1 rows: a single ordered window is bounded.
    rank = F.row_number().over(Window.orderBy(F.desc("cnt"), F.col("piece")))
    return chosen.select("piece", rank.cast("int").alias("id"), F.col("cnt").cast("bigint"))


def encode_vocab(df: DataFrame, vocab: DataFrame, key: list[str], text_col: str = "text",
                 pattern: str = PIECE_PATTERN, out: str = "tokens") -> DataFrame:
    """T1 with a vocabulary: ``key`` columns, the id array and ``n_tokens``; unknown pieces get 0.

    A task's batch of rows meets each of its distinct pieces once: what is shuffled
    and joined is a row per (batch, distinct piece), and ids come back by a lookup inside
    the row.  Texts without pieces give an empty array."""
    known = vocab.select(F.col("piece").alias("_piece"), F.array(F.col("id").cast("int")).alias("_ids"))
    return encode_pieces(df.select(*key, text_col), lambda found: known, text_col, out, pattern, missing=[0])
