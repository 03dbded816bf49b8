"""Synthetic token source (S10): the trainer's fallback when no source can be
read.  Uniform ids in [0, vocab) cut into pieces of ``piece_len`` tokens.

Seeded and hash-based (md5 of seed:position), so a recomputed partition
gives the same ids; each piece is one group of at most ``piece_len`` rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow.operators.tokens import DEFAULT_VOCAB


def synthetic_positions(spark: SparkSession, n_tokens: int, vocab_size: int = DEFAULT_VOCAB,
                        seed: int = 0) -> DataFrame:
    """(pos, id) for n_tokens positions."""
    key = F.concat_ws(":", F.lit(str(seed)), F.col("id").cast("string"))
    tok = F.pmod(F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("bigint"), F.lit(vocab_size))
    return spark.range(n_tokens).select(F.col("id").alias("pos"), tok.cast("int").alias("tok"))


def synthetic_pieces(spark: SparkSession, n_tokens: int, piece_len: int,
                     vocab_size: int = DEFAULT_VOCAB, seed: int = 0) -> DataFrame:
    """(piece_id, tokens ARRAY<INT>): consecutive pieces of piece_len ids."""
    pos = synthetic_positions(spark, n_tokens, vocab_size, seed)
    grouped = (pos.groupBy(F.floor(F.col("pos") / piece_len).alias("piece_id"))
               .agg(F.array_sort(F.collect_list(F.struct("pos", "tok"))).alias("_z")))
    return grouped.select("piece_id", F.transform("_z", lambda s: s["tok"]).alias("tokens"))
