"""Array operators: the three-way chunker (C1, C2, F6, F7), per-chunk training
pairs (C5, C6), packing a flat token stream into fixed windows (C3, C4, C5),
sample cap (C7) and batch assignment (C8).

All per-row work is array expressions (``sequence``/``transform``/``slice``);
packing moves only the token slices each window needs and groups by window id,
so every group holds at most L+1 tokens.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusflow.operators.ordering import Running, scan


def check_lengths(min_len: int, max_len: int, target: int) -> None:
    if target < 2:
        raise ValueError("target_length must be >= 2 (half-overlap stride would be 0)")
    if min_len < 0 or max_len < 0:
        raise ValueError("lengths must be non-negative")


def chunk_spans(n: Column, min_len: int, max_len: int, target: int, extra: int = 0) -> Column:
    """ARRAY<STRUCT<start INT, len INT>> of the chunks of a sequence of n tokens.

    n < min: none; n <= max: the whole sequence; else windows of ``target``
    starting at multiples of target div 2, stopping at the first window that
    reaches the end, dropping windows shorter than min.  With ``extra`` = 1 a window
    has a token more at the same stride: room for the last label, so that
    every full window gives a training pair (Q6)."""
    if extra < 0:
        raise ValueError("extra must be non-negative")
    check_lengths(min_len, max_len, target)
    half, width = target // 2, target + extra
    n = n.cast("int")
    last_k = F.greatest(F.lit(0), F.ceil((n - F.lit(width)) / F.lit(half)).cast("int"))
    windows = F.transform(
        F.sequence(F.lit(0), last_k),
        lambda k: F.struct((k * half).alias("start"),
                           F.least(F.lit(width), n - k * half).alias("len")))
    long_spans = F.filter(windows, lambda w: w["len"] >= min_len)
    whole = F.array(F.struct(F.lit(0).alias("start"), n.alias("len")))
    empty = F.filter(whole, lambda w: F.lit(False))
    return (F.when(n < min_len, empty)
            .when(n <= max_len, whole)
            .otherwise(long_spans))


def chunk(df: DataFrame, min_len: int = 256, max_len: int = 1024, target: int = 512,
          tokens_col: str = "tokens", extra: int = 0) -> DataFrame:
    """One row per chunk: chunk_idx, chunk_start, chunk (ARRAY<INT>), chunk_len.
    F6 (sequences shorter than min vanish) is applied before the explode."""
    # lengths come from ``n_tokens`` when present, so the spans (and every
    # consumer of chunk_len only) do not depend on the id array
    n = F.col("n_tokens") if "n_tokens" in df.columns else F.size(tokens_col)
    spans = chunk_spans(n, min_len, max_len, target, extra)
    exploded = (df.filter(n >= min_len)
                .select("*", F.posexplode(spans).alias("chunk_idx", "_span")))
    return (exploded
            .withColumn("chunk_start", F.col("_span.start"))
            .withColumn("chunk_len", F.col("_span.len").cast("bigint"))
            .withColumn("chunk", F.slice(F.col(tokens_col), F.col("_span.start") + 1,
                                         F.col("_span.len")))
            .drop("_span"))


def pair_starts(df: DataFrame, seq_len: int = 512) -> DataFrame:
    """C6 on lengths alone: one row per pair, ``pair_idx`` and ``pair_start``, of
    the windows starting at 0, L, 2L, ... < chunk_len - L.  A chunk of exactly L tokens gives no pair."""
    n = F.col("chunk_len")
    starts = F.sequence(F.lit(0), (n - F.lit(seq_len) - 1).cast("int"), F.lit(seq_len))
    return df.filter(n > seq_len).select("*", F.posexplode(starts).alias("pair_idx", "pair_start"))


def pair_arrays(df: DataFrame, seq_len: int = 512, chunk_col: str = "chunk") -> DataFrame:
    """C5 at ``pair_start``: x, and y = x shifted by one."""
    return (df.withColumn("x", F.slice(F.col(chunk_col), F.col("pair_start") + 1, seq_len))
            .withColumn("y", F.slice(F.col(chunk_col), F.col("pair_start") + 2, seq_len)))


def pairs_per_chunk(df: DataFrame, seq_len: int = 512, chunk_col: str = "chunk") -> DataFrame:
    """C6 + C5: all pairs of every chunk."""
    if "chunk_len" not in df.columns:
        df = df.withColumn("chunk_len", F.size(chunk_col).cast("bigint"))
    return pair_arrays(pair_starts(df, seq_len), seq_len, chunk_col)


def first_pairs(keys: DataFrame, order: list[str], seq_len: int = 512, max_pairs: int | None = None) -> DataFrame:
    """C7 on narrow rows (keys and ``chunk_len``, no ids): the first ``max_pairs``
    pairs in ``order`` and pair order; the caller builds ids for those alone.

    Every chunk in question gives a pair, so the first ``max_pairs`` chunks hold them
    all: each task keeps that many narrow rows."""
    if max_pairs is not None:
        keys = keys.filter(F.col("chunk_len") > seq_len).orderBy(*order).limit(max_pairs)
    pairs = pair_starts(keys, seq_len)
    return pairs if max_pairs is None else pairs.orderBy(*order, "pair_idx").limit(max_pairs)


def cap_samples(df: DataFrame, order: list[Column], max_samples: int | None) -> DataFrame:
    """The first max_samples rows in ``order`` (a top-k; the limit is the
    feature).  For pairs, ``first_pairs`` does it before any id is built."""
    if max_samples is None:
        return df
    return df.orderBy(*order).limit(max_samples)


def assign_batches(df: DataFrame, by: list[str], order: list[Column], bucket: Column,
                   batch_size: int = 16, accumulation: int = 2) -> DataFrame:
    """Consecutive batches of batch_size in ``order`` (last partial batch
    kept); update_id groups ``accumulation`` batches into one optimizer step."""
    with_ord = scan(df, by, order, bucket, [Running("sample_ord", "count", F.lit(1))])
    zero = F.col("sample_ord") - 1
    return (with_ord
            .withColumn("batch_id", F.floor(zero / F.lit(batch_size)).cast("bigint"))
            .withColumn("update_id", F.floor(F.col("batch_id") / F.lit(accumulation)).cast("bigint")))


def stream_offsets(df: DataFrame, order: list[Column], bucket: Column,
                   length_col: str = "chunk_len") -> DataFrame:
    """Exclusive prefix sum of lengths = each row's offset in the flat stream."""
    out = scan(df, [], order, bucket, [Running("_cum", "sum", F.col(length_col))])
    return out.withColumn("offset", (F.col("_cum") - F.col(length_col)).cast("bigint")).drop("_cum")


def pack_windows(df: DataFrame, total_tokens: int, seq_len: int = 512, stride: int | None = None,
                 tokens_col: str = "chunk", offset_col: str = "offset",
                 drop_ragged: bool = False) -> DataFrame:
    """C4 + C5 over the flat stream: window i covers [i*S, i*S + L + 1) so that
    x = first L tokens and y = the L tokens after the first.  The window count
    is max(0, (N - L) // S + 1); the last y is one short when the last window
    ends exactly at N (kept unless ``drop_ragged``).

    Each row contributes only its slice of each window it overlaps; windows
    are assembled by ``groupBy(window_id)`` (at most L+1 tokens per group)."""
    s = stride or seq_len
    n_windows = max(0, (total_tokens - seq_len) // s + 1)
    if n_windows == 0:
        return df.sparkSession.createDataFrame(
            [], "window_id BIGINT, x ARRAY<INT>, y ARRAY<INT>")
    off = F.col(offset_col)
    n = F.size(tokens_col).cast("bigint")
    span = seq_len + 1
    first = F.greatest(F.lit(0), F.floor((off - F.lit(span)) / F.lit(s)) + 1)
    last = F.least(F.lit(n_windows - 1), F.floor((off + n - 1) / F.lit(s)))
    # sequence(a, b) counts down when a > b: rows past the last window (or
    # before the first) must not explode at all
    parts = (df.filter((n > 0) & (first <= last))
             .select(off.alias("_off"), n.alias("_n"), F.col(tokens_col).alias("_t"),
                     F.explode(F.sequence(first.cast("bigint"), last.cast("bigint"))).alias("window_id")))
    w0 = F.col("window_id") * F.lit(s)
    lo = F.greatest(F.col("_off"), w0)
    hi = F.least(F.col("_off") + F.col("_n"), w0 + F.lit(span))
    pieces = parts.select(
        "window_id",
        F.struct(lo.alias("at"),
                 F.slice("_t", (lo - F.col("_off") + 1).cast("int"), (hi - lo).cast("int")).alias("ids"))
        .alias("piece"))
    grouped = pieces.groupBy("window_id").agg(F.array_sort(F.collect_list("piece")).alias("_p"))
    z = F.flatten(F.transform("_p", lambda p: p["ids"]))
    out = grouped.select("window_id", z.alias("_z")).select(
        "window_id", F.slice("_z", 1, seq_len).alias("x"), F.slice("_z", 2, seq_len).alias("y"))
    if drop_ragged:
        out = out.filter(F.size("y") == seq_len)
    return out
