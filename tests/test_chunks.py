import random

import pytest
from pyspark.sql import functions as F

from corpusflow.operators import chunks as C
from corpusflow.operators.ordering import range_bucket
from tests.models import chunk_loop, pairs_loop, windows_loop
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st


def _tokens_df(spark, seqs):
    return spark.createDataFrame([(i, list(s)) for i, s in enumerate(seqs)],
                                 "doc_id BIGINT, tokens ARRAY<INT>")


def test_chunker_matches_loop(spark):
    rng = random.Random(3)
    cases = []
    for n in [0, 5, 199, 200, 255, 256, 512, 513, 1024, 1025, 1536, 2048]:
        cases.append((n, 256, 1024, 512))
    for _ in range(120):
        t = rng.randint(2, 40)
        cases.append((rng.randint(0, 300), rng.randint(0, 30), rng.randint(0, 60), t))
    cases.append((200, 10, 100, 50))
    cases.append((200, 10, 100, 51))  # odd target
    for (n, lo, hi, t) in cases:
        df = _tokens_df(spark, [list(range(n))])
        got = [r["chunk"] for r in C.chunk(df, lo, hi, t).orderBy("chunk_idx").collect()]
        assert got == chunk_loop(list(range(n)), lo, hi, t), (n, lo, hi, t)


def test_chunker_fixture_values(spark):
    df = _tokens_df(spark, [list(range(200)), [1] * 5])
    out = C.chunk(df, 10, 100, 50).collect()
    assert sorted(r["chunk_start"] for r in out if r["doc_id"] == 0) == [0, 25, 50, 75, 100, 125, 150]
    assert all(r["chunk_len"] == 50 for r in out)
    assert not [r for r in out if r["doc_id"] == 1]


def test_rejects_zero_stride():
    with pytest.raises(ValueError):
        C.check_lengths(1, 2, 1)


@pytest.mark.parametrize("n,expected", [(8, 0), (9, 1), (16, 1), (17, 2)])
def test_pairs_per_chunk(spark, n, expected):
    df = spark.createDataFrame([(0, list(range(n)))], "doc_id BIGINT, chunk ARRAY<INT>")
    got = [(r["x"], r["y"]) for r in C.pairs_per_chunk(df, 8).orderBy("pair_idx").collect()]
    assert len(got) == expected
    assert got == [(list(x), list(y)) for x, y in pairs_loop(list(range(n)), 8)]


@pytest.mark.parametrize("lengths,seq_len,stride", [
    ([3, 2], 8, None),            # N < L
    ([5, 3], 8, None),            # N = L: one window, label one short
    ([4, 9, 1, 7], 4, 3),         # stride < L
    ([2, 25, 2], 5, 5),           # a chunk spanning several windows
    ([6, 6, 6, 6, 6], 4, 2),
])
def test_pack_matches_loop(spark, lengths, seq_len, stride):
    seqs, start = [], 100
    for n in lengths:
        seqs.append(list(range(start, start + n)))
        start += n
    flat = [t for s in seqs for t in s]
    df = spark.createDataFrame([(i, s, len(s)) for i, s in enumerate(seqs)],
                               "doc_id BIGINT, chunk ARRAY<INT>, chunk_len BIGINT")
    with_off = C.stream_offsets(df, [F.col("doc_id")], range_bucket(df, F.col("doc_id"), 3))
    got = [(r["x"], r["y"]) for r in
           C.pack_windows(with_off, len(flat), seq_len, stride).orderBy("window_id").collect()]
    assert got == [(list(x), list(y)) for x, y in windows_loop(flat, seq_len, stride)]


def test_batches_keep_partial(spark):
    df = spark.range(37).select(F.col("id").alias("doc_id"))
    out = C.assign_batches(df, [], [F.col("doc_id")], range_bucket(df, F.col("doc_id"), 5), 16, 2)
    rows = {r["doc_id"]: (r["batch_id"], r["update_id"]) for r in out.collect()}
    assert rows[0] == (0, 0) and rows[15] == (0, 0) and rows[16] == (1, 0)
    assert rows[32] == (2, 1) and rows[36] == (2, 1)



@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(1, 30), min_size=1, max_size=8), st.integers(2, 12), st.integers(1, 12))
def test_pack_property_against_loop(spark, lengths, seq_len, stride):
    seqs, start = [], 1000
    for n in lengths:
        seqs.append(list(range(start, start + n)))
        start += n
    flat = [t for s in seqs for t in s]
    df = spark.createDataFrame([(i, s, len(s)) for i, s in enumerate(seqs)],
                               "doc_id BIGINT, chunk ARRAY<INT>, chunk_len BIGINT")
    with_off = C.stream_offsets(df, [F.col("doc_id")], range_bucket(df, F.col("doc_id"), 2))
    got = [(r["x"], r["y"]) for r in
           C.pack_windows(with_off, len(flat), seq_len, stride).orderBy("window_id").collect()]
    assert got == [(list(x), list(y)) for x, y in windows_loop(flat, seq_len, stride)]


def test_wider_windows_match_slices(spark):
    """A token more per window at the same stride: every full window gives one pair of the target length."""
    df = _tokens_df(spark, [list(range(n)) for n in range(0, 70)])
    got = {}
    for r in C.chunk(df, 4, 20, 8, extra=1).collect():
        got.setdefault(len(r["tokens"]), []).append((r["chunk_idx"], r["chunk"]))
    for n in range(0, 70):
        seq = list(range(n))
        if n < 4:
            want = []
        elif n <= 20:
            want = [seq]
        else:
            starts = [0]
            while starts[-1] + 9 < n:
                starts.append(starts[-1] + 4)
            want = [w for w in (seq[s:s + 9] for s in starts) if len(w) >= 4]
        assert [c for _, c in sorted(got.get(n, []))] == want, n
        if n > 20:
            full = [w for w in want if len(w) == 9]
            assert full and all(len(pairs_loop(w, 8)) == 1 for w in full)
