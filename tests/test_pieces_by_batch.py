"""Pieces and their ids by Arrow batches are those of the expressions."""

from pyspark.sql import functions as F


def test_pieces_and_ids_agree_with_the_expressions(spark):
    from corpusflow.functions.text import PIECE_PATTERN, n_pieces, pieces
    from corpusflow.operators import tokens as K
    texts = [None, "", " ", "a b  a c", "é x　y\x1cz\u0085w", "ends ", "﻿bom a​b ᠎c", " ".join(f"w{i % 700}" for i in range(2000))]
    df = spark.createDataFrame(list(enumerate(texts)), "id INT, text STRING")
    own = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(PIECE_PATTERN), 0)
    for r in K.encode_hashed(df).select("tokens", "n_tokens", F.transform(own, lambda p: K.hashed_id(p)).alias("ids"), own.alias("own"), pieces(F.col("text")).alias("ps"), n_pieces(F.col("text")).alias("n")).collect():
        assert r["tokens"] == r["ids"] and r["ps"] == r["own"] and r["n"] == r["n_tokens"] == len(r["own"])


def test_known_pieces_are_bounded(monkeypatch):
    from corpusflow.operators import tokens as K
    monkeypatch.setattr(K, "KNOWN_PIECES", 3)
    known = K._Md5Ids(1000)
    first = [known[p] for p in "abcdefga"]
    assert first[0] == first[-1] and len(known) <= 3


def test_counts_are_sent_per_distinct_piece(spark):
    import pyarrow as pa
    from corpusflow.operators.tokens import _count_pieces, piece_counts
    texts = ["a b a", None, "", "c a", "b b"]
    got = list(_count_pieces(iter([pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], names=["text"])])))
    assert [dict(zip(b.column(0).to_pylist(), b.column(1).to_pylist())) for b in got] == [{"a": 3, "b": 3, "c": 1}]
    df = spark.createDataFrame([(t,) for t in texts], "text STRING").repartition(3)
    assert {r["piece"]: r["cnt"] for r in piece_counts(df).collect()} == {"a": 3, "b": 3, "c": 1}
    assert {r["piece"]: r["cnt"] for r in piece_counts(df, pattern="a|c").collect()} == {"a": 3, "c": 1}
