"""Order keys of any BIGINT, the vocabulary's tie tier and encoder, and run logs in which a rule can fail."""

import random

import pytest
from pyspark.sql import functions as F

from corpusflow.operators import runlog as R
from corpusflow.operators.dedup import dedup_first, order_key
from corpusflow.operators.ordering import range_bucket
from corpusflow.operators.tokens import build_vocab, encode_vocab, utf8_prefix_bucket
from corpusflow.plans import runlog_queries as Q
from tests.conftest import SF_SMALL

DOCS = "source_ord INT, doc_ord BIGINT, text STRING"


def test_order_keys_sort_like_their_columns(spark):
    edge = [-(1 << 63), -1, 0, 1, (1 << 47) - 1, 1 << 47, (1 << 63) - 1]
    pairs = [(s, d) for s in (0, 1, 65_535, 65_536, (1 << 31) - 1) for d in edge]
    df = spark.createDataFrame([(*p, "") for p in pairs], DOCS)
    rows = df.select("source_ord", "doc_ord", order_key(["source_ord", "doc_ord"]).alias("k")).collect()
    assert [(r.source_ord, r.doc_ord) for r in sorted(rows, key=lambda r: r.k)] == sorted(pairs)
    assert len({r.k for r in rows}) == len(pairs)


def test_first_copy_with_far_order_keys(spark):
    rows = [(70_000, 5, "a"), (70_000, 1 << 50, "b"), (3, (1 << 63) - 1, "a"), (3, 1 << 60, "b"), (4, -(1 << 63), "c"), (4, 7, "c")]
    kept = {(r.source_ord, r.doc_ord) for r in dedup_first(spark.createDataFrame(rows, DOCS)).collect()}
    assert kept == {min((s, d) for s, d, t in rows if t == own) for own in "abc"}


def test_null_order_key_is_an_error(spark):
    with pytest.raises(Exception, match="order column is null"):
        dedup_first(spark.createDataFrame([(0, None, "a"), (0, 1, "b")], DOCS)).collect()


def test_first_copy_is_found_by_hash_aggregation(spark):
    keyed = spark.createDataFrame([(0, 1, "a")], DOCS).select(F.sha2("text", 256).alias("h"), order_key(["source_ord", "doc_ord"]).alias("k"))
    plan = keyed.groupBy("h").agg(F.min("k"))._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan


def test_tie_tier_with_one_beginning_is_spread(spark):
    df = spark.range(20_000).select(F.format_string("the%06d", "id").alias("piece"))
    b = df.withColumn("b", range_bucket(df, utf8_prefix_bucket(F.col("piece")), 32))
    assert b.groupBy("b").count().agg(F.max("count")).first()[0] <= 20_000 // 8
    vocab = build_vocab(df.select(F.col("piece").alias("text")), 501)
    assert [r.piece for r in vocab.orderBy("id").collect()] == [f"the{i:06d}" for i in range(500)]


def test_vocabulary_ids_against_a_loop(spark):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(60)] + ["é", "日本"]
    texts = [" ".join(rng.choices(words, k=rng.randrange(40))) for _ in range(300)] + [None, "", "   ", "w1 " * 20_000, "w1 unseen w1"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id BIGINT, text STRING").repartition(5)
    vocab = build_vocab(df, 41)
    ids = {r.piece: r.id for r in vocab.collect()}
    assert len(ids) == 40 and "unseen" not in ids
    got = {r.doc_id: (r.tokens, r.n_tokens) for r in encode_vocab(df, vocab, ["doc_id"]).collect()}
    for i, text in enumerate(texts):
        want = [ids.get(p, 0) for p in (text or "").split()]
        assert got[i] == (want, len(want))
    assert encode_vocab(df.limit(0), vocab, ["doc_id"]).count() == 0


def test_compat_throughput(spark):
    df = spark.createDataFrame([(None,), (0.0,), (2.0,)], "s DOUBLE")
    assert [r[0] for r in df.select(R.throughput(R.compat_tokens(F.lit(64), 4), F.col("s"))).collect()] == [None, 0.0, 128.0]


def test_resumed_log_has_both_outcomes_of_each_rule(spark):
    audit = {r.present: r["count"] for r in Q.cadence_audit_gaps(spark, SF_SMALL).groupBy("present").count().collect()}
    shown = {r.accepted for r in Q.monotone_resumed(spark, SF_SMALL).select("accepted").distinct().collect()}
    log = Q.resumed_log(spark, SF_SMALL)
    counts = log.select(F.count("*"), F.count("step"), F.count("loss")).first()
    assert set(audit) == {True, False} and shown == {True, False}
    assert counts[1] < counts[0] > counts[2]
    places = Q.metric_series_gaps(spark, SF_SMALL).filter("metric = 'perplexity' AND x = seq - 1 AND seq > 1")
    assert places.count() > 0
