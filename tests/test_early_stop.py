"""Early stop of caps and budgets: same rows as ordering everything, from a part of the rows."""

import pytest
from pyspark.sql import functions as F

from corpusflow.operators import mixing as M
from corpusflow.operators.ordering import BKT, range_bucket

WEIGHTS = {"a": 0.6, "b": 0.3, "c": 0.1, "unused": 0.0}


@pytest.fixture(scope="module")
def chunks(spark, tmp_path_factory):
    n = 60_000
    rows = spark.range(n).select(
        F.when(F.col("id") % 10 < 6, "a").when(F.col("id") % 10 < 9, "b").otherwise("c").alias("source"),
        F.col("id").alias("doc_id"), F.lit(0).cast("bigint").alias("chunk_idx"), (F.col("id") % 97 + 1).alias("chunk_len"))
    extra = spark.createDataFrame([("other", 5, 0, 9), ("unused", 6, 0, 9), ("c", None, 0, 50)], "source string, doc_id long, chunk_idx long, chunk_len long")
    path = str(tmp_path_factory.mktemp("early") / "chunks")
    rows.unionByName(extra).repartitionByRange(12, "doc_id").write.parquet(path)
    return spark.read.parquet(path)


def catalog(spark, caps=None):
    rows = [(s, i, w, (caps or {}).get(s)) for i, (s, w) in enumerate(WEIGHTS.items())]
    return spark.createDataFrame(rows, "source STRING, source_ord INT, weight DOUBLE, cap BIGINT")




def order():
    return [F.col("doc_id"), F.col("chunk_idx")]


def everything(chunks, cat, mode):
    arr = M.arrivals(chunks, cat, order(), range_bucket(chunks, F.col("doc_id"), 40), mode=mode, seed=3)
    return M.mix_order(arr, M.mix_bucket(M.catalog_weights(cat)), [F.col("source_ord"), *order()])


@pytest.mark.parametrize("mode", ["deterministic", "race"])
@pytest.mark.parametrize("budget", [5_000, 10**9])
def test_budget_equals_full_order(spark, chunks, mode, budget):
    cat = catalog(spark)
    want = M.budget_cut(everything(chunks, cat.drop("cap"), mode), budget)
    first = M.first_arrivals(chunks, cat, order(), range_bucket(chunks, F.col("doc_id"), 40), "doc_id", mode=mode, seed=3, target_tokens=budget)
    got = M.budget_cut(M.mix_order(first, M.mix_bucket(M.catalog_weights(cat)), [F.col("source_ord"), *order()]), budget)
    cols = ["source", "doc_id", "mix_t", "mix_ord", "mix_cum"]
    assert sorted(map(str, got.select(*cols).collect())) == sorted(map(str, want.select(*cols).collect()))


def test_caps_equal_full_order(spark, chunks):
    caps = {"a": 1000, "b": 0, "c": None, "unused": 5}
    cat = catalog(spark, caps)
    bucket = range_bucket(chunks, F.col("doc_id"), 40)
    full = M.cap_per_source(M.per_source_ordinal(chunks.filter("source <> 'other'"), order(), bucket), cat)
    got = M.first_arrivals(chunks, cat, order(), bucket, "doc_id", mode=None)
    cols = ["source", "doc_id", "src_ord"]
    assert sorted(map(str, got.select(*cols).collect())) == sorted(map(str, full.select(*cols).collect()))


def test_second_phase_reads_in_proportion_to_the_budget(spark, chunks):
    total = chunks.count()
    seen = {}
    for budget in (20_000, 200_000, 1_000_000):
        bucket = range_bucket(chunks, F.col("doc_id"), 64)
        w = catalog(spark).select("source", "source_ord", F.col("weight").alias("_w"), "cap").filter("_w > 0")
        rows = chunks.join(F.broadcast(w), "source").withColumns({BKT: bucket, "_step": F.lit(0).cast("bigint")})
        found = M.reach(rows, "doc_id", budget, "deterministic")
        inside = rows.filter(found.on_scan).join(F.broadcast(found.buckets), ["source", BKT])
        seen[budget] = inside.count()
        needed = budget / 49  # tokens of a mean chunk
        assert needed <= seen[budget] <= 2 * needed + 6 * total / 64
        plan = inside._jdf.queryExecution().executedPlan().toString()
        assert "LessThanOrEqual(doc_id" in plan  # the bound reaches the file scan
    assert seen[20_000] < total / 10 and seen[20_000] < seen[200_000] < seen[1_000_000]


def test_caps_alone_stop_each_source(spark, chunks):
    bucket = range_bucket(chunks, F.col("doc_id"), 64)
    w = catalog(spark, {"a": 100, "b": 100, "c": 100, "unused": 0}).select("source", F.col("weight").alias("_w"), "cap")
    rows = chunks.join(F.broadcast(w), "source").withColumns({BKT: bucket, "_step": F.lit(0).cast("bigint")})
    found = M.reach(rows, "doc_id", None, None)
    assert rows.filter(found.on_scan).join(F.broadcast(found.buckets), ["source", BKT]).count() < 4_000


def test_empty_rows(spark, chunks):
    none = chunks.filter(F.lit(False))
    got = M.first_arrivals(none, catalog(spark), order(), range_bucket(none, F.col("doc_id")), "doc_id", target_tokens=100)
    assert got.count() == 0
