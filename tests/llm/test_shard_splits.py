"""Large shards of the embedding graph are split to any depth; the audit is spread over a label's blocks."""

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusflow.llm import embeddings

KIND = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.DoubleType())), T.StructField("label", T.IntegerType())])


def links_by_brute_force(rows):
    v = np.array([r[1] for r in rows])
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    lab = np.array([r[2] for r in rows])
    s = (v @ v.T >= 0.93) & (lab[:, None] == lab)
    np.fill_diagonal(s, False)
    return s.sum(1)


def scattered(n, groups, seed=2):
    rng = np.random.default_rng(seed)
    centers = rng.normal(size=(groups, 16))
    return [(i, [float(x) for x in centers[i % groups] + rng.normal(size=16) * 0.15], 1 + i % 2) for i in range(n)]


def one_centroid(vectors, *_):
    return {(label, 16): np.ones((1, 16)) / 4 for label in (1, 2)}


def test_split_to_any_depth_keeps_the_graph(spark, monkeypatch):
    rows = scattered(3000, 1000)  # groups of three: far from a share DENSE of a shard
    depth = []
    split = embeddings.split_shards

    def recorded(members, overlap, threshold):
        out = split(members, overlap, threshold)
        sizes = out.groupBy("shard").count().select(F.max("count"), F.max(F.shiftright("shard", 58))).first()
        depth.append(tuple(sizes))
        return out

    def never(*_):
        raise AssertionError("a shard without a graph")
    monkeypatch.setattr(embeddings, "fit_centroids", one_centroid)
    monkeypatch.setattr(embeddings, "split_shards", recorded)
    monkeypatch.setattr(embeddings, "compare_all", never)
    monkeypatch.setattr(embeddings, "MAX_SHARD", 150)
    monkeypatch.setattr(embeddings, "SHARD_SAMPLE", 40)  # ten parts at most, so one split isn't enough
    monkeypatch.setattr(embeddings, "TARGET", 60)
    got = {r.vec_id: r for r in embeddings.near_duplicate_vectors(spark.createDataFrame(rows, KIND), key="vec_id", vector="embedding", label="label", every=5).collect()}
    want = links_by_brute_force(rows)
    assert all(most <= 150 and level >= 2 for most, level in depth)
    assert all(got[i].n_links <= n for i, n in enumerate(want))
    for label in (1, 2):
        of = [i for i, _, x in rows if x == label]
        assert sum(got[i].n_links for i in of) >= 0.9 * want[of].sum()
    assert all(got[i].audit_links == n for i, n in enumerate(want) if i % 5 == 0)


def test_near_copies_are_not_split(spark, monkeypatch):
    rng = np.random.default_rng(7)
    rows = [(i, [float(x) for x in 1 + rng.normal(size=16) * 0.05], 1) for i in range(600)]
    monkeypatch.setattr(embeddings, "MAX_SHARD", 150)
    monkeypatch.setattr(embeddings, "EXACT_BLOCK", 100)
    monkeypatch.setattr(embeddings, "fit_centroids", one_centroid)
    members = spark.createDataFrame([(i, x, 1, 0) for i, x, _ in rows], "id long, x array<double>, n_copies long, shard long")
    assert embeddings.split_shards(members, 2, 0.93) is members
    out = embeddings.near_duplicate_vectors(spark.createDataFrame(rows, KIND), key="vec_id", vector="embedding", label="label").collect()
    assert {r.vec_id: r.n_links for r in out} == dict(enumerate(links_by_brute_force(rows).tolist()))


@pytest.mark.parametrize("block", [16, 512])
def test_audit_of_one_label_is_many_pairs(spark, monkeypatch, block):
    rows = [(i, x, 1) for i, x, _ in scattered(300, 20)]
    monkeypatch.setattr(embeddings, "BLOCK", block)
    monkeypatch.setattr(embeddings, "CHUNK_BLOCKS", 2)
    v = spark.createDataFrame([(i, i, label, x, 1) for i, x, label in rows], "id long, vec_id long, label long, x array<double>, n_copies long")
    got = {r.id: r.audit_links for r in embeddings._audit(v, 0.93, 3).collect()}
    want = links_by_brute_force(rows)
    assert all(got[i] == want[i] for i in range(0, 300, 3)) and all(want[i] == n for i, n in got.items())


def test_the_batch_size_of_the_session_stays(spark):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    embeddings.small_batches(spark)
    before = spark.conf.get(name)
    embeddings.near_duplicate_vectors(spark.createDataFrame(scattered(60, 5), KIND), key="vec_id", vector="embedding", label="label").count()
    assert spark.conf.get(name) == before
