"""The centroids are fitted by tasks; the audit's cells agree with brute force."""

import tracemalloc

import numpy as np

from corpusflow.llm import embeddings


def test_the_driver_gets_the_centroids_alone(spark):
    rng = np.random.default_rng(1)
    rows = [(i, 0, [float(c) for c in x]) for i, x in enumerate(rng.normal(size=(4000, 16)))]
    vectors = spark.createDataFrame(rows, "id long, label long, x array<double>").localCheckpoint()
    tracemalloc.start()
    got = embeddings.fit_centroids(vectors, target=4)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert {g: c.shape for g, c in got.items()} == {(0, 16): (1000, 16)}
    assert most < 8e6  # vectors x centroids are 32 MB


def test_centroids_by_label_and_length(spark):
    rng = np.random.default_rng(2)
    rows = [(i, i % 2, [float(c) for c in rng.normal(size=4 + i % 3)]) for i in range(300)]
    got = embeddings.fit_centroids(spark.createDataFrame(rows, "id long, label long, x array<double>"), target=10)
    assert {g: c.shape for g, c in got.items()} == {(label, d): (5, d) for label in (0, 1) for d in (4, 5, 6)}
    assert all(np.allclose(np.linalg.norm(c, axis=1), 1) for c in got.values())
    assert embeddings.fit_centroids(spark.createDataFrame([], "id long, label long, x array<double>")) == {}


def test_audit_of_mixed_lengths_and_copies(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "BLOCK", 16)
    monkeypatch.setattr(embeddings, "CHUNK_BLOCKS", 1)
    rng = np.random.default_rng(5)
    centers = {d: rng.normal(size=(4, d)) for d in (6, 9)}
    rows = []
    for i in range(240):
        d = (6, 9)[i % 2]
        rows.append((i, i if i % 11 else None, i // 2 % 3, [float(c) for c in (centers[d][i % 4] + rng.normal(size=d) * 0.2) * 10.0 ** rng.integers(-3, 4)], 1 + i % 3))
    v = spark.createDataFrame(rows, "id long, vec_id long, label long, x array<double>, n_copies long")
    got = {r.id: r.audit_links for r in embeddings._audit(v, 0.93, 2).collect()}
    want = {}
    for i, _, label, x, _ in rows:
        x = np.array(x)
        want[i] = sum(n for j, _, other, y, n in rows if j != i and other == label and len(y) == len(x) and x @ np.array(y) / (np.linalg.norm(x) * np.linalg.norm(y)) >= 0.93)
    assert all(got[i] == want[i] for i, name, *_ in rows if name is not None and name % 2 == 0)
    assert all(want[i] == n for i, n in got.items()) and sum(want.values()) > 0
