"""Near-duplicate classes against all pairs, and how many edited copies the sketches find."""

import re
from collections import Counter

import numpy as np

from corpusflow.llm import graph, near_dups

SF = "/root/testdata/sf0.001/documents.parquet"


def word_runs(text):
    words = re.findall(r"(?:[^\W_]|[^\x00-\x7f])+", (text or "").lower())
    return [tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))] if words else []


def aligned(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = row
        row = [0]
        for j, y in enumerate(b):
            row.append(max(last[j] + 1 if x == y else 0, last[j + 1], row[j]))
    return row[-1]


def similar(a, b):
    need = 0.8 * (len(a) + len(b)) / 1.8 - 1e-9
    if sum((Counter(a) & Counter(b)).values()) < need:  # no alignment has more equal runs than that
        return False
    return aligned(a, b) >= need


def test_classes_against_all_pairs(spark):
    docs = spark.read.parquet(SF)
    rows = sorted((r.doc_id, tuple(word_runs(r.text))) for r in docs.collect())
    least = {}
    for i, seq in rows:
        if seq:
            least.setdefault(seq, i)
    names = sorted((i, s) for s, i in least.items())
    root = {i: i for i, _ in names}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i
    for n, (i, a) in enumerate(names):
        for j, b in names[n + 1:]:
            if top(i) != top(j) and similar(a, b):
                low, high = sorted((top(i), top(j)))
                root[high] = low
    want = {i: top(least[seq]) if seq else i for i, seq in rows}
    got = {r.doc_id: r.class_id for r in near_dups.near_duplicates(docs, key="doc_id", text="text").collect()}
    assert got == want


def test_sketches_find_edited_copies(spark):
    """Copies of 200 words with one to three words replaced: similarities from about 0.86 to 0.95."""
    rng = np.random.default_rng(11)
    rows, pairs = [], []
    for g in range(150):
        words = [f"w{x}" for x in rng.integers(0, 50_000, 200)]
        copy = list(words)
        for at in rng.choice(200, 1 + g % 3, replace=False):
            copy[at] = f"new{g}x{at}"
        rows += [(2 * g, " ".join(words)), (2 * g + 1, " ".join(copy))]
        if similar(word_runs(rows[-2][1]), word_runs(rows[-1][1])):
            pairs.append(g)
    cls = {r.doc_id: r.class_id for r in near_dups.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), key="doc_id", text="text").collect()}
    assert len(pairs) >= 140
    assert sum(cls[2 * g + 1] == 2 * g for g in pairs) >= 0.9 * len(pairs)
    assert all(c // 2 == i // 2 for i, c in cls.items())  # and links nothing else


def _written(monkeypatch, *modules):
    """Names and frames of the tables that an operator writes on its way."""
    found = {}
    for module in modules:
        def keep(df, name, own=module.stored, **options):
            found.setdefault(name, []).append(own(df, name, **options))
            return found[name][-1]
        monkeypatch.setattr(module, "stored", keep)
    return found


def test_pairs_with_a_hub_are_tested_once(spark, monkeypatch):
    """A bucket of two has no pair without a hub, so nothing of it is compared again."""
    found = _written(monkeypatch, near_dups)
    rows = [(g, " ".join(f"w{g}x{i}" for i in range(60))) for g in range(2)]
    monkeypatch.setattr(near_dups, "_sketch", _one_bucket)
    got = near_dups.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), key="doc_id", text="text").collect()
    assert sorted((r.doc_id, r.class_id) for r in got) == [(0, 0), (1, 1)]
    assert found["hub-pairs"][0].count() == 1 and found["apart"][0].count() == 0


def test_cells_of_many_blocks_join_all_similar_members(spark, monkeypatch):
    """One bucket, several pairs of similar members of which none is similar to a hub, of different lengths."""
    monkeypatch.setattr(near_dups, "BLOCK", 2)
    found = _written(monkeypatch, near_dups)
    rng = np.random.default_rng(5)
    head = [f"s{i}" for i in range(8)]
    rows = []
    for g in range(12):
        own = head + [f"g{g}w{x}" for x in rng.integers(0, 10_000, 20 + 3 * g)]
        rows += [(2 * g, " ".join(own)), (2 * g + 1, " ".join(own[:-3]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(near_dups, "_sketch", _one_bucket)
    got = {r.doc_id: r.class_id for r in near_dups.near_duplicates(docs, key="doc_id", text="text").collect()}
    want = {i: i - i % 2 if similar(word_runs(rows[i - i % 2][1]), word_runs(t)) else i for i, t in rows}
    assert got == want and len(set(want.values())) == 12
    assert sum(f.count() for f in found["rest-pairs"]) >= 4


def _one_bucket(batches, sketch=near_dups._sketch):
    import pyarrow as pa
    for b in sketch(batches):
        n = b.num_rows
        keys = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * near_dups.TABLES), pa.array(np.ones(n * near_dups.TABLES, np.int64)))
        yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(4)), keys], names=b.schema.names)


def test_stars_need_no_round(spark, monkeypatch):
    found = _written(monkeypatch, graph)
    stars = spark.createDataFrame([(1, 5), (1, 7), (2, 9)], "a long, b long")
    assert sorted(map(tuple, graph.components(stars).collect())) == [(1, 1), (2, 2), (5, 1), (7, 1), (9, 2)]
    assert list(found) == ["edges"]
    chain = spark.createDataFrame([(i, i + 1) for i in range(1, 20)] + [(30, 25), (25, 28), (28, 30)], "a long, b long")
    assert {r.id: r.component for r in graph.components(chain).collect()} == {i: 1 for i in range(1, 21)} | {25: 25, 28: 25, 30: 25}
    assert graph.components(chain.limit(0)).count() == 0
