"""Vector codes against a plain model in Python integers."""

import hashlib
import math

import numpy as np
import pytest

from corpusflow.llm import codes

SCHEMA = "vec_id long, embedding array<double>, label int, code string, key string, x int, error long, _often long, _n int"


def model(rows, parts=8, entries=16, rounds=6):
    kept = [(k, x, y) for k, x, y in rows if x is not None and all(v is not None and math.isfinite(v) and abs(v) < 2**70 for v in x)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    if not kept:
        return [], [[] for _ in range(parts)]
    d = len(kept[0][1])
    ints = [[math.floor(4096 * v) for v in x] if len(x) == d else None for _, x, _ in kept]
    cut = [(i * d // parts, (i + 1) * d // parts) for i in range(parts)]
    books = [[v[lo:hi] for v in ints[:entries] if v] for lo, hi in cut]

    def near(p, s):
        away = [sum((a - b) ** 2 for a, b in zip(s, c, strict=True)) for c in books[p]]
        return min((v, e) for e, v in enumerate(away))
    for _ in range(rounds):
        new = []
        for p, (lo, hi) in enumerate(cut):
            groups = {}
            for v in ints:
                if v:
                    groups.setdefault(near(p, v[lo:hi])[1], []).append(v[lo:hi])
            new.append([[sum(c) // len(groups[e]) for c in zip(*groups[e], strict=True)] if e in groups else old for e, old in enumerate(books[p])])
        books = new
    out = []
    for (k, _, y), v in zip(kept, ints, strict=True):
        if v is None:
            out.append([k, y, None, None])
            continue
        best = [near(p, v[lo:hi]) for p, (lo, hi) in enumerate(cut)]
        error = sum(a for a, _ in best)
        out.append([k, y, "".join(f"{e:02x}" for _, e in best), error if error < 2**63 else None])
    for r in out:
        same = [q[3] for q in out if q[1] == r[1] and q[3] is not None]
        total = sum(same) if same else None
        r.append(total if total is None or total < 2**63 else None)
    return out, books


def run(spark, rows, **args):
    df = spark.createDataFrame([(*r, "c", "k", 1, 2, 3, 4) for r in rows], SCHEMA).repartition(3)
    found = codes.compress(df, key="vec_id", vector="embedding", label="label", **args)
    got = codes.with_label_error(found.codes).collect()
    return sorted(([r.key, r.label, r.code, r.error, r.label_error] for r in got), key=repr), found


def vectors(seed, n, d, spread=1.0):
    rng = np.random.default_rng(seed)
    return (rng.normal(0, spread, (n, d)) + rng.choice([-1, 0, 2], (n, 1))).tolist()


def check(spark, rows, **args):
    got, found = run(spark, rows, **args)
    want, books = model(rows, **{k: v for k, v in args.items() if k != "cells"})
    assert got == sorted(want, key=repr)
    assert not rows or found.codebooks == books
    return found


def test_against_model(spark):
    base = vectors(1, 300, 16)
    rows = [(i, x, i % 5 if i % 7 else None) for i, x in enumerate(base)]
    rows += [(1000 + i, base[3], 1) for i in range(120)]  # a group of copies
    rows += [(3, base[9], 2), (3, base[3], 2), (None, base[4], None), (5, base[5], 0)]  # repeated and null keys
    rows += [(-1, None, 1), (-2, [0.5] * 15 + [None], 1), (-3, [float("nan")] * 16, 1), (-4, [float("inf")] + [0.0] * 15, 2), (-5, [2.0**71] * 16, 2)]
    rows += [(2000, [0.1] * 8, 1), (2001, [], None), (2002, [0.0] * 16, 3)]  # other lengths; all zeros
    found = check(spark, rows, cells=16 * 64)  # several chunks a task
    assert found.digest() == hashlib.sha256(",".join(str(v) for b in found.codebooks for c in b for v in c).encode()).hexdigest()
    check(spark, rows)


def test_lengths_that_parts_do_not_divide(spark):
    check(spark, [(i, x, 1) for i, x in enumerate(vectors(2, 80, 11))])
    check(spark, [(i, x, 1) for i, x in enumerate(vectors(3, 40, 3))])  # parts without components


@pytest.mark.parametrize("scale", [1e6, 3e8, 1e15])
def test_large_components(spark, scale):
    rows = [(i, [v * scale for v in x], i % 2) for i, x in enumerate(vectors(4, 60, 8))]
    rows += [(100 + i, x, 0) for i, x in enumerate(vectors(5, 60, 8))]
    check(spark, rows)


def test_few_ties_and_empty(spark):
    check(spark, [(i, [0.25] * 8, None) for i in range(40)])  # all entries equal: the lowest
    check(spark, [(i, [float(i)] * 8, i) for i in range(5)])
    check(spark, [])
    check(spark, [(1, None, 1)])


def test_blocks_spare_kernels(spark):
    """Blocks far from all entries but one are settled by their boxes."""
    rng = np.random.default_rng(6)
    centres = rng.normal(0, 5, (16, 16))
    rows = [(i, (centres[i % 16] + rng.normal(0, 0.01, 16)).tolist(), 0) for i in range(4000)]
    found = check(spark, rows)
    assert found.looked[-1] < 0.5


def test_hilbert_keys_are_a_curve():
    """Over a full grid the keys count its cells, and one step along the curve is one step in space."""
    for w, bits in ((1, 6), (2, 5), (3, 4), (5, 2)):
        grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * w, indexing="ij"), -1).reshape(-1, w)
        keys = codes.hilbert_keys(grid, bits)
        order = np.argsort(keys)
        assert keys[order].tolist() == list(range(len(grid)))
        assert (np.abs(np.diff(grid[order], axis=0)).sum(1) == 1).all()
