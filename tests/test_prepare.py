"""End-to-end preparation against a brute-force Python model on a fixture."""

import hashlib
import math

from corpusflow.plans.corpus import Thresholds
from corpusflow.plans.prepare import PrepareConfig, prepare
from tests.models import budget_loop, chunk_loop, windows_loop

V = 97


def _rows():
    words = ["alpha", "beta", "gamma", "delta", "eps", "zeta", "eta"]
    rows = []
    for s, (name, n_docs) in enumerate([("A", 7), ("B", 5)]):
        for d in range(n_docs):
            k = 3 + (d * 5 + s * 3) % 17
            text = " ".join(words[(d + i + s) % len(words)] + str(i % 4) for i in range(k))
            lang = "en" if (s, d) == (0, 2) else "de"
            rows.append((name, s, d, text, lang))
    rows.append(("B", 1, 9, rows[3][3], "de"))       # same text as A/3: a cross-source duplicate
    rows.append(("B", 1, 10, "  tiny ", "de"))        # too short after strip
    return rows


def _model(rows, cfg, weights):
    th = cfg.th
    kept = [r for r in rows if len(r[3].strip()) >= th.min_chars and r[4] == cfg.language]
    seen, docs = set(), []
    for r in sorted(kept, key=lambda r: (r[1], r[2])):
        if r[3] in seen:
            continue
        seen.add(r[3])
        h = hashlib.sha256(r[3].encode()).hexdigest()
        if int(hashlib.md5(h.encode()).hexdigest()[:8], 16) % 10000 < round(cfg.val_fraction * 10000):
            continue
        docs.append(r)
    total_w = sum(weights.values())
    chunks = []
    for name, s, d, text, _ in docs:
        ids = [int(hashlib.md5(p.encode()).hexdigest()[:8], 16) % V for p in text.split()]
        for ci, c in enumerate(chunk_loop(ids, th.min_length, th.max_length, th.target_length)):
            chunks.append((name, s, d, ci, c))
    by_src = {}
    for c in sorted(chunks, key=lambda c: (c[1], c[2], c[3])):
        by_src.setdefault(c[0], []).append(c)
    arrivals = []
    for name, cs in by_src.items():
        cap = math.floor(cfg.target_tokens / th.target_length * (weights[name] / total_w))
        for r, c in enumerate(cs[:cap], start=1):
            arrivals.append(((r - 0.5) / weights[name], c[1], c[2], c[3], c[4]))
    arrivals.sort(key=lambda a: a[:4])
    lengths = budget_loop([len(a[4]) for a in arrivals], cfg.target_tokens)
    flat = [t for a in arrivals[:len(lengths)] for t in a[4]]
    return windows_loop(flat, cfg.seq_len, cfg.stride)


def test_prepare_matches_brute_force(spark):
    rows = _rows()
    weights = {"A": 3.0, "B": 1.0}
    df = spark.createDataFrame(rows, "source STRING, source_ord INT, doc_ord BIGINT, text STRING, lang STRING")
    cat = spark.createDataFrame([("A", 0, 3.0), ("B", 1, 1.0)], "source STRING, source_ord INT, weight DOUBLE")
    cfg = PrepareConfig(th=Thresholds(min_length=4, max_length=9, target_length=6, min_chars=5),
                        language="de", target_tokens=60, mode="deterministic", seq_len=5, stride=3,
                        val_fraction=0.2, vocab_size=V, batch_size=2, accumulation=2)
    out = prepare(df, cat, cfg)
    got = [(r["x"], r["y"], r["batch_id"], r["update_id"])
           for r in out.train_windows.orderBy("window_id").collect()]
    want = _model(rows, cfg, weights)
    assert len(want) > 3
    assert [(g[0], g[1]) for g in got] == [(list(x), list(y)) for x, y in want]
    assert [g[2] for g in got] == [i // 2 for i in range(len(got))]
    assert [g[3] for g in got] == [i // 4 for i in range(len(got))]


def test_prepare_race_mode_runs_and_respects_budget(spark):
    rows = _rows()
    df = spark.createDataFrame(rows, "source STRING, source_ord INT, doc_ord BIGINT, text STRING, lang STRING")
    cat = spark.createDataFrame([("A", 0, 3.0), ("B", 1, 1.0)], "source STRING, source_ord INT, weight DOUBLE")
    cfg = PrepareConfig(th=Thresholds(min_length=4, max_length=9, target_length=6, min_chars=5),
                        language="de", target_tokens=40, mode="race", seq_len=5, vocab_size=V)
    out = prepare(df, cat, cfg)
    mixed = out.mixed_chunks.orderBy("mix_ord").collect()
    cum = [r["mix_cum"] for r in mixed]
    assert cum and all(c - r["chunk_len"] < 40 for c, r in zip(cum, mixed))
    assert [r["mix_ord"] for r in mixed] == list(range(1, len(mixed) + 1))


def _subword_table():
    from corpusflow.operators.subwords import MergeTable
    ids = {bytes([b]): b for b in range(256)}
    merges = [(b"a", b"l"), (b"t", b"a"), (b"e", b"ta"), (b" ", b"b"), (b"d", b"e")]
    for a, b in merges:
        ids.setdefault(a + b, len(ids))
    return MergeTable.from_merges(merges, ids)


def test_lengths_budget_and_windows_in_subwords(spark):
    import regex
    table = _subword_table()
    rows, weights = _rows(), {"A": 0.7, "B": 0.3}
    cfg = PrepareConfig(th=Thresholds(min_length=20, max_length=60, target_length=32, min_chars=20), target_tokens=700,
                        mode="deterministic", val_fraction=0.0, seq_len=16, merges=table)
    df = spark.createDataFrame(rows, "source STRING, source_ord INT, doc_ord INT, text STRING, lang STRING")
    cat = spark.createDataFrame([("A", 0, 0.7), ("B", 1, 0.3)], "source STRING, source_ord INT, weight DOUBLE")
    got = sorted((r["window_id"], r["x"], r["y"]) for r in prepare(df, cat, cfg).train_windows.collect())

    def ids(text):
        parts = regex.findall(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+", text)
        return [i for p in parts for i in table.ids(p.encode())]
    th, seen, chunks = cfg.th, set(), {}
    for name, s, d, text, lang in sorted(rows, key=lambda r: (r[1], r[2])):
        if len(text.strip()) >= th.min_chars and lang == "de" and text not in seen:
            seen.add(text)
            for ci, c in enumerate(chunk_loop(ids(text), th.min_length, th.max_length, th.target_length)):
                chunks.setdefault(name, []).append((s, d, ci, c))
    order = sorted(((r + 0.5) / weights[n], s, d, ci, c) for n, cs in chunks.items()
                   for r, (s, d, ci, c) in enumerate(cs[:math.floor(700 / 32 * weights[n])]))
    lengths = budget_loop([len(a[4]) for a in order], 700)
    flat = [t for a in order[:len(lengths)] for t in a[4]]
    assert [(x, y) for _, x, y in got] == [(list(x), list(y)) for x, y in windows_loop(flat, 16, None)]


def test_validation_pass_shares_no_document_with_the_mix(spark):
    from corpusflow.plans.prepare import validation_pass
    rows = _rows()
    cfg = PrepareConfig(th=Thresholds(min_length=2, max_length=30, target_length=8, min_chars=5), target_tokens=40,
                        mode="deterministic", val_fraction=0.0, seq_len=4)
    df = spark.createDataFrame(rows, "source STRING, source_ord INT, doc_ord INT, text STRING, lang STRING")
    cat = spark.createDataFrame([("A", 0, 0.7), ("B", 1, 0.3)], "source STRING, source_ord INT, weight DOUBLE")
    first = prepare(df, cat, cfg)
    used = {(r["source_ord"], r["doc_ord"]) for r in first.mixed_chunks.collect()}
    assert used and first.consumed.count() == len(used)
    all_pairs = validation_pass(df, cat, cfg, first.consumed, samples=1000, max_pairs=None).collect()
    held = {(r["source_ord"], r["doc_ord"]) for r in all_pairs}
    assert held and not held & used
    assert all(r["y"][:-1] == r["x"][1:] and len(r["x"]) == 4 for r in all_pairs)
    assert sorted(r["sample_ord"] for r in all_pairs) == list(range(1, len(all_pairs) + 1))
    some = validation_pass(df, cat, cfg, first.consumed, samples=1000, max_pairs=3).collect()
    def key(r):
        return (r["sample_ord"], r["source_ord"], r["doc_ord"], r["chunk_idx"], r["pair_idx"], r["x"])
    assert sorted(map(key, some)) == sorted(map(key, all_pairs))[:3]
