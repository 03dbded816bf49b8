"""Secret scans: owners and repositories against plain counts."""

import random
from collections import defaultdict

from pyspark.sql import functions as F

from corpusflow.llm import secrets

DOC = "doc_id long, text string, source string, repo string"


def _rows():
    rng = random.Random(4)
    keys = [f"AKIA{'%016d' % i}" for i in range(12)]
    rows = []
    for i in range(400):
        mine = rng.choices(keys, weights=[80, *[4] * 11], k=rng.randrange(4))
        rows.append((i, " and ".join(mine), f"o{rng.randrange(5)}" if i % 50 else None, f"r{rng.randrange(9)}" if i % 33 else None))
    live, shared = "AKIA" + "L" * 16, "AKIA" + "S" * 16
    rows += [(1000 + i, live, "one", f"fork{i}") for i in range(40)]              # one owner, many repositories
    rows += [(2000 + i, shared, f"two{i % 2}", f"fork{i}") for i in range(10)]    # two owners, ten repositories
    rows += [(3000 + i, "AKIA" + "T" * 16, f"two{i % 2}", "same") for i in range(30)]  # two owners, a repository each
    return [*rows, *rows[:3], (None, live, "one", "fork0"), (5000, None, None, None), (5001, "", "x", "y")]


def test_owners_and_repositories_against_plain_counts(spark):
    rows = _rows()
    owners, repos = defaultdict(set), defaultdict(set)
    for _, t, o, r in rows:
        for _, _, _, v in secrets.find(t or ""):
            owners[v].add(o)
            repos[v].add((o, r))
    got = secrets.scan_secrets(spark.createDataFrame(rows, DOC).repartition(4), key="doc_id", text="text", owner="source", repo="repo")
    want = []
    for i, t, _, _ in rows:
        found = [v for *_, v in secrets.find(t or "")]
        n = [len(owners[v]) >= 3 or (len(owners[v]) == 2 and len(repos[v]) >= 10) for v in found]
        want.append((i or -1, sum(n), len(n) - sum(n), max((len(owners[v]) for v in found), default=0), max((len(repos[v]) for v in found), default=0),
                     ",".join(f"{len(owners[v])}/{len(repos[v])}" for v in found)))
    have = [(r.doc_id or -1, r.n_example, r.n_live, r.most_owners, r.most_repos, r.ownership) for r in got[0].collect()]
    assert sorted(have) == sorted(want)
    decided = {r[0]: (r[1], r[2]) for r in have}
    assert decided[1000] == (0, 1) and decided[2000] == (1, 0) and decided[3000] == (0, 1) and decided[5000] == (0, 0)


def test_copies_of_a_text_are_one_repository(spark):
    docs = spark.createDataFrame([(i, "token=abcdef1234" + ("" if i < 20 else f" {i}"), f"s{i % 2}", "") for i in range(22)], DOC)
    rows, _ = secrets.scan_secrets(docs, key="doc_id", text="text", owner="source", repo=F.sha2("text", 256))
    assert {(r.most_owners, r.most_repos, r.n_live) for r in rows.collect()} == {(2, 4, 1)}


def test_a_value_held_by_most_rows_spreads(spark):
    docs = spark.range(6000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 < 2, F.lit("token=abcdef1234")).otherwise(
        F.format_string("token=k%06d", "id")).alias("text"), (F.col("id") % 7).cast("string").alias("source"), F.lit("").alias("repo"))
    rows, values = secrets.scan_secrets(docs, key="doc_id", text="text", owner="source")
    assert rows.filter("n_example = 1").count() == 4000 and rows.filter("n_live = 1").count() == 2000
    assert values.agg(F.max("n_repos")).first()[0] == 4000
