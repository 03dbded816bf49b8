"""Secret scans with corpus-wide ownership frequency.

Every whole text is searched for credential patterns.  Candidate values are
hashed and counted over the corpus by distinct repositories and owners, a
repository belonging to its owner.  Both counts decide: a value of
``example_owners`` owners, or of two or more owners and ``example_repos``
repositories, is a widely copied example; all else, also a value in any number of
repositories of one owner, is owner-specific and live-looking.

On ``documents`` the owner is the source, and a repository is a distinct text of it,
so that exact copies of a document add no repository.

Defined results: a null text counts as empty; rows are kept one to one, also
repeated ones and those with null keys (a null owner or repository counts as
one more of its kind); an empty table gives an empty result; other columns of
the input are ignored.  Overlapping spans of different kinds are all kept.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusflow.llm.common import read_table, row_id, small_batches, spread_join, stored
from corpusflow.llm.registry import query

_FLAGS = re.ASCII | re.IGNORECASE
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", _FLAGS)
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
# Fixed formats of issued credentials, found beside the base patterns.
MORE = (
    ("forge", "_", re.compile(r"gh[oprsu]_[A-Za-z0-9]{36,}")),
    ("webtoken", "eyJ", re.compile(r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}")),
    ("private", "-----BEGIN", re.compile(r"-----BEGIN [A-Z ]*PRIVATE KEY-----.*?-----END [A-Z ]*PRIVATE KEY-----", re.S)),
)
KINDS = ("assign", "access", "hex") + tuple(k for k, _, _ in MORE)
SCAN_SCHEMA = ("row_id long, repo string, owner string, n_assign long, n_access long, n_hex long, base_sha256 string, "
               "spans string, found array<struct<kind:string,start:long,stop:long,value_hash:string>>")


def find(text: str) -> list[tuple[int, int, int, str]]:
    """(start, kind's number, end, value) of all spans, in that order."""
    out = []
    low = text.lower()
    if any(w in low for w in ASSIGN_WORDS):
        out += [(m.start(), 0, m.end(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end(), m[0]) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    out += [(m.start(), 2, m.end(), m[0]) for m in HEX.finditer(text)]
    for i, (_, mark, rx) in enumerate(MORE, 3):
        if mark in text:
            out += [(m.start(), i, m.end(), m[0]) for m in rx.finditer(text)]
    return sorted(out)


def _scan(batches):
    for b in batches:
        rows = []
        for rid, repo, owner, text in zip(*(b.column(i).to_pylist() for i in range(4)), strict=True):
            got = find(text or "")
            shown = [f"{KINDS[k]}:{s}:{e}" for s, k, e, _ in got]
            base = ",".join(x for x, g in zip(shown, got, strict=True) if g[1] < 3)
            n = [sum(g[1] == k for g in got) for k in range(3)]
            rows.append((rid, repo, owner, *n, hashlib.sha256(base.encode()).hexdigest(), ",".join(shown),
                         [{"kind": KINDS[k], "start": s, "stop": e, "value_hash": hashlib.sha256(v.encode()).hexdigest()[:32]}
                          for s, k, e, v in got]))
        kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(),
                 pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("stop", pa.int64()), ("value_hash", pa.string())]))]
        names = ["row_id", "repo", "owner", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "found"]
        cols = list(zip(*rows, strict=True)) or [[]] * len(kinds)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names=names)


def scan_secrets(docs: DataFrame, *, key: str, text: str, owner: str, repo: F.Column | str | None = None,
                 example_owners: int = 3, example_repos: int = 10) -> tuple[DataFrame, DataFrame]:
    """(per row, per value): the rows with their spans, the numbers of live and
    example candidates, and ``ownership``, "owners/repositories" of each span in the
    order of ``spans``; the values with distinct owners and repositories.
    ``repo`` is a column or an expression (the key if not given)."""
    small_batches(docs.sparkSession)
    repository = F.col(key) if repo is None else F.col(repo) if isinstance(repo, str) else repo
    keyed = docs.select(F.col(key).alias(key), row_id().alias("row_id"), repository.cast("string").alias("repo"),
                        F.col(owner).cast("string").alias("owner"), F.col(text).cast("string").alias("text"))
    scanned = stored(keyed.select("row_id", "repo", "owner", "text", key).mapInArrow(
        _with_key(key), f"{SCAN_SCHEMA}, `{key}` {docs.schema[key].dataType.simpleString()}"), "secret-scan")
    seen = scanned.select("row_id", "owner", "repo", F.posexplode("found").alias("place", "f"))
    seen = seen.select("row_id", "owner", "repo", "place", "f.value_hash", "f.kind")
    by_repo = seen.groupBy("value_hash", "owner", "repo").agg(F.count("*").alias("n"), F.min("kind").alias("kind"))
    by_owner = by_repo.groupBy("value_hash", "owner").agg(F.count("*").alias("repos"), F.sum("n").alias("n"), F.min("kind").alias("kind"))
    values = by_owner.groupBy("value_hash").agg(F.count("*").alias("n_owners"), F.sum("repos").alias("n_repos"),
                                                F.sum("n").alias("n_seen"), F.min("kind").alias("kind"))
    copied = (F.col("n_owners") >= example_owners) | ((F.col("n_owners") >= 2) & (F.col("n_repos") >= example_repos))
    values = stored(values.withColumn("is_example", copied), "secret-values")
    owned = spread_join(seen.select("row_id", "place", "value_hash"), values.select("value_hash", "is_example", "n_owners", "n_repos"), "value_hash")
    shown = F.struct("place", F.concat_ws("/", "n_owners", "n_repos").alias("counts"))
    marks = owned.groupBy("row_id").agg(
        F.sum(F.col("is_example").cast("long")).alias("n_example"), F.sum((~F.col("is_example")).cast("long")).alias("n_live"),
        F.max("n_owners").alias("most_owners"), F.max("n_repos").alias("most_repos"),
        F.array_join(F.transform(F.array_sort(F.collect_list(shown)), lambda x: x["counts"]), ",").alias("ownership"))
    rows = scanned.drop("repo", "owner").join(marks, "row_id", "left")
    return rows.fillna(0, ["n_example", "n_live", "most_owners", "most_repos"]).fillna("", ["ownership"]), values


def _with_key(key: str):
    def run(batches):
        for b in batches:
            for out in _scan([b]):
                yield pa.RecordBatch.from_arrays([*out.columns, b.column(4)], names=[*out.schema.names, key])
    return run


@query("op10_secrets")
def op10_secrets(spark, sf_dir):
    rows, _ = scan_secrets(read_table(spark, sf_dir, "documents"), key="doc_id", text="text", owner="source",
                           repo=F.sha2(F.coalesce("text", F.lit("")), 256))
    return rows.select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_live", "n_example", "most_owners", "most_repos", "ownership")
