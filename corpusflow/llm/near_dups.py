"""Near-duplicate documents by Order MinHash.

A document is the sequence of its runs of ``K`` lower-cased words.  Equal
runs are labelled by their occurrence, and each of ``TABLES`` hash functions
selects the ``PICKED`` labelled runs of smallest hash; their runs, in the
order in which the text has them, make the table's key, so that documents
share a key with a probability that falls with their edit distance and not
only with their sets' distance.

Equal sequences form one class before anything else.  Within a bucket (equal
keys of a table) every class is compared with the bucket's hub, which differs
from table to table; after components are known, classes of one bucket that
are still apart and met no hub's verdict (neither is a hub) are compared as well, so
that no pair that shares a bucket is lost, and yet a group of thousands costs a few comparisons a member.  One hub
is the bucket's most central class, as a rule the original of the copies.

A candidate pair is verified by an alignment of both run sequences within the
band that a similarity of ``SIMILAR`` leaves: similarity is the number of
aligned equal runs over the number of runs of either (the ordered form of the
Jaccard similarity).  Whole texts are aligned, bit-parallel, in vectors as wide as the band.

Defined results: null texts and texts without words are linked with nothing;
a text of fewer than ``K`` words is one run; rows stay one to one, repeated
ones are copies of each other (one stays); null keys come last in the order;
an empty table gives an empty result; extra columns stay as they are.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusflow.llm.common import batch_rows, blocks, content_key, mix64, numbered, read_table, row_id, small_batches, stored, without, words
from corpusflow.llm.graph import components
from corpusflow.llm.registry import query
from corpusflow.operators.sizing import broadcast_if_small

K, SIMILAR = 5, 0.8
TABLES, PICKED = 12, 2
BLOCK = 256
_U = np.uint64
_SEEDS = mix64(np.arange(1, 65, dtype=_U) * _U(0xD1342543DE82EF95))


def runs(hashes: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of k words of each text (a shorter text is one run), and each text's first."""
    n = np.diff(first)
    count = np.where(n >= k, n - k + 1, np.minimum(n, 1))
    bound = np.concatenate([[0], np.cumsum(count)])
    total = int(bound[-1])
    at = np.arange(total) - np.repeat(bound[:-1], count) + np.repeat(first[:-1], count)
    length = np.repeat(np.minimum(n, k), count)
    padded = np.concatenate([hashes, np.zeros(k, _U)])
    h = np.zeros(total, _U)
    for j in range(k):
        h = h * _U(0x9E3779B97F4A7C15) + np.where(j < length, padded[at + j], _U(0))
    return mix64(h), bound


def labelled(h: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Hashes of the runs with their occurrence numbers within the text."""
    order = np.lexsort((h, text))
    hs, ts = h[order], text[order]
    new = np.ones(len(h), bool)
    new[1:] = (hs[1:] != hs[:-1]) | (ts[1:] != ts[:-1])
    start = np.flatnonzero(new)
    nth = np.empty(len(h), _U)
    nth[order] = (np.arange(len(h)) - np.repeat(start, np.diff(np.append(start, len(h))))).astype(_U)
    return mix64(h + nth * _U(0xA0761D6478BD642F))


def sketches(h: np.ndarray, bound: np.ndarray, tables: int = TABLES, picked: int = PICKED) -> np.ndarray:
    """Keys of the non-empty texts: one row per text, one column per table."""
    count = np.diff(bound)
    some = np.flatnonzero(count)
    starts, sizes = bound[some], count[some]
    which = np.repeat(np.arange(len(some)), sizes)
    labels = labelled(h, which)
    out = np.zeros((len(some), tables), np.int64)
    worst = _U(0xFFFFFFFFFFFFFFFF)
    for t in range(tables):
        x = (labels ^ _SEEDS[t]) * _U(0x9FB21C651E98DF25)
        x ^= x >> _U(32)
        x *= _U(0xD6E8FEB86659FD93)
        places = np.full((picked, len(some)), len(h), np.int64)
        for p in range(picked):
            low = np.minimum.reduceat(x, starts)
            is_low = np.flatnonzero(x == low[which])
            first = np.searchsorted(which[is_low], np.arange(len(some)))
            place = is_low[first]
            left = sizes > p
            places[p, left] = place[left]
            x[place] = worst
        places.sort(axis=0)  # the order of the text
        runs_ = np.concatenate([h, [_U(0)]])[places]
        key = np.full(len(some), _SEEDS[-1 - t])
        for p in range(picked):
            key = mix64(key * _U(0x9E3779B97F4A7C15) + runs_[p])
        out[:, t] = key.view(np.int64)
    return out


def sequence_hash(hashes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits of each text's word sequence, as two numbers."""
    out = []
    for salt in (_U(0x8CB92BA72F3D8DD7), _U(0xABC98388FB8FAC03)):
        own = mix64(hashes ^ salt)
        at = np.arange(len(hashes), dtype=_U) - np.repeat(first[:-1], np.diff(first)).astype(_U)
        own = mix64(own + at * _U(0x9E3779B97F4A7C15))
        total = np.concatenate([np.zeros(1, _U), np.cumsum(own, dtype=_U)])
        out.append(mix64(total[first[1:]] - total[first[:-1]] + np.diff(first).astype(_U)).view(np.int64))
    return out[0], out[1]


def _sketch(batches):
    for b in batches:
        n = b.num_rows
        a, c = np.zeros(n, np.int64), np.zeros(n, np.int64)
        size = np.zeros(n, np.int64)
        keys = np.zeros((n, TABLES), np.int64)
        for lo, hi, data, off in blocks(b.column(1)):
            _, _, hashes, first = words(data, off)
            a[lo:hi], c[lo:hi] = sequence_hash(hashes, first)
            h, bound = runs(hashes, first, K)
            size[lo:hi] = np.diff(bound)
            if len(h):
                keys[lo:hi][size[lo:hi] > 0] = sketches(h, bound)
        lists = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * TABLES), pa.array(keys.ravel()))
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(a), pa.array(c), pa.array(size), lists], names=["e", "sa", "sb", "n_runs", "keys"])


def _sequences(batches):
    for b in batches:
        for lo, hi, data, off in blocks(b.column(1)):
            _, _, hashes, first = words(data, off)
            h, bound = runs(hashes, first, K)
            yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, hi - lo), pa.ListArray.from_arrays(pa.array(bound.astype(np.int32)), pa.array((h >> _U(32)).astype(np.uint32).view(np.int32)))], names=["id", "runs"])


def aligned_runs(a: np.ndarray, b: np.ndarray, least: int) -> int:
    """Equal runs of the best alignment of two sequences within the band that
    leaves at least ``least``; fewer may be reported only below ``least``."""
    if min(len(a), len(b)) < least:
        return 0
    band = max(len(a), len(b)) - least
    n = min(len(a), len(b))
    same = a[:n] == b[:n]
    head = n if same.all() else int(same.argmin())
    a, b = a[head:], b[head:]
    n = min(len(a), len(b))
    same = a[len(a) - n:][::-1] == b[len(b) - n:][::-1]
    tail = n if same.all() else int(same.argmin())
    a, b = a[:len(a) - tail], b[:len(b) - tail]
    if not len(a) or not len(b):
        return head + tail
    places: dict[int, list[int]] = {}
    for j, x in enumerate(b.tolist()):
        places.setdefault(x, []).append(j)
    # One bit per column of the band, the lowest for column ``left``; zero bits are columns at which
    # the alignment grows by one.  Columns that the band leaves can't change any more, those that
    # it hasn't reached are all open.
    left, grown, open_, reached = 0, 0, 0, 0
    for i, x in enumerate(a.tolist()):
        start, end = max(0, i - band), min(len(b), i + band + 1)
        if start > left:
            gone = min(start, reached) - left
            grown += gone - (open_ & ((1 << gone) - 1)).bit_count()
            open_ >>= gone
            left += gone
        if end > reached:
            open_ |= ((1 << (end - reached)) - 1) << (reached - left)
            reached = end
        at = places.get(x)
        if at:
            match = 0
            for j in at[bisect_left(at, start):bisect_right(at, end - 1)]:
                match |= 1 << (j - left)
            if match:
                hit = open_ & match
                open_ = ((open_ + hit) | (open_ - hit)) & ((1 << (reached - left)) - 1)
    return head + tail + grown + reached - left - open_.bit_count()


def similar(a: np.ndarray, b: np.ndarray, least: float = SIMILAR) -> bool:
    """Whether aligned runs over the runs of either are at least ``least``."""
    need = int(np.ceil(round(least * (len(a) + len(b)) / (1 + least), 9)))
    got = aligned_runs(a, b, need)
    return got >= need and got > 0


def _verify(batches):
    for b in batches:
        x, y = b.column(2), b.column(3)
        ok = [similar(x[i].values.to_numpy(), y[i].values.to_numpy()) for i in range(b.num_rows)]
        mask = pa.array(ok, pa.bool_())
        yield pa.RecordBatch.from_arrays([b.column(0).filter(mask), b.column(1).filter(mask)], names=["a", "b"])


def _verified(pairs: DataFrame, sequences: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sequences are similar; each pair is aligned once."""
    one = sequences.select(F.col("id").alias("a"), F.col("runs").alias("x"))
    two = sequences.select(F.col("id").alias("b"), F.col("runs").alias("y"))
    full = pairs.join(one, "a").join(two, "b").select("a", "b", "x", "y")
    with batch_rows(pairs.sparkSession, 200):
        return stored(full.mapInArrow(_verify, "a long, b long"), "similar-pairs")


def _apart(met: DataFrame, group: DataFrame) -> DataFrame:
    """Members that aren't hubs of their bucket, with the component of each; only buckets in which
    several components have such members.  Every pair with a hub has been tested by its alignment."""
    others = met.filter("n - size(hubs) > 1").filter(~F.array_contains("hubs.id", F.col("id")))
    m = others.join(group, others.id == group.v, "left").select("t", "k", "id", "n_runs", F.coalesce("component", "id").alias("c"))
    m = stored(m, "bucket-members")
    mixed = stored(m.groupBy("t", "k").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).filter("lo < hi").select("t", "k"), "mixed-buckets")
    return m.join(mixed, ["t", "k"], "left_semi")


class _Block:
    """The members of a block, with all their runs in one array."""

    def __init__(self, members: pa.StructArray):
        lists = members.field("runs")
        self.first = lists.offsets.to_numpy() - lists.offsets[0].as_py()
        self.runs = lists.flatten().to_numpy()
        self.n = np.diff(self.first)
        self.owner = np.repeat(np.arange(len(members)), self.n)
        self.keys = members.field("keys").flatten().to_numpy().reshape(len(members), -1)
        self.id, self.c = members.field("id").to_numpy(), members.field("c").to_numpy()
        distinct = np.unique(self.owner << 32 | self.runs.view(np.uint32))
        self.repeats = self.n - np.bincount(distinct >> 32, minlength=len(members))
        self.terms = np.unique(distinct & 0xFFFFFFFF).astype(np.uint32).view(np.int32)

    def sequence(self, i: int) -> np.ndarray:
        return self.runs[self.first[i]:self.first[i + 1]]

    def incidence(self, terms: np.ndarray) -> np.ndarray:
        """Members by (sorted) terms: 1 where the member has the term."""
        out = np.zeros((len(self.n), len(terms)), np.float32)
        at = np.minimum(np.searchsorted(terms, self.runs), len(terms) - 1)
        has = terms[at] == self.runs
        out[self.owner[has], at[has]] = 1
        return out


def _verify_cells(batches):
    """Components (a, b) of the similar pairs of a cell: of its members' left with its right ones, or,
    in a cell of one block, with each other.  A product of incidence matrices bounds the aligned
    runs; only pairs that it lets pass are aligned, and a pair that shares several tables is tested in the first."""
    for b in batches:
        one, two = [], []
        for r in range(b.num_rows):
            t, sides = b.column(0)[r].as_py(), b.column(1)[r].values
            right = sides.field("right").to_pylist()
            x = _Block(sides.field("m")[right.index(False)].values)
            y = _Block(sides.field("m")[right.index(True)].values) if len(right) > 1 else x
            equal = x.keys[:, None, :] == y.keys[None, :, :]
            go = (x.c[:, None] != y.c) & (equal.argmax(2) == t) & equal.any(2)
            if x is y:
                go &= x.id[:, None] < y.id
            if not go.any():
                continue
            common = np.sort(np.intersect1d(x.terms, y.terms, assume_unique=True))
            overlap = np.zeros((len(x.n), len(y.n)), np.float32)
            for lo in range(0, len(common), 8192):
                part = common[lo:lo + 8192]
                overlap += x.incidence(part) @ y.incidence(part).T
            need = SIMILAR * np.add.outer(x.n, y.n) / (1 + SIMILAR) - 1e-6
            go &= overlap + np.minimum.outer(x.repeats, y.repeats) >= need
            for i, j in np.argwhere(go):
                if similar(x.sequence(i), y.sequence(j)):
                    one.append(min(x.c[i], y.c[j]))
                    two.append(max(x.c[i], y.c[j]))
        yield pa.RecordBatch.from_arrays([pa.array(one, pa.int64()), pa.array(two, pa.int64())], names=["a", "b"])


def _blocks(apart: DataFrame, full: DataFrame) -> DataFrame:
    """Members of a bucket in blocks of about ``BLOCK``: a row (t, k, size, block, m, lo, hi, sizes) per block,
    ``sizes`` being the number of the bucket's blocks by size, lo and hi the bounds of its components.

    Blocks hold members of like length.  The base of the length's logarithm is a little
    above 1 / ``SIMILAR``, so similar members are of equal or neighbouring lengths, and
    only blocks of such lengths meet."""
    apart = apart.withColumn("size", F.floor(F.log("n_runs") / float(np.log(1.008 / SIMILAR))))
    sizes = apart.groupBy("t", "k", "size").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
    sizes = stored(sizes.groupBy("t", "k").agg(F.map_from_entries(F.collect_list(F.struct("size", "blocks"))).alias("sizes")), "apart-sizes")
    block = F.pmod(F.xxhash64("id"), F.col("sizes")[F.col("size")])
    rows = apart.join(sizes, ["t", "k"]).select("t", "k", "size", block.alias("block"), "id", "c", "sizes").join(full, "id")
    return rows.groupBy("t", "k", "size", "block").agg(F.collect_list(F.struct("id", "c", "keys", "runs")).alias("m"), F.min("c").alias("lo"), F.max("c").alias("hi"),
                                                       F.first("sizes").alias("sizes"))


def _rest(apart: DataFrame, classes: DataFrame, sequences: DataFrame) -> DataFrame:
    """Pairs of components that similar members of a bucket join, found cell by cell, a cell being
    two blocks or one: no pair is written but those of similar members."""
    full = classes.select("id", "keys").join(sequences, "id").join(apart.select("id").distinct(), "id", "left_semi")
    rows = stored(_blocks(apart, stored(full, "apart-sequences")), "blocks")
    blocks_of = "transform(sequence(0L, sizes[size + {0}] - 1), b -> struct(size + {0} as size, b as block))"
    met = [F.coalesce(F.expr(blocks_of.format(step)), F.array().cast("array<struct<size: long, block: long>>")) for step in (-1, 0, 1)]
    rows = rows.withColumn("own", F.struct("size", "block")).withColumn("other", F.explode(F.concat(*met)))
    cell = F.struct("k", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high")).alias("cell")
    rows = rows.select("t", cell, F.struct((F.col("own") > F.col("other")).alias("right"), "m").alias("side"), "lo", "hi")
    rows = rows.groupBy("t", "cell").agg(F.collect_list("side").alias("sides"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    # a cell of two blocks of which one has no members, or of one component, holds no pair
    rows = rows.filter("lo < hi and (size(sides) = 2 or cell.low = cell.high)").select("t", "sides")
    with batch_rows(apart.sparkSession, 4):
        return stored(rows.mapInArrow(_verify_cells, "a long, b long"), "rest-pairs")


def near_duplicates(docs: DataFrame, *, key: str, text: str) -> DataFrame:
    """One narrow row per row of ``docs``: the key, content key, class_id (smallest key of
    its group), copy_id (smallest key of equal word sequences), n_copies, kept."""
    spark = docs.sparkSession
    small_batches(spark)
    given = docs.select(F.struct(F.col(key).cast("long").alias("key"), content_key(key, text).alias("content")).alias("e"), F.col(text).cast("string").alias("t"))
    rows = stored(given.mapInArrow(_sketch, f"e {given.schema['e'].dataType.simpleString()}, sa long, sb long, n_runs long, keys array<long>").select("e.*", "sa", "sb", "n_runs", "keys", row_id().alias("row_id")), "sketches")
    order = F.struct(F.col("key").isNull().alias("no_key"), "key", "row_id")
    classes = rows.filter("n_runs > 0").groupBy("sa", "sb").agg(F.min(order).alias("top"), F.count("*").alias("n_copies"), F.min_by(F.struct("content", "n_runs", "keys"), order).alias("r"))
    classes = stored(classes.select("sa", "sb", F.col("top.row_id").alias("id"), "n_copies", "r.*"), "text-classes")
    members = classes.select("id", "n_runs", F.posexplode("keys").alias("t", "k"))
    # buckets of two or more; a class is the more central the larger its buckets are: an
    # original is in the buckets of most of its copies, a copy leaves some with each edit
    sizes = stored(members.groupBy("t", "k").agg(F.count("*").alias("n")).filter("n > 1"), "buckets")
    members = stored(members.join(sizes, ["t", "k"]), "bucketed")
    central = members.groupBy("id").agg(F.sum("n").alias("central"))
    members = stored(members.join(central, "id"), "members")
    # two hubs a bucket: the most central class, and one that differs from table to table
    one = F.struct("id", "n_runs")
    hubs = members.groupBy("t", "k").agg(F.max_by(one, F.struct("central", -F.col("id"))).alias("h1"), F.min_by(one, F.xxhash64("id", "t")).alias("h2"))
    hubs = stored(hubs.select("t", "k", F.array_distinct(F.array("h1", "h2")).alias("hubs")), "hubs")
    met = stored(members.join(hubs, ["t", "k"]).select("t", "k", "n", "id", "n_runs", "hubs"), "met")
    in_band = f"least(n_runs, hub.n_runs) >= {SIMILAR} * greatest(n_runs, hub.n_runs)"
    pairs = met.select("id", "n_runs", F.explode("hubs").alias("hub")).filter("id <> hub.id").filter(in_band)
    pairs = pairs.select(F.least("id", "hub.id").alias("a"), F.greatest("id", "hub.id").alias("b")).distinct()
    pairs = stored(pairs, "hub-pairs")
    # the run sequences of the classes that share a bucket
    wanted = classes.join(members.select("id").distinct(), "id", "left_semi").select("id", F.col("content.a").alias("ca"), F.col("content.b").alias("cb"))
    texts = docs.select(content_key(key, text).alias("content"), F.col(text).cast("string").alias("t"))
    texts = texts.join(broadcast_if_small(wanted, 300_000), (F.col("content.a") == F.col("ca")) & (F.col("content.b") == F.col("cb"))).select("id", "t")
    sequences = stored(texts.mapInArrow(_sequences, "id long, runs array<int>").dropDuplicates(["id"]), "run-sequences")
    links = _verified(pairs, sequences)
    group = components(links).withColumnRenamed("id", "v")
    # classes of one bucket that are still apart; their links join components, whose smallest id names the whole
    more = _rest(stored(_apart(met, group), "apart"), classes, sequences)
    joined = components(more).select(F.col("id").alias("part"), F.col("component").alias("whole"))
    ids = classes.select("sa", "sb", "id", "n_copies")
    top = ids.join(group, ids.id == group.v, "left").select("sa", "sb", "id", "n_copies", F.coalesce("component", "id").alias("part"))
    top = top.join(joined, "part", "left").select("sa", "sb", "id", "n_copies", F.coalesce("whole", "part").alias("component"))
    # smallest key of each component, by the classes' first rows
    first = rows.join(ids.select("id"), rows.row_id == ids.id, "left_semi").select(F.col("row_id").alias("id"), "key")
    top = stored(top.join(first, "id"), "class-keys")
    lead = top.groupBy("component").agg(F.min(F.struct(F.col("key").isNull().alias("no_key"), F.col("key"), "id")).alias("lead"))
    lead = stored(lead.select("component", F.col("lead.key").alias("class_id"), F.col("lead.id").alias("lead_row")), "leads")
    top = stored(top.join(lead, "component").select("sa", "sb", F.col("key").alias("copy_id"), "n_copies", "class_id", "lead_row"), "classes")
    # texts without words stand alone
    alone = rows.filter("n_runs = 0").select("key", "content", F.col("key").alias("class_id"), F.col("key").alias("copy_id"), F.lit(1).cast("long").alias("n_copies"), F.lit(True).alias("kept"))
    out = rows.filter("n_runs > 0").drop("keys").join(top, ["sa", "sb"]).select("key", "content", "class_id", "copy_id", "n_copies", (F.col("row_id") == F.col("lead_row")).alias("kept"))
    return out.unionByName(alone).withColumnRenamed("key", key)


def deduplicate(docs: DataFrame, *, key: str, text: str) -> DataFrame:
    """One row of each group of near copies, with its own columns."""
    found = stored(near_duplicates(docs, key=key, text=text), "near-dups")
    per = found.groupBy("content").agg(F.max("kept").alias("kept"), F.count("*").alias("n"))
    gone = per.filter(~F.col("kept")).select("content.*")
    left = without(docs, gone, key, text)
    # rows that equal a row that stays, by key and text: one of them stays
    twins = stored(per.filter(F.col("kept") & (F.col("n") > 1)).select("content.*"), "twins")
    if twins.isEmpty():
        return left
    rows, own = numbered(left)
    mine = rows.withColumn("content", content_key(own[key], own[text]))
    mine = mine.join(broadcast_if_small(twins, 300_000), (F.col("content.a") == F.col("a")) & (F.col("content.b") == F.col("b")), "left_semi")
    return without(left, twins, key, text).unionByName(mine.dropDuplicates(["content"]).select(*own.values()).toDF(*left.columns))


@query("op5_order_minhash")
def op5_order_minhash(spark, sf_dir):
    return near_duplicates(read_table(spark, sf_dir, "documents"), key="doc_id", text="text").select("doc_id", "class_id", "copy_id", "n_copies", "kept")
