"""Near-duplicate embeddings by a robust-pruned flat graph.

Vectors of one label are dealt to overlapping shards: those of their
``overlap`` nearest centroids, which are fitted on a bounded sample (at most
``SAMPLE`` vectors; so at most ``SAMPLE / 4`` shards at first).  A shard of more
than ``MAX_SHARD`` vectors is split in the same way by centroids of its own, fitted
on a sample of about ``SHARD_SAMPLE`` of its vectors, and so are its parts, up to
``LEVELS`` times; so shards stay small at any number of vectors.  Within a shard every
vector's candidate pool is pruned robustly to at most ``DEGREE`` neighbours (a
candidate goes if a chosen one is nearer to it by the factor ``ALPHA``), and so
are the edges back to a vector beyond ``MAX_DEGREE``.  The shards' adjacency
lists are united per vector.  Every vector is then searched
in its shards from their medoids: a greedy search with a beam of ``BEAM`` that
goes on, once in range, through all vectors within the range.  Links are
verified by cosine in double precision.  A large group of near copies can't be split: a shard in
which a share ``DENSE`` or more of a sample's pairs is in range (and any that is still
above ``MAX_SHARD`` in the end) is not searched by one task, but dealt to blocks, and
all its blocks are compared with each other, which is at most 1 / ``DENSE`` times its links.

A pair that several shards hold is counted in the first of them, and shards
return counts and local components, not pairs.  Equal vectors are one vertex
with a number of copies.  An audit compares the vectors whose id is divisible
by ``AUDIT``, and of every label about ``LEAST_ASKED`` others (all, if it has no
more), with all vectors of their label, in blocks.  While a label's recall, over
its links or as the mean of its vectors', is below ``LEAST_RECALL``, the search
is repeated with more overlap; labels that still fall short at ``MAX_OVERLAP``
are compared whole, in blocks.

Defined results: rows with null or non-finite components, zero or empty
vectors, or a null label have no links and are their own component; vectors of
other lengths are never linked; null ids link like others, but name no
component if another id does; rows stay one to one (repeated rows are copies;
all copies of the component's smallest id are kept); an empty table gives an
empty result; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusflow.llm.common import batch_rows, partitions, read_table, row_id, small_batches, stored
from corpusflow.llm.graph import components
from corpusflow.llm.registry import query
from corpusflow.operators.sizing import broadcast_if_small

THRESHOLD = 0.93
TARGET, SAMPLE = 400, 16_384
OVERLAP, MAX_OVERLAP = 2, 5
POOL, FAR, DEGREE, FAR_DEGREE, ALPHA, BEAM, ROUNDS = 48, 32, 20, 8, 1.2, 16, 8
MAX_DEGREE = 64
MAX_SHARD, EXACT_BLOCK = 4_096, 2_048
SHARD_SAMPLE, LEVELS, DENSE, PROBE = 4_096, 6, 0.05, 1_024
AUDIT, LEAST_ASKED, LEAST_RECALL, BLOCK, CHUNK_BLOCKS = 50, 48, 0.9, 512, 64
CELLS = 2_000_000  # numbers in one block of a task


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _matrix(column) -> np.ndarray:
    return np.asarray(column.flatten(), float).reshape(len(column), -1)


def _lloyd(v: np.ndarray, n: int, rounds: int = 6) -> np.ndarray:
    """``n`` unit centroids of unit vectors."""
    c = v[np.linspace(0, len(v) - 1, n).astype(int)]
    step = max(1, CELLS // n)
    for _ in range(rounds):
        near = np.concatenate([(v[lo:lo + step] @ c.T).argmax(1) for lo in range(0, len(v), step)])
        c = np.array([v[near == j].sum(0) if (near == j).any() else c[j] for j in range(n)])
        c = c / np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-12)
    return c


def _fit(scale: float, target: int):
    """Centroids (label, length, c) of a label's sampled vectors of one length."""
    def run(table: pa.Table) -> pa.Table:
        order = np.lexsort((np.asarray(table["id"]), np.asarray(table["u"])))
        v = _unit(_matrix(table["x"].combine_chunks())[order])
        c = _lloyd(v, max(1, min(len(v) // 4, round(len(v) * scale / target))))
        same = lambda name: pa.array([table[name][0].as_py()] * len(c), pa.int64())
        return pa.table({"label": same("label"), "length": same("length"), "at": np.arange(len(c)), "c": pa.array(list(c), pa.list_(pa.float64()))})
    return run


def fit_centroids(vectors: DataFrame, target: int = TARGET, sample: int = SAMPLE) -> dict[tuple[int, int], np.ndarray]:
    """Centroids per (label, length), by a few rounds of Lloyd's method on a sample
    of at most ``sample`` vectors, those of the smallest hashes.  The sample stays with the tasks;
    the driver gets the centroids alone."""
    total = vectors.count()
    picked = vectors.select("label", "x", F.xxhash64("id", F.lit(6)).alias("u"), "id")
    if total > sample:
        picked = picked.filter(F.pmod("u", F.lit(1 << 30)) < int(1.1 * sample / total * (1 << 30)))
    picked = stored(picked.orderBy("u", "id").limit(sample).withColumn("length", F.size("x").cast("long")), "sample")
    scale = max(total, 1) / max(picked.count(), 1)
    fitted = picked.groupBy("label", "length").applyInArrow(_fit(scale, target), "label long, length long, at long, c array<double>")
    table = fitted.toArrow()
    label, length, at = (np.asarray(table[c]) for c in ("label", "length", "at"))
    lists = table["c"].combine_chunks()
    out: dict[tuple[int, int], np.ndarray] = {}
    rows = np.lexsort((at, length, label))
    for part in np.split(rows, np.flatnonzero((np.diff(label[rows]) != 0) | (np.diff(length[rows]) != 0)) + 1) if len(rows) else []:
        out[int(label[part[0]]), int(length[part[0]])] = _matrix(lists.take(pa.array(part)))
    return out


def _assign(centroids: dict, overlap: int):
    base, n = {}, 0
    for g in sorted(centroids):
        base[g], n = n, n + len(centroids[g])
    spare = n  # groups that the sample doesn't hold: a shard by label and length

    def run(batches):
        for b in batches:
            labels = b.column(1).to_pylist()
            lists = b.column(2).to_pylist()
            groups: dict[tuple[int, int], list[int]] = {}
            shards: list[list[int]] = [[]] * len(lists)
            for i, (label, x) in enumerate(zip(labels, lists, strict=True)):
                groups.setdefault((label, len(x)), []).append(i)
            for g, rows in groups.items():
                c = centroids.get(g)
                if c is None:
                    own = [spare + hash(g) % (1 << 40)]
                    for i in rows:
                        shards[i] = own
                    continue
                near = np.argsort(-(_unit(np.array([lists[i] for i in rows], float)) @ c.T), axis=1, kind="stable")[:, :overlap]
                for i, s in zip(rows, near.tolist(), strict=True):
                    shards[i] = sorted(base[g] + j for j in s)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(shards, pa.list_(pa.int64()))], names=[*b.schema.names, "shards"])
    return run


def _fit_parts(target: int, threshold: float):
    """Centroids (shard, c) of one large shard by a sample of its vectors; none where the
    sample's vectors are too often in range of each other for a split to keep them together."""
    def run(table: pa.Table) -> pa.Table:
        v = _unit(_matrix(table["x"].combine_chunks())[np.argsort(np.asarray(table["id"]))])
        probe = v[np.linspace(0, len(v) - 1, min(len(v), PROBE)).astype(int)]
        in_range = int((probe @ probe.T >= threshold).sum()) - len(probe)
        c = v[:0]
        if in_range < DENSE * len(probe) * (len(probe) - 1):
            c = _lloyd(v, max(2, min(len(v) // 4, round(table["n"][0].as_py() / target))))
        return pa.table({"shard": pa.array([table["shard"][0].as_py()] * len(c), pa.int64()), "c": pa.array(list(c), pa.list_(pa.float64()))})
    return run


def _assign_parts(overlap: int):
    """Members of a chunk of a shard in the ``overlap`` nearest parts of the shard."""
    def run(members: pa.Table, parts: pa.Table) -> pa.Table:
        if not members.num_rows:
            return pa.table({"id": members["id"], "x": members["x"], "n_copies": members["n_copies"], "shard": members["shard"]})
        part = np.asarray(parts["part"])
        order = np.argsort(part)
        c = _matrix(parts["c"].combine_chunks())[order]
        near = np.argsort(-(_unit(_matrix(members["x"].combine_chunks())) @ c.T), axis=1, kind="stable")[:, :overlap]
        again = pa.array(np.repeat(np.arange(len(near)), near.shape[1]))
        return members.select(["id", "x", "n_copies"]).take(again).append_column("shard", pa.array(part[order][near].ravel(), pa.int64()))
    return run


def split_shards(members: DataFrame, overlap: int, threshold: float) -> DataFrame:
    """``members`` (id, x, n_copies, shard) with the members of large shards in parts of these, again
    and again while there are shards above ``MAX_SHARD`` that can be split; ``members`` itself if there are none.

    Samples, members and centroids meet by shard and chunk of at most about ``MAX_SHARD`` members."""
    for level in range(1, LEVELS + 1):
        sizes = stored(members.groupBy("shard").agg(F.count("*").alias("n")).filter(F.col("n") > MAX_SHARD), "large-shards")
        if sizes.isEmpty():
            break
        unit = F.pmod(F.xxhash64("id", F.lit(100 + level)), F.lit(1 << 30)) / float(1 << 30)
        sample = members.join(broadcast_if_small(sizes, 100_000), "shard").filter(unit * F.col("n") < SHARD_SAMPLE).select("shard", "n", "id", "x")
        fitted = sample.groupBy("shard").applyInArrow(_fit_parts(TARGET, threshold), "shard long, c array<double>")
        parts = stored(fitted.select("shard", (row_id() + F.lit(level << 58)).alias("part"), "c"), "shard-parts")
        if parts.isEmpty():
            break
        chunks = F.ceil(F.col("n") / MAX_SHARD)
        split = broadcast_if_small(sizes.join(parts.select("shard").distinct(), "shard", "left_semi"), 100_000)
        going = members.join(split, "shard").select("id", "x", "n_copies", "shard", F.pmod(F.xxhash64("id", F.lit(5)), chunks).alias("chunk"))
        given = parts.join(split, "shard").select("shard", "part", "c", F.explode(F.sequence(F.lit(0).cast("long"), chunks - 1)).alias("chunk"))
        dealt = going.groupBy("shard", "chunk").cogroup(given.groupBy("shard", "chunk")).applyInArrow(_assign_parts(overlap), "id long, x array<double>, n_copies long, shard long")
        members = stored(members.join(split, "shard", "left_anti").select("id", "x", "n_copies", "shard").unionByName(dealt), "split-members")
    return members


def _prune(single: np.ndarray, lo: int, c: np.ndarray, s: np.ndarray, degree: int) -> tuple[np.ndarray, np.ndarray]:
    """Robust pruning of the pools ``c`` (similarities ``s``, falling) of the vectors from ``lo`` on: edges."""
    far = np.sqrt(np.maximum(2 - 2 * s, 0))
    alive = c != np.arange(lo, lo + len(c))[:, None]
    at = np.arange(len(c))
    vectors = single[c]
    one, two = [], []
    for _ in range(degree):
        j = alive.argmax(1)
        some = np.flatnonzero(alive[at, j])
        if not len(some):
            break
        one.append(some + lo)
        two.append(c[some, j[some]])
        between = np.sqrt(np.maximum(2 - 2 * np.einsum("npd,nd->np", vectors, single[c[at, j]]), 0))
        alive &= ALPHA * between > far
        alive[at, j] = False
    return np.concatenate(one or [at[:0]]), np.concatenate(two or [at[:0]])


def pruned_graph(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges (from, to) of a robust-pruned graph over unit vectors in which every
    vector can be reached from the medoid.

    A vector's pool is its nearest vectors, and for the long edges a fixed
    spread of all; both are pruned, near edges run both ways, and what can't be
    reached then is joined to the nearest vector that can."""
    n = len(v)
    pool = min(POOL, n - 1)
    if pool < 1:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    single = v.astype(np.float32)
    spread = np.unique(np.linspace(0, n - 1, min(n, 4 * FAR)).astype(int))
    one, two = [], []
    step = max(1, CELLS // max(n, pool * v.shape[1]))
    for lo in range(0, n, step):
        s = single[lo:lo + step] @ single.T
        s[np.arange(len(s)), np.arange(lo, lo + len(s))] = -2
        for cand, degree, both in ((None, DEGREE, True), (spread, FAR_DEGREE, False)):
            if cand is None:
                top = np.argpartition(-s, pool - 1, axis=1)[:, :pool]
            else:  # another part of the spread for each vector
                shift = (np.arange(lo, lo + len(s)) * 7919) % len(cand)
                top = cand[(shift[:, None] + np.arange(min(FAR, len(cand)))) % len(cand)]
            value = np.take_along_axis(s, top, 1)
            order = np.argsort(-value, axis=1, kind="stable")
            a, b = _prune(single, lo, np.take_along_axis(top, order, 1), np.take_along_axis(value, order, 1), degree)
            one += [a, b] if both else [a]
            two += [b, a] if both else [b]
    edges = np.unique(np.concatenate(one) * n + np.concatenate(two))
    a, b = edges // n, edges % n
    first = np.searchsorted(a, np.arange(n + 1))
    hubs = np.flatnonzero(np.diff(first) > MAX_DEGREE)
    if len(hubs):  # edges back aren't bounded by DEGREE
        keep = ~np.isin(a, hubs)
        one, two = [a[keep]], [b[keep]]
        for i in hubs:
            c = b[first[i]:first[i + 1]]
            s = single[c] @ single[i]
            order = np.argsort(-s, kind="stable")
            x, y = _prune(single, i, c[order][None], s[order][None], MAX_DEGREE)
            one.append(x)
            two.append(y)
        edges = np.unique(np.concatenate(one) * n + np.concatenate(two))
        a, b = edges // n, edges % n
        first = np.searchsorted(a, np.arange(n + 1))
    reached = np.zeros(n, bool)
    front = np.array([int((v @ v.mean(0)).argmax())])
    more = []
    while True:
        while len(front):
            reached[front] = True
            next_ = np.concatenate([b[first[i]:first[i + 1]] for i in front])
            front = np.unique(next_[~reached[next_]])
        lost = np.flatnonzero(~reached)
        if not len(lost):
            break
        known = np.flatnonzero(reached)
        near = known[int((single[known] @ single[lost[0]]).argmax())]
        more.append((near, lost[0]))
        front = lost[:1]
    if more:
        a, b = np.concatenate([a, [x for x, _ in more]]), np.concatenate([b, [y for _, y in more]])
    return a, b


def range_search(v: np.ndarray, first: np.ndarray, near: np.ndarray, least: float, verify):
    """Search every vector from the medoid; the neighbours of i are ``near[first[i]:first[i + 1]]``.
    Calls ``verify(queries, found)`` with index arrays."""
    n = len(v)
    single = v.astype(np.float32)
    mean = v.mean(0)
    medoid = int((v @ mean).argmax())
    slack = np.float32(least - 0.02)
    step = max(1, CELLS // max(n, (1 + len(near) // n) * ROUNDS * v.shape[1] // 4))
    most = max(1, CELLS // v.shape[1])
    for lo in range(0, n, step):
        q = np.arange(lo, min(lo + step, n))
        seen = np.full((len(q), n), -3, np.float32)  # similarities of vectors met so far
        todo = seen.copy()  # of those that aren't expanded yet
        seen[:, medoid] = todo[:, medoid] = single[q] @ single[medoid]
        live = np.arange(len(q))
        while len(live):
            k = min(ROUNDS, n)
            part = todo[live]
            top = np.argpartition(-part, k - 1, axis=1)[:, :k] if k < n else np.tile(np.arange(n), (len(live), 1))
            value = np.take_along_axis(part, top, 1)
            beam = min(BEAM, n) - 1
            floor = -np.partition(-seen[live], beam, axis=1)[:, beam]
            go = (value > -3) & ((value >= floor[:, None]) | (value >= slack))
            row, col = np.nonzero(go)
            if not len(row):
                break
            who, node = live[row], top[row, col]
            todo[who, node] = -3
            degree = first[node + 1] - first[node]
            a = np.repeat(who, degree)
            b = near[np.arange(len(a)) + np.repeat(first[node] - (np.cumsum(degree) - degree), degree)]
            new = seen[a, b] == -3
            a, b = a[new], b[new]
            for at in range(0, len(a), most):
                x, y = a[at:at + most], b[at:at + most]
                s = np.einsum("nd,nd->n", single[q[x]], single[y])
                seen[x, y] = s
                todo[x, y] = s
            live = np.unique(who)
        a, b = np.nonzero(seen >= slack)
        other = q[a] != b
        verify(q[a[other]], b[other])


def _merge(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Union of the pairs' trees; ``root`` maps every vertex to its smallest."""
    while True:
        x, y = root[a], root[b]
        if (x == y).all():
            return root
        low = np.minimum(x, y)
        np.minimum.at(root, x, low)
        np.minimum.at(root, y, low)
        while True:
            up = root[root]
            if (up == root).all():
                break
            root = up


def _padded(lists: pa.ListArray) -> np.ndarray:
    """Lists as rows of one width, filled up by -1."""
    n = np.asarray(lists.value_lengths())
    out = np.full((len(n), max(n.max(initial=0), 1)), -1)
    out[np.arange(out.shape[1]) < n[:, None]] = np.asarray(lists.flatten())
    return out


def _build(table: pa.Table) -> pa.Table:
    ids = np.asarray(table["id"])
    order = np.argsort(ids)
    ids = ids[order]
    a, b = pruned_graph(_unit(_matrix(table["x"].combine_chunks())[order]))
    sort = np.argsort(a, kind="stable")
    first = np.searchsorted(a[sort], np.arange(len(ids) + 1)).astype(np.int32)
    return pa.table({"id": ids, "near": pa.ListArray.from_arrays(pa.array(first), pa.array(ids[b[sort]]))})


def _search(threshold: float):
    def run(table: pa.Table) -> pa.Table:
        ids = np.asarray(table["id"])
        order = np.argsort(ids)
        ids = ids[order]
        raw = _matrix(table["x"].combine_chunks())[order]
        copies = np.asarray(table["n_copies"])[order]
        of = _padded(table["shards"].combine_chunks().take(pa.array(order)))
        lists = table["near"].combine_chunks().take(pa.array(order))
        here = table["shard"][0].as_py()
        near = np.asarray(lists.flatten(), np.int64)
        owner = np.repeat(np.arange(len(ids)), np.asarray(lists.value_lengths()))
        at = np.minimum(np.searchsorted(ids, near), len(ids) - 1)
        known = ids[at] == near  # neighbours of other shards aren't here
        near, first_near = at[known], np.searchsorted(owner[known], np.arange(len(ids) + 1))
        norm = np.sqrt(np.einsum("nd,nd->n", raw, raw))
        links = np.zeros(len(ids), np.int64)
        root = np.arange(len(ids))

        def verify(a, b):
            nonlocal root
            for lo in range(0, len(a), 50_000):
                x, y = a[lo:lo + 50_000], b[lo:lo + 50_000]
                ok = np.einsum("nd,nd->n", raw[x], raw[y]) / (norm[x] * norm[y]) >= threshold
                x, y = x[ok], y[ok]
                root = _merge(root, x, y)
                # counted in the first shard that both are in
                both = (of[x][:, :, None] == of[y][:, None, :]) & (of[x] >= 0)[:, :, None]
                first = np.where(both.any(2), of[x], np.iinfo(np.int64).max).min(1)
                x, y = x[first == here], y[first == here]
                np.add.at(links, x, copies[y])
        range_search(_unit(raw), first_near, near, threshold, verify)
        return pa.table({"id": ids, "links": links, "root": ids[root]})
    return run


def _in_range(x: np.ndarray, y: np.ndarray, threshold: float, size: int = 2_048):
    """Pairs (p, q) of raw vectors in range, a tile at a time: single precision tells, and where its
    rounding might, the cosine in double precision."""
    one, two = _unit(x).astype(np.float32), _unit(y).astype(np.float32)
    n, m = np.sqrt(np.einsum("nd,nd->n", x, x)), np.sqrt(np.einsum("nd,nd->n", y, y))
    band = np.float32((x.shape[1] + 8) * 1.2e-7)
    for lo in range(0, len(x), BLOCK):
        for at in range(0, len(y), size):
            p, q = np.nonzero((s := one[lo:lo + BLOCK] @ two[at:at + size].T) >= np.float32(threshold) - band)
            sure = s[p, q] > np.float32(threshold) + band
            p, q = p + lo, q + at
            unsure = np.flatnonzero(~sure)
            for i in range(0, len(unsure), 50_000):
                part = unsure[i:i + 50_000]
                a, b = p[part], q[part]
                sure[part] = np.einsum("nd,nd->n", x[a], y[b]) / (n[a] * m[b]) >= threshold
            yield p[sure], q[sure]


def _compare(threshold: float):
    """Links of the queries of a cell to its vectors; lengths meet their own."""
    def run(queries: pa.Table, vectors: pa.Table) -> pa.Table:
        ids = np.asarray(queries["asked"])
        links = np.zeros(len(ids), np.int64)
        if not (len(ids) and vectors.num_rows):
            return pa.table({"id": ids, "audit_links": links})
        x, y = queries["q"].combine_chunks(), vectors["x"].combine_chunks()
        q, w = np.asarray(x.value_lengths()), np.asarray(y.value_lengths())
        own, copies = np.asarray(vectors["id"]), np.asarray(vectors["n_copies"])
        for size in np.intersect1d(q, w):
            one, two = np.flatnonzero(q == size), np.flatnonzero(w == size)
            for i, j in _in_range(_matrix(x.take(pa.array(one))), _matrix(y.take(pa.array(two))), threshold):
                i, j = one[i], two[j]
                other = ids[i] != own[j]
                np.add.at(links, i[other], copies[j[other]])
        return pa.table({"id": ids, "audit_links": links})
    return run


def _audit(vectors: DataFrame, threshold: float, every: int) -> DataFrame:
    """(id, audit_links): exact links of the vertices whose vec_id is divisible by
    ``every`` and of about ``LEAST_ASKED`` others of each label.  A label's vectors are dealt to chunks of at most
    about ``CHUNK_BLOCKS`` blocks, its queries too, and every chunk of queries meets every chunk of vectors in
    a cell of its own, so that a large label is many tasks."""
    spark = vectors.sparkSession
    tasks = partitions(spark)
    counts = vectors.groupBy("label").agg(F.count("*").alias("n"), F.least(F.lit(1.0), LEAST_ASKED / F.count("*")).alias("share"))
    counts = stored(counts, "audit-labels")
    unit = F.pmod(F.xxhash64("id", F.lit(9)), F.lit(1 << 30)) / float(1 << 30)
    is_asked = (F.coalesce(F.col("vec_id") % every, F.lit(1)) == 0) | (unit < F.col("share"))
    asked = vectors.select("id", "vec_id", "label").join(broadcast_if_small(counts, 10_000), "label").filter(is_asked).groupBy("label").agg(F.count("*").alias("n_asked"))
    total = counts.agg(F.sum("n")).first()[0] or 1
    blocks = F.ceil(F.col("n") / BLOCK)
    cells = counts.join(asked, "label").select(
        "label", "share", F.least(blocks, F.greatest(F.ceil(F.col("n") * (tasks / total)), F.ceil(blocks / CHUNK_BLOCKS))).alias("n_chunks"), F.ceil(F.col("n_asked") / (BLOCK * CHUNK_BLOCKS)).alias("n_asks"))
    v = vectors.join(broadcast_if_small(stored(cells, "audit-cells"), 10_000), "label")
    among = lambda salt, n: F.pmod(F.xxhash64("id", F.lit(salt)), F.col(n))
    each = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    queries = v.filter(is_asked).select(F.col("label").alias("of"), F.col("id").alias("asked"), F.col("x").alias("q"), among(2, "n_asks").alias("own"), each("n_chunks").alias("with"))
    base = v.select("label", "id", "x", "n_copies", among(1, "n_chunks").alias("chunk"), each("n_asks").alias("ask"))
    found = queries.groupBy("of", "with", "own").cogroup(base.groupBy("label", "chunk", "ask")).applyInArrow(_compare(threshold), "id long, audit_links long")
    return stored(found.groupBy("id").agg(F.sum("audit_links").alias("audit_links")), "audit")


def _near(a: np.ndarray, c: np.ndarray, threshold: float) -> np.ndarray:
    return (a @ c.T) / np.outer(np.linalg.norm(a, axis=1), np.linalg.norm(c, axis=1)) >= threshold


def _block_roots(threshold: float):
    """Adds to every block of vectors the first vector of each one's tree within the block."""
    def run(batches):
        for b in batches:
            roots = []
            for rows in b.column(b.schema.get_field_index("rows")):
                x = _matrix(rows.values.flatten()[1])
                root = np.arange(len(x))
                for lo in range(0, len(x), BLOCK):
                    p, q = np.nonzero(_near(x[lo:lo + BLOCK], x, threshold))
                    root = _merge(root, p + lo, q)
                roots.append(root)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(roots, pa.list_(pa.int64()))], names=[*b.schema.names, "root"])
    return run


def _block_pairs(threshold: float):
    """Links of a block with another or itself, and edges between their trees."""
    def run(batches):
        for b in batches:
            ids, links, root = [], [], []
            for i in range(b.num_rows):
                here, same, rows, r, rows2, r2 = (b.column(j)[i] for j in range(6))
                here, same = here.as_py(), same.as_py()
                (one, x, copies, shards), (two, y, copies2, shards2) = rows.values.flatten(), rows2.values.flatten()
                one, two, x, y, of, of2 = np.asarray(one), np.asarray(two), _matrix(x), _matrix(y), _padded(shards), _padded(shards2)
                copies, copies2, r, r2 = np.asarray(copies), np.asarray(copies2), np.asarray(r.values), np.asarray(r2.values)
                n, n2, trees = np.zeros(len(one), np.int64), np.zeros(len(two), np.int64), []
                for lo in range(0, len(one), BLOCK):
                    s = _near(x[lo:lo + BLOCK], y, threshold)
                    if same:
                        s[np.arange(len(s)), np.arange(lo, lo + len(s))] = False
                    else:
                        p, q = np.nonzero(s)
                        trees.append(np.unique(r[p + lo] * len(two) + r2[q]))
                    # counted in the first shard that both are in
                    mine = of[lo:lo + BLOCK]
                    mine = np.where(mine < here, mine, -1)
                    for j in range(mine.shape[1]):
                        for k in range(of2.shape[1]):
                            s &= (mine[:, j] < 0)[:, None] | (mine[:, j][:, None] != of2[:, k])
                    n[lo:lo + BLOCK] = s @ copies2
                    if not same:
                        n2 += copies[lo:lo + BLOCK] @ s
                edge = np.unique(np.concatenate(trees)) if trees else np.zeros(0, np.int64)
                tree = _merge(np.arange(len(one) + len(two)), edge // len(two), len(one) + edge % len(two))
                both = np.concatenate([one, two])
                if same:
                    tree[:len(one)] = r
                for names, count, least in ((one, n, tree[:len(one)]), (two, n2, tree[len(one):])):
                    some = (count > 0) | (both[least] != names) if not same or names is one else np.zeros(len(names), bool)
                    ids.append(names[some])
                    links.append(count[some])
                    root.append(both[least][some])
            whole = lambda parts: pa.array(np.concatenate(parts) if parts else np.zeros(0, np.int64), pa.int64())
            yield pa.RecordBatch.from_arrays([whole(ids), whole(links), whole(root)], names=["id", "links", "root"])
    return run


def compare_all(members: DataFrame, by: list[str], threshold: float) -> DataFrame:
    """(id, links, root) of all pairs of ``members`` (id, x, n_copies, shards, shard) that are
    equal in ``by``: they are dealt to blocks of about ``EXACT_BLOCK``, and every pair of
    blocks is a row of its own, so that a large group is spread over all tasks."""
    spark = members.sparkSession
    sizes = members.groupBy(*by).agg(F.ceil(F.count("*") / EXACT_BLOCK).alias("n_blocks"))
    dealt = members.join(broadcast_if_small(sizes, 10_000), by).withColumn("block", F.pmod(F.xxhash64("id", F.lit(3)), F.col("n_blocks")))
    packed = dealt.groupBy(*by, "n_blocks", "block").agg(F.first("shard").alias("here"), F.collect_list(F.struct("id", "x", "n_copies", "shards")).alias("rows"))
    kind = ", ".join(f"{c.name} {c.dataType.simpleString()}" for c in packed.schema)
    with batch_rows(spark, 2):
        packed = stored(packed.mapInArrow(_block_roots(threshold), f"{kind}, root array<long>"), "blocks")
    one = packed.select(*by, "here", "rows", "root", F.col("block").alias("own"), F.explode(F.sequence("block", F.col("n_blocks") - 1)).alias("block"))
    two = packed.select(*by, "block", F.col("rows").alias("rows2"), F.col("root").alias("root2"))
    pairs = one.join(two, [*by, "block"]).select("here", (F.col("own") == F.col("block")).alias("same"), "rows", "root", "rows2", "root2")
    with batch_rows(spark, 2):
        return stored(pairs.mapInArrow(_block_pairs(threshold), "id long, links long, root long"), "compared")


def link(vectors: DataFrame, centroids: dict, overlap: int, threshold: float) -> tuple[DataFrame, DataFrame]:
    """(id, links) summed over the shards, and the shards' local trees as edges (a, b)."""
    small_batches(vectors.sparkSession)
    given = vectors.select("id", "label", "x", "n_copies")
    dealt = stored(given.mapInArrow(_assign(centroids, overlap), "id long, label long, x array<double>, n_copies long, shards array<long>"), "dealt")
    first = dealt.select("id", "x", "n_copies", F.explode("shards").alias("shard"))
    members = split_shards(first, overlap, threshold)
    if members is first:
        members = dealt.select("id", "x", "n_copies", "shards", F.explode("shards").alias("shard"))
    else:
        of = members.groupBy("id").agg(F.sort_array(F.collect_list("shard")).alias("shards"))
        members = stored(members.join(of, "id"), "members")
    sizes = members.groupBy("shard").count()
    large = stored(sizes.filter(F.col("count") > MAX_SHARD).select("shard"), "dense-shards")
    more = None
    if not large.isEmpty():
        large = broadcast_if_small(large, 100_000)
        more = compare_all(members.join(large, "shard", "left_semi"), ["shard"], threshold)
        members = members.join(large, "shard", "left_anti")
    built = members.select("id", "x", "shard").groupBy("shard").applyInArrow(_build, "id long, near array<long>")
    united = stored(built.groupBy("id").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near")), "adjacency")
    graph = members.join(united, "id")
    found = stored(graph.groupBy("shard").applyInArrow(_search(threshold), "id long, links long, root long"), "found")
    if more is not None:
        found = found.unionByName(more)
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    return links, found.filter("id <> root").select(F.col("id").alias("a"), F.col("root").alias("b"))


def _short_labels(vertices: DataFrame, audit: DataFrame, links: DataFrame) -> DataFrame:
    """Labels that miss too many links of the audit: of all, or of their vectors in the mean."""
    asked = audit.filter("audit_links > 0").join(vertices.select("id", "label"), "id").join(links, "id", "left")
    got = F.coalesce("links", F.lit(0))
    recall = asked.groupBy("label").agg((F.sum(got) / F.sum("audit_links")).alias("of_links"), F.avg(got / F.col("audit_links")).alias("of_vectors"))
    return recall.filter(F.least("of_links", "of_vectors") < LEAST_RECALL).select("label")


def near_duplicate_vectors(table: DataFrame, *, key: str, vector: str, label: str, threshold: float = THRESHOLD, every: int = AUDIT) -> DataFrame:
    """One row per vector: the key, n_links, component_id, kept, audit_links (null if not audited)."""
    x = F.transform(F.col(vector), lambda c: c.cast("double"))
    fine = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))) & F.exists(x, lambda c: c != 0) & F.col(label).isNotNull()
    rows = table.select(F.col(key).cast("long").alias("vec_id"), F.col(label).cast("long").alias("label"), x.alias("x"), F.coalesce(fine, F.lit(False)).alias("fine"))
    rows = stored(rows.select("*", F.xxhash64(F.lit(1), "x").alias("ha"), F.xxhash64(F.lit(2), "x").alias("hb"), row_id().alias("row_id")), "vectors")
    order = F.struct(F.col("vec_id").isNull().alias("no_id"), "vec_id", "row_id")
    same = ["label", "ha", "hb"]
    top = F.min(order)
    vertices = stored(rows.filter("fine").groupBy(*same).agg(top.alias("top"), F.count("*").alias("n_copies"), F.min_by("x", order).alias("x"))
                      .select(*same, "n_copies", "x", F.col("top.vec_id").alias("vec_id"), F.col("top.row_id").alias("id")), "vertices")
    audit = _audit(vertices, threshold, every)
    centroids = fit_centroids(vertices)
    for overlap in range(OVERLAP, MAX_OVERLAP + 1):
        links, trees = link(vertices, centroids, overlap, threshold)
        links = stored(links, "links")
        short = stored(_short_labels(vertices, audit, links), "short-labels")
        if short.isEmpty():
            break
    else:  # more overlap doesn't mend what the search itself misses
        whole = vertices.join(broadcast_if_small(short), "label", "left_semi").withColumns({"length": F.size("x"), "shard": F.lit(0).cast("long")})
        found = compare_all(whole.withColumn("shards", F.array("shard")), ["label", "length"], threshold)
        exact = found.groupBy("id").agg(F.sum("links").alias("links"))
        links = stored(links.join(whole.select("id"), "id", "left_anti").unionByName(exact), "links-whole")
        trees = trees.unionByName(found.filter("id <> root").select(F.col("id").alias("a"), F.col("root").alias("b")))
    group = components(trees).withColumnRenamed("id", "v")
    named = vertices.select(*same, "id", "n_copies", "vec_id").join(links, "id", "left")
    named = named.join(group, named.id == group.v, "left").withColumn("component", F.coalesce("component", "id"))
    named = stored(named.join(audit, "id", "left").select(*same, "vec_id", "n_copies", F.coalesce("links", F.lit(0)).alias("links"), "component",
                                                                         F.when(F.col("vec_id") % every == 0, F.col("audit_links")).alias("audit_links")), "named")
    least = stored(named.groupBy("component").agg(F.min("vec_id").alias("component_id")), "component-ids")
    known = stored(named.join(least, "component").select(*same, "component_id", (F.col("links") + F.col("n_copies") - 1).alias("n_links"), (F.col("audit_links") + F.col("n_copies") - 1).alias("audit_links")), "known")
    linked = rows.filter("fine").drop("x", "fine").join(known, same).select("vec_id", "n_links", "component_id", "audit_links")
    alone = rows.filter("not fine").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(None).cast("long").alias("audit_links"))
    out = linked.unionByName(alone)
    return out.select(F.col("vec_id").alias(key), "n_links", "component_id", F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"), "audit_links")


@query("op6_pruned_graph")
def op6_pruned_graph(spark, sf_dir):
    return near_duplicate_vectors(read_table(spark, sf_dir, "embeddings"), key="vec_id", vector="embedding", label="label")
