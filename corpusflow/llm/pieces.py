"""SentencePiece encoding and decoding, and sampled segmentations.

``encode`` and ``decode`` are the plain ones.  ``sample`` draws the ``k`` best
segmentations of a text under Gumbel perturbation: distinct segmentations
without replacement, in falling order of their perturbed log probability.

The lattice of a text has an edge for every vocabulary piece that matches; a
character that no piece covers is its UTF-8 bytes.  A piece's log probability
falls with its rank in the vocabulary (Zipf's law), and backward sums over the
lattice make every step's probabilities exact.  The search is A* over sets of
segmentations: a set is all that share a path up to some step and leave it
there; its bound is the maximum of its perturbed values, a Gumbel variable cut
off at its parent's, and so exact.  The best open set gives the next
segmentation (a draw from within the set) and is split along it.  The bound of
the best set left over at the end gives the inclusion scores: the log probability
of a segmentation to be among the sample at that threshold.

No piece holds a blank after another character, so the lattice falls into
units, words with the blanks before them, that meet in single nodes; edges and
sums are computed once for equal units of a batch.  All random numbers are
hashes of the row's key, the sample's number and the place, so a repeated task
draws the same.

Defined results: null and empty texts have one segmentation, the empty one;
texts with fewer than ``k`` segmentations give all of them; repeated rows and
null keys give rows of their own (equal keys and texts draw the same); an
empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusflow.llm.common import mix64, read_table, small_batches
from corpusflow.llm.registry import query

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SAMPLES = 2
ZIPF_SHIFT = 2.7
BLANK = "▁"
# Log mass up to which all steps are looked at first, and the most that a Gumbel
# variable of 53 random bits can add to it.
REACH, FINEST = -80.0, 37.5
_U = np.uint64


class Vocabulary:
    """Pieces of a model as a trie in a hash table."""

    def __init__(self, path: str):
        sp = self.sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = sp.get_piece_size()
        self.bytes_of: list[bytes] = []
        self.byte_id = np.zeros(256, np.int64)
        nodes: dict[tuple[int, int], int] = {}
        piece_of = [-1]
        rank = 0
        self.score = np.full(self.size, -math.log(self.size + ZIPF_SHIFT))
        for i in range(self.size):
            p = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.byte_id[int(p[3:5], 16)] = i
                self.bytes_of.append(bytes([int(p[3:5], 16)]))
                continue
            self.bytes_of.append(b"" if sp.is_control(i) or sp.is_unknown(i) else p.replace(BLANK, " ").encode())
            if sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i) or BLANK in p.lstrip(BLANK):
                continue
            rank += 1
            self.score[i] = -math.log(rank + ZIPF_SHIFT)
            node = 0
            for c in p:
                key = (node, 32 if c == BLANK else ord(c))
                if key not in nodes:
                    nodes[key] = len(piece_of)
                    piece_of.append(-1)
                node = nodes[key]
            piece_of[node] = i
        self.bytes_array = np.empty(self.size, object)
        self.bytes_array[:] = self.bytes_of
        self.piece_of = np.array(piece_of, np.int32)
        self.longest = max((len(sp.id_to_piece(i)) for i in range(self.size)), default=1)
        bits = max(10, (4 * len(nodes)).bit_length())
        self.shift, self.mask = _U(64 - bits), (1 << bits) - 1
        keys = np.array([n << 21 | c for n, c in nodes], np.int64)
        slots = ((keys.astype(_U) * _U(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)
        self.keys, self.values = np.full(1 << bits, -1, np.int64), np.zeros(1 << bits, np.int32)
        self.probes = 1
        for key, slot, value in zip(keys.tolist(), slots.tolist(), nodes.values(), strict=True):
            n = 1
            while self.keys[slot] != -1:
                slot, n = slot + 1 & self.mask, n + 1
            self.keys[slot], self.values[slot] = key, value
            self.probes = max(self.probes, n)

    def step(self, node: np.ndarray, code: np.ndarray) -> np.ndarray:
        """Children by character; 0 where there is none."""
        key = node.astype(np.int64) << 21 | code
        slot = ((key.astype(_U) * _U(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)
        there = self.keys[slot]
        out = np.where(there == key, self.values[slot], 0)
        left = np.flatnonzero((there != key) & (there != -1))
        for _ in range(self.probes):
            if not len(left):
                break
            slot[left] = slot[left] + 1 & self.mask
            there = self.keys[slot[left]]
            hit = there == key[left]
            out[left[hit]] = self.values[slot[left[hit]]]
            left = left[~hit & (there != -1)]
        return out


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


class Lattice:
    """Edges of the distinct units of some texts, with the steps' probabilities."""

    def __init__(self, texts: list[str], v: Vocabulary):
        codes = np.frombuffer("".join(f" {t}" if t else "" for t in texts).encode("utf-32-le", "surrogatepass"), np.int32)
        length = np.array([len(t) + 1 if t else 0 for t in texts], np.int64)
        bound = np.concatenate([[0], np.cumsum(length)])
        blank = codes == 32
        start = blank.copy()
        start[1:] &= ~blank[:-1]
        start[bound[:-1][length > 0]] = True
        at = np.flatnonzero(start)
        self.first_unit = np.searchsorted(at, bound)
        ends = np.append(at[1:], len(codes))
        # equal units, by 64-bit hashes of their characters
        power = np.full(len(codes) + 1, _U(0x9E3779B97F4A7C15))
        power[0] = 1
        power = np.multiply.accumulate(power)
        inverse = np.full(len(codes) + 1, _U(pow(0x9E3779B97F4A7C15, -1, 1 << 64)))
        inverse[0] = 1
        inverse = np.multiply.accumulate(inverse)
        total = np.concatenate([np.zeros(1, _U), np.cumsum(mix64(codes.astype(_U)) * power[:len(codes)], dtype=_U)])
        h = mix64((total[ends] - total[at]) * inverse[at])
        _, pick, self.unit = np.unique(h, return_index=True, return_inverse=True)
        # the longest unit first: then the units that reach back to a depth (the
        # characters left to the end) are the first ones, and a position is the
        # start of its depth plus its unit; depth 0 is the end
        size = (ends - at)[pick]
        order = np.argsort(-size, kind="stable")
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        self.unit, size, pick = rank[self.unit], size[order], pick[order]
        self.n_units = len(size)
        deepest = int(size[0]) if len(size) else 0
        per_depth = np.searchsorted(-size, -np.arange(deepest + 1), "right")
        self.depth = np.concatenate([[0], np.cumsum(per_depth)])
        self.start = self.depth[size] + np.arange(self.n_units)
        depth = np.repeat(np.arange(deepest + 1, dtype=np.int32), per_depth)
        unit = np.arange(len(depth), dtype=np.int32) - self.depth[depth].astype(np.int32)
        chars = codes[np.minimum((at[pick] + size)[unit] - depth, len(codes) - 1)] if len(codes) else codes
        self._edges(depth, unit, chars, v)

    def _edges(self, depth, unit, chars, v: Vocabulary):
        n, first = len(depth), self.n_units
        codes = np.where(chars == ord(BLANK), 0x1FFFFF, chars)  # no piece has that one
        starts = self.depth.astype(np.int32)
        pos, node, found = np.arange(first, n, dtype=np.int32), np.zeros(n - first, np.int32), []
        covered = np.zeros(n, bool)
        covered[:first] = True
        for size in range(1, v.longest + 1):
            node = v.step(node, codes[starts[depth[pos] - size + 1] + unit[pos]])
            live = np.flatnonzero(node)
            pos, node = pos[live], node[live]
            piece = v.piece_of[node]
            ok = np.flatnonzero(piece >= 0)
            found.append((pos[ok], size, piece[ok], v.score[piece[ok]]))
            if size == 1:
                covered[pos[ok]] = True
            more = depth[pos] > size
            pos, node = pos[more], node[more]
            if not len(pos):
                break
        bare = np.flatnonzero(~covered)
        if len(bare):  # bytes; a character of several is one edge, numbered beyond the pieces
            c = chars[bare]
            n_bytes = 1 + (c >= 0x80) + (c >= 0x800) + (c >= 0x10000)
            found.insert(0, (bare, 1, np.where(c < 0x80, v.byte_id[np.minimum(c, 127)], v.size + c), n_bytes * -math.log(v.size + ZIPF_SHIFT)))
        count = np.zeros(n, np.int64)
        for p, *_ in found:
            count[p] += 1
        self.edge = np.concatenate([[0], np.cumsum(count)])  # the first edge of each position
        self.pos = np.repeat(np.arange(n, dtype=np.int32), count)
        self.to, self.piece, self.logq = np.zeros(len(self.pos), np.int32), np.zeros(len(self.pos), np.int32), np.zeros(len(self.pos))
        free = self.edge[:-1].copy()
        for p, size, piece, score in reversed(found):  # long pieces first: they're likely, and drawing looks at them first
            slot = free[p]
            free[p] += 1
            self.to[slot] = starts[depth[p] - size] + unit[p]
            self.piece[slot], self.logq[slot] = piece, score
        # backward sums, depth by depth
        beta = np.zeros(n)
        for d in range(1, len(self.depth) - 1):
            a, z = self.depth[d], self.depth[d + 1]
            lo, hi = self.edge[a], self.edge[z]
            own = self.edge[a:z] - lo
            x = self.logq[lo:hi] + beta[self.to[lo:hi]]
            top = np.maximum.reduceat(x, own)
            beta[a:z] = top + np.log(np.add.reduceat(np.exp(x - np.repeat(top, count[a:z])), own))
            self.logq[lo:hi] = x - np.repeat(beta[a:z], count[a:z])
        self.q = np.exp(self.logq)
        run = np.concatenate([[0.0], np.cumsum(self.q)])
        self.upto = run[1:] - run[self.edge[self.pos]]
        last = self.edge[1:] - 1
        self.upto[last[count > 0]] = 2.0  # rounding can't lead beyond a position's edges


def _uniform(x: np.ndarray) -> np.ndarray:
    return ((mix64(x) >> _U(11)).astype(float) + 0.5) * 2.0 ** -53


def _walk(lat: Lattice, units: np.ndarray, pos: np.ndarray, seeds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Draw each unit's steps from a position to its end; the edges in order, and their number per unit."""
    count = np.zeros(len(units), np.int64)
    live = np.arange(len(units))
    live = live[pos >= lat.n_units]
    steps = []
    k = 0
    pos = pos.copy()
    while len(live):
        u = _uniform(seeds[live] + np.full(1, k, _U) * _U(0xA24BAED4963EE407))
        edge = lat.edge[pos[live]]
        late = np.flatnonzero(u > lat.upto[edge])
        while len(late):
            edge[late] += 1
            late = late[u[late] > lat.upto[edge[late]]]
        steps.append((live, edge))
        count[live] += 1
        pos[live] = lat.to[edge]
        live = live[pos[live] >= lat.n_units]
        k += 1
    out = np.zeros(int(count.sum()), np.int64)
    place = np.cumsum(count) - count
    for k, (who, edge) in enumerate(steps):
        out[place[who] + k] = edge
    return out, count


def _cut_gumbel(mass: np.ndarray, top: np.ndarray, u: np.ndarray) -> np.ndarray:
    """Gumbel variables of log ``mass`` given that they're at most ``top``."""
    with np.errstate(over="ignore", divide="ignore", invalid="ignore"):
        g = mass - np.log(np.exp(mass - top) - np.log(u))
    return np.where(np.isfinite(mass), np.minimum(g, top), -np.inf)


class _Path:
    """One segmentation of every text: edges, bounds per text, and the open sets' values per step."""

    def __init__(self, lat, edges, bound, value, branch, barred, seeds):
        self.edges, self.bound, self.value, self.branch, self.barred = edges, bound, value, branch, barred
        n = np.diff(bound)
        run = np.concatenate([[0.0], np.cumsum(lat.logq[edges])])
        self.log_prob = run[bound[1:]] - run[bound[:-1]]
        self.open = np.full(len(edges), -np.inf)
        # a set's value is at most its log mass plus FINEST, so of a text's steps
        # those before REACH are enough once one of them is above REACH + FINEST
        reach = run[:-1] - np.repeat(run[bound[:-1]], n) > REACH
        self._bounds(lat, run, np.flatnonzero(reach), seeds)
        short = np.flatnonzero(np.isfinite(value) & (self.best() <= REACH + FINEST) & (self.log_prob <= REACH))
        if len(short):
            at = np.concatenate([np.arange(bound[i], bound[i + 1]) for i in short])
            self._bounds(lat, run, at[~reach[at]], seeds)

    def _bounds(self, lat, run, at, seeds):
        """Values of the sets that leave the path at the given steps."""
        text = np.searchsorted(self.bound, at, "right") - 1
        edges, first = self.edges[at], self.bound[text]
        step = at - first
        q = lat.q[edges]
        place = lat.pos[edges]
        gone = np.ones(len(at), np.int64)
        turning = np.flatnonzero(step == self.branch[text]) if self.barred else []
        for j in turning:  # at its branching step a set bars the edges of earlier paths too
            b = self.barred.get(int(text[j]), ())
            q[j] += sum(lat.q[x] for x in b)
            gone[j] += len(b)
        with np.errstate(divide="ignore"):
            mass = np.where((lat.edge[place + 1] - lat.edge[place] > gone) & (step >= self.branch[text]), run[at] - run[first] + np.log1p(-np.minimum(q, 1.0)), -np.inf)
        u = _uniform(seeds[text] + step.astype(_U) * _U(0xD1342543DE82EF95))
        self.open[at] = _cut_gumbel(mass, self.value[text], u)

    def best(self) -> np.ndarray:
        n = np.diff(self.bound)
        out = np.full(len(n), -np.inf)
        some = np.flatnonzero(n)
        if len(some):
            out[some] = np.maximum.reduceat(self.open, self.bound[some])
        return out


def sample_texts(texts: list[str], keys: np.ndarray, v: Vocabulary, k: int):
    """Per sample: (texts that have it, edges' pieces, bounds, log probabilities,
    perturbed values); and each text's threshold."""
    lat = Lattice(texts, v)
    n = len(texts)
    root = mix64(keys.astype(_U) + _U(0x1D8E4E27C47D124F))
    first = lat.first_unit
    ordinal = (np.arange(first[-1]) - np.repeat(first[:-1], np.diff(first))).astype(_U)
    text_of = np.repeat(np.arange(n), np.diff(first))

    def seeds(number: int) -> np.ndarray:
        return mix64(root + np.full(1, number, _U) * _U(0x8CB92BA72F3D8DD7))

    own = seeds(1)
    edges, count = _walk(lat, lat.unit, lat.start[lat.unit], mix64(own[text_of] + ordinal))
    run = np.concatenate([[0], np.cumsum(count)])
    value = -np.log(-np.log(_uniform(own ^ _U(0x5851F42D4C957F2D))))
    paths = [_Path(lat, edges, run[first], value, np.zeros(n, np.int64), {}, mix64(own + _U(7)))]
    out = [(np.arange(n), paths[0])]
    for number in range(2, k + 1):
        bests = np.array([p.best() for p in paths])
        who = bests.argmax(axis=0)
        value = bests.max(axis=0)
        own = seeds(number)
        heads, turn, edge_at, barred = [], np.zeros(n, np.int64), np.full(n, -1, np.int64), {}
        u = _uniform(own + _U(3))
        for i in np.flatnonzero(np.isfinite(value)).tolist():
            p = paths[who[i]]
            lo, hi = p.bound[i], p.bound[i + 1]
            t = int(p.open[lo:hi].argmax())
            p.open[lo + t] = -np.inf  # the set is split now
            old = [int(p.edges[lo + t])] + (p.barred.get(i, []) if t == p.branch[i] else [])
            place = lat.pos[p.edges[lo + t]]
            rest = [e for e in range(lat.edge[place], lat.edge[place + 1]) if e not in old]
            weights = np.cumsum(lat.q[rest])
            edge_at[i] = rest[min(int(np.searchsorted(weights, u[i] * weights[-1])), len(rest) - 1)]
            turn[i], barred[i] = t, old
            heads.append((i, p.edges[lo:lo + t]))
        have = np.flatnonzero(edge_at >= 0)
        if not len(have):
            break
        # units from the one that branches on
        kept = np.zeros(n, np.int64)  # units before it
        head = {i: h for i, h in heads}
        final = np.zeros(n, np.int64)
        for i in have.tolist():
            h = head[i]
            kept[i] = int((lat.to[h] < lat.n_units).sum())
            final[i] = lat.to[edge_at[i]]
        active = (edge_at[text_of] >= 0) & (ordinal.astype(np.int64) >= kept[text_of])
        units = lat.unit[active]
        start = lat.start[units]
        branching = ordinal.astype(np.int64)[active] == kept[text_of[active]]
        start[branching] = final[text_of[active][branching]]
        tail, count = _walk(lat, units, start, mix64(own[text_of[active]] + ordinal[active]))
        per_text = np.bincount(text_of[active], weights=count, minlength=n).astype(np.int64)
        bound = np.concatenate([[0], np.cumsum(np.where(edge_at >= 0, turn + 1 + per_text, 0))])
        edges = np.zeros(bound[-1], np.int64)
        tail_at = np.cumsum(per_text) - per_text
        for i in have.tolist():
            a, t = bound[i], turn[i]
            edges[a:a + t] = head[i]
            edges[a + t] = edge_at[i]
            edges[a + t + 1:bound[i + 1]] = tail[tail_at[i]:tail_at[i] + per_text[i]]
        paths.append(_Path(lat, edges, bound, np.where(edge_at >= 0, value, -np.inf), turn, barred, mix64(own + _U(7))))
        out.append((have, paths[-1]))
    threshold = np.max([p.best() for p in paths], axis=0)
    return lat, out, threshold


def _ids(lat: Lattice, edges: np.ndarray, bound: np.ndarray, v: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Piece ids of the edges; characters without a piece become their bytes."""
    piece = lat.piece[edges]
    wide = np.flatnonzero(piece >= v.size)
    if not len(wide):
        return piece, bound
    raw = [chr(c).encode("utf-8", "surrogatepass") for c in (piece[wide] - v.size).tolist()]
    times = np.ones(len(piece), np.int64)
    times[wide] = [len(r) for r in raw]
    place = np.concatenate([[0], np.cumsum(times)])
    out = np.repeat(piece, times)
    for w, r in zip(place[wide].tolist(), raw, strict=True):
        out[w:w + len(r)] = v.byte_id[list(r)]
    return out, place[bound]


def decode_ids(ids, v: Vocabulary) -> bytes:
    """UTF-8 of a sequence of pieces, without the blank that encoding puts in front."""
    out = b"".join(v.bytes_array[ids].tolist())
    return out[1:] if out[:1] == b" " else out


#: Characters whose lattices a task holds at a time (a longer text is one part).
PART_CHARS = 300_000


def _sampler(path: str, k: int):
    def run(batches):
        v = vocabulary(path)
        for b in batches:
            texts = [t or "" for t in b.column(1).to_pylist()]
            seeds = np.asarray(b.column(2)).view(_U)
            lo = 0
            while lo < len(texts):
                hi, size = lo, 0
                while hi < len(texts) and (hi == lo or size + len(texts[hi]) < PART_CHARS):
                    size += len(texts[hi])
                    hi += 1
                part = texts[lo:hi]
                lat, paths, threshold = sample_texts(part, seeds[lo:hi], v, k)
                for number, (have, p) in enumerate(paths, 1):
                    ids, bound = _ids(lat, p.edges, p.bound, v)
                    same = [decode_ids(ids[bound[i]:bound[i + 1]], v) == part[i].encode("utf-8", "surrogatepass") for i in have.tolist()]
                    above = p.log_prob - np.where(np.isfinite(threshold), threshold, -np.inf)
                    with np.errstate(over="ignore", divide="ignore"):
                        score = np.where(above < -30, above, np.log(-np.expm1(-np.exp(above))))
                    lists = pa.ListArray.from_arrays(pa.array(np.append(bound[have], bound[-1]).astype(np.int32)), pa.array(ids.astype(np.int32)))
                    yield pa.RecordBatch.from_arrays(
                        [b.column(0).slice(lo, hi - lo).take(pa.array(have)), pa.array(np.full(len(have), number, np.int32)), lists, pa.array(p.log_prob[have]),
                         pa.array(p.value[have]), pa.array(score[have]), pa.array(same, pa.bool_())],
                        names=["key", "sample", "ids", "log_prob", "perturbed", "log_inclusion", "round_trip"])
                lo = hi
    return run


def sample(docs: DataFrame, *, key: str, text: str, model: str = MODEL, k: int = SAMPLES) -> DataFrame:
    """(key, sample, ids, log_prob, perturbed, log_inclusion, round_trip): up to k rows per row."""
    small_batches(docs.sparkSession)
    given = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"), F.xxhash64(F.col(key)).alias("seed"))
    kind = given.schema["key"].dataType.simpleString()
    out = given.mapInArrow(_sampler(model, k), f"key {kind}, sample int, ids array<int>, log_prob double, perturbed double, log_inclusion double, round_trip boolean")
    return out.withColumnRenamed("key", key)


def _encoder(path: str):
    def run(batches):
        sp = vocabulary(path).sp
        for b in batches:
            ids = sp.encode([t or "" for t in b.column(1).to_pylist()], num_threads=1)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(ids, pa.list_(pa.int32()))], names=["key", "ids"])
    return run


def encode(docs: DataFrame, *, key: str, text: str, model: str = MODEL) -> DataFrame:
    """(key, ids): the model's own best segmentation."""
    given = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    return given.mapInArrow(_encoder(model), f"key {given.schema['key'].dataType.simpleString()}, ids array<int>").withColumnRenamed("key", key)


def _decoder(path: str):
    def run(batches):
        v = vocabulary(path)
        for b in batches:
            texts = [None if x is None else decode_ids(np.array([i for i in x if i is not None], np.int64), v).decode("utf-8", "replace") for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], names=["key", "text"])
    return run


def decode(rows: DataFrame, *, key: str, ids: str, model: str = MODEL) -> DataFrame:
    """(key, text) of encoded rows; null ids give a null text, null elements are skipped."""
    given = rows.select(F.col(key).alias("key"), F.col(ids).cast("array<int>").alias("ids"))
    return given.mapInArrow(_decoder(model), f"key {given.schema['key'].dataType.simpleString()}, text string").withColumnRenamed("key", key)


@query("op7_pieces")
def op7_pieces(spark, sf_dir):
    return sample(read_table(spark, sf_dir, "documents"), key="doc_id", text="text")
