"""Benchmark decontamination by template canonicalisation.

Words are lower-cased and stripped of marks; numbers, names (capitalised words
inside a sentence) and units become typed placeholders.  Windows of ``k``
canonical words are hashed, and every window of every whole document is joined
with those of the benchmark.  Matches of one document and item on one diagonal
(document position minus item position) form an alignment, whose slots must be
consistent: equal values in the item must be equal in the document, and
different ones different.  A window counts if all its words are equal, or if
none of its slots contradicts another one of the alignment; an item is found if
the distinct item windows that count, over all alignments, cover enough of it.  So a question with other numbers or
names is caught as re-parameterised, a chance agreement of forms isn't, and a
copy in which one value is changed keeps its other windows.

Windows of mostly placeholders say little and are left out where an item has
``min_plain`` windows of plain words; items shorter than ``k`` words are one
window of their own, found by their own length.

Defined results: null and empty texts are clean; an empty benchmark leaves all
clean; rows stay one to one, also repeated ones and those with null keys;
repeated items count once, under their smallest id; a document that holds
several items names the smallest id and counts all; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusflow.llm.common import WORD, blocks, content_key, lowered, mix64, read_table, row_id, small_batches, span_hashes, spans, stored, windows, without
from corpusflow.llm.registry import query
from corpusflow.operators.sizing import broadcast_if_small, fits

K = 8
COVER = 0.5
MIN_LITERAL = 4
MAX_KNOWN_WINDOWS = 4_000_000
MAX_BROADCAST_WINDOWS = 100_000
# Common units of measure and currency.
UNITS = ("%", "km", "m", "cm", "mm", "kg", "g", "mg", "lb", "lbs", "oz", "l", "ml", "mi", "mph", "ft", "inch", "inches", "yd", "miles", "meters",
         "metres", "kilometers", "kilometres", "grams", "kilograms", "liters", "litres", "pounds", "feet", "hours", "hour", "minutes", "minute",
         "seconds", "second", "days", "day", "weeks", "week", "months", "month", "years", "year", "dollars", "dollar", "cents", "euros", "euro", "usd", "eur")

_U = np.uint64
_NUMBER, _NAME, _UNIT = (mix64(np.array([x], _U))[0] for x in (101, 102, 103))
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_TOKEN = WORD.copy()
_TOKEN[ord("%")] = True
_STOP = np.zeros(256, bool)
_STOP[[ord(c) for c in ".!?\n:;|"]] = True


def _unit_hashes() -> np.ndarray:
    data = np.frombuffer("\n".join(UNITS).encode(), np.uint8)
    s, e = spans(_TOKEN[data], np.array([0, len(data)]))
    return np.sort(span_hashes(data, s, e))


_UNIT_HASH = _unit_hashes()


def canonical(data: np.ndarray, off: np.ndarray):
    """Per word of a block: canonical hash, own hash, slot type (0 none, 1 number, 2 name, 3 unit); and each text's first word."""
    token = _TOKEN[data]
    # a mark between two digits belongs to the number
    if len(data) > 2:
        inner = np.zeros(len(data), bool)
        inner[1:-1] = np.isin(data[1:-1], (44, 46)) & _DIGIT[data[:-2]] & _DIGIT[data[2:]]
        token = token | inner
    starts, ends = spans(token, off)
    own = span_hashes(lowered(data), starts, ends)
    first = np.searchsorted(starts, off)
    digits = np.concatenate([[0], np.cumsum(_DIGIT[data])])
    number = digits[ends] > digits[starts]
    before = np.concatenate([[0], np.cumsum(_STOP[data])])
    previous = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
    opening = np.zeros(len(starts), bool)
    opening[first[:-1][np.diff(first) > 0]] = True
    opening |= before[starts] > before[previous]
    upper = np.zeros(len(starts), bool)
    if len(starts):  # a capital, and then no other: words in capitals throughout aren't names
        low = lowered(data)
        wide = data[starts] == 0xC3
        at = np.minimum(starts + wide, len(data) - 1)
        after = np.minimum(at + 1, len(data) - 1)
        upper = (low[at] != data[at]) & (at + 1 < ends) & (low[after] == data[after])
        upper &= (data[after] != 0xC3) | (low[np.minimum(after + 1, len(data) - 1)] == data[np.minimum(after + 1, len(data) - 1)])
    kind = np.zeros(len(starts), np.int8)
    kind[upper & ~opening] = 2
    kind[np.isin(own, _UNIT_HASH)] = 3
    kind[number] = 1
    form = own.copy()
    for i, h in ((1, _NUMBER), (2, _NAME), (3, _UNIT)):
        form[kind == i] = h
    return form, own, kind, first


def _forms(form, own, kind):
    """The canonical words with names as slots, and with names as plain words: a name is
    known by its capital, which a copy in other case or place may lack."""
    return (form, kind), (np.where(kind == 2, own, form), np.where(kind == 2, 0, kind).astype(np.int8))


def _windows(form, kind, first, k):
    """Windows with enough plain words: hashes, positions in the block, first per text."""
    h, at, bound = windows(form, first, k)
    if not len(h):
        return h, at, bound
    plain = np.concatenate([[0], np.cumsum(kind == 0)])
    ok = plain[at + k] - plain[at] >= min(MIN_LITERAL, k)
    h, at = h[ok], at[ok]
    return h, at, np.searchsorted(at, first)


def _slots(at, own, kind, k):
    """Own hashes of the windows' slots, 0 where a word is plain."""
    cover = at[:, None] + np.arange(k)
    slots = np.where(kind[cover] > 0, own[cover].view(np.int64), 0).ravel()
    return pa.ListArray.from_arrays(pa.array(np.arange(len(at) + 1, dtype=np.int32) * k), pa.array(slots))


def _item_windows(k: int):
    def run(batches):
        for b in batches:
            for lo, hi, data, off in blocks(b.column(1)):
                form, own, kind, first = canonical(data, off)
                for i in range(hi - lo):
                    a, z = first[i], first[i + 1]
                    if z == a:
                        continue
                    m = min(k, z - a)
                    bound = np.array([0, z - a])
                    got = [(kinds[a:z], *_windows(forms[a:z], kinds[a:z], bound, m)[:2], forms[a:z]) for forms, kinds in _forms(form, own, kind)]
                    places = np.unique(np.concatenate([g[2] for g in got]))
                    if not len(places):  # an item of placeholders: all its windows count
                        got = [(g[0], *windows(g[3], bound, m)[:2], g[3]) for g in got]
                        places = np.unique(np.concatenate([g[2] for g in got]))
                    got[1:] = [(g[0], g[1][new], g[2][new], g[3]) for g in got[1:] for new in [~np.isin(g[1], got[0][1])]]
                    for kinds, h, at, _ in got:
                        same = lambda x, n=len(at): pa.array([x] * n, pa.int64())
                        yield pa.RecordBatch.from_arrays([same(b.column(0)[lo + i].as_py()), pa.array(h.view(np.int64)), _slots(at, own[a:z], kinds, m), pa.array(at), same(m), same(len(places)), same(int(z - a))],
                                                     names=["item", "h", "item_slots", "item_pos", "k", "item_windows", "item_words"])
    return run


def _doc_windows(lengths: list[int], known: np.ndarray | None):
    """Document windows of the given lengths; where the benchmark's are known, only those."""
    def run(batches):
        if known is not None:
            bits = 20 if len(known) <= 100_000 else 24
            bitmap = np.zeros(1 << bits, bool)
            bitmap[known >> _U(64 - bits)] = True
        for b in batches:
            offsets, parts = [0], []
            for lo, hi, data, off in blocks(b.column(1)):
                form, own, kind, first = canonical(data, off)
                for k, (forms, kinds) in ((k, f) for k in lengths for f in _forms(form, own, kind)):
                    h, at, _ = windows(forms, first, k)
                    if kinds is not kind and len(at):  # as above where no name is inside
                        names = np.concatenate([[0], np.cumsum(kind == 2)])
                        ok = names[at + k] > names[at]
                        h, at = h[ok], at[ok]
                    if known is not None:
                        ok = bitmap[h >> _U(64 - bits)]
                        h, at = h[ok], at[ok]
                        ok = known[np.minimum(np.searchsorted(known, h), len(known) - 1)] == h if len(known) else ok
                        h, at = h[ok], at[ok]
                    text = np.searchsorted(first, at, "right") - 1
                    parts.append((text + lo, h.view(np.int64), at - first[text], np.full(len(at), k), _slots(at, own, kinds, k)))
            text = np.concatenate([p[0] for p in parts]) if parts else np.zeros(0, np.int64)
            order = np.argsort(text, kind="stable")
            column = lambda i: np.concatenate([p[i] for p in parts])[order] if parts else np.zeros(0, np.int64)  # noqa: E731, B023
            slots = pa.concat_arrays([p[4] for p in parts]).take(pa.array(order)) if parts else pa.array([], pa.list_(pa.int64()))
            hits = pa.StructArray.from_arrays([pa.array(column(1)), pa.array(column(2)), pa.array(column(3)), slots], names=["h", "pos", "k", "slots"])
            offsets = np.searchsorted(text[order], np.arange(b.num_rows + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.ListArray.from_arrays(pa.array(offsets), hits)], names=["e", "hits"])
    return run


def item_windows(benchmark: DataFrame, item: str, text: str, k: int = K) -> DataFrame:
    """Windows of the distinct items: item, h, item_slots, item_pos, k, item_windows, item_words."""
    t = benchmark.filter(F.col(text).isNotNull()).groupBy(F.col(text).cast("string").alias("text")).agg(F.min(F.col(item).cast("long")).alias("item"))
    return stored(t.select("item", "text").mapInArrow(_item_windows(k), "item long, h long, item_slots array<long>, item_pos long, k long, item_windows long, item_words long"), "items")


def _pairs(window: str) -> str:
    return f"filter(arrays_zip({window}.item_slots, {window}.slots), p -> p.item_slots != 0)"


def contaminated(docs: DataFrame, benchmark: DataFrame, *, key: str, text: str, item: str, item_text: str, k: int = K, cover: float = COVER) -> DataFrame:
    """One narrow row per row of ``docs``: the key, its content key, contaminated, item_id, n_items, cover, exact (no slot differs)."""
    spark = docs.sparkSession
    small_batches(spark)
    items = item_windows(benchmark, item, item_text, k)
    lengths = sorted(r.k for r in items.select("k").distinct().collect())  # at most k numbers
    known = None
    hashes = items.select("h").distinct()
    if fits(hashes, MAX_KNOWN_WINDOWS):  # else all windows go to the join
        known = np.sort(np.asarray(hashes.toArrow()["h"], np.int64).view(_U))
    given = docs.select(F.struct(F.col(key).alias("key"), content_key(text).alias("content")).alias("e"), F.col(text).cast("string").alias("t"))
    rows = stored(given.mapInArrow(_doc_windows(lengths, known), f"e {given.schema['e'].dataType.simpleString()}, hits array<struct<h:long,pos:long,k:long,slots:array<long>>>")
                  .select("e.*", "hits", row_id().alias("row_id")), "document-windows")
    seen = rows.select("row_id", F.explode("hits").alias("w")).select("row_id", "w.*")
    hits = seen.join(broadcast_if_small(items, MAX_BROADCAST_WINDOWS), ["h", "k"])
    # an item's windows bound an alignment's
    aligned = hits.withColumn("diagonal", F.col("pos") - F.col("item_pos")).groupBy("row_id", "item", "diagonal").agg(
        F.first("item_windows").alias("item_windows"), F.collect_list(F.struct("item_pos", "item_slots", "slots")).alias("w"))
    aligned = aligned.withColumn("pairs", F.expr(f"array_distinct(flatten(transform(w, x -> {_pairs('x')})))"))
    # a one-to-one map of values: as many pairs as values on either side; else the pairs that share one value only
    aligned = aligned.withColumn("odd", F.expr("""if(size(pairs) = size(array_distinct(pairs.item_slots)) and size(pairs) = size(array_distinct(pairs.slots)), filter(pairs, p -> false),
        filter(pairs, p -> exists(pairs, q -> (q.item_slots = p.item_slots) != (q.slots = p.slots))))"""))
    aligned = aligned.withColumns({
        "places": F.expr(f"array_distinct(transform(filter(w, x -> x.item_slots = x.slots or not exists({_pairs('x')}, p -> array_contains(odd, p))), x -> x.item_pos))"),
        "same": F.expr("forall(pairs, p -> p.item_slots = p.slots)")})
    # inserted or cut words move a passage to another diagonal: its parts add up, but a repeated part is one
    places = aligned.select("row_id", "item", "item_windows", "same", F.explode("places").alias("item_pos"))
    places = places.groupBy("row_id", "item", "item_pos").agg(F.first("item_windows").alias("item_windows"), F.min("same").alias("same"))
    per_item = places.groupBy("row_id", "item").agg((F.count("*") / F.first("item_windows")).alias("cover"), F.min("same").alias("same"))
    found = per_item.filter(F.col("cover") >= cover).groupBy("row_id").agg(
        F.min("item").alias("item_id"), F.count("*").alias("n_items"), F.max("cover").alias("cover"), F.max("same").alias("exact"))
    return rows.select("row_id", F.col("key").alias(key), "content").join(found, "row_id", "left").withColumn("contaminated", F.col("item_id").isNotNull()).drop("row_id")


def decontaminate(docs: DataFrame, benchmark: DataFrame, *, text: str, **names) -> DataFrame:
    """The rows of ``docs`` without benchmark passages, with their own columns."""
    bad = contaminated(docs, benchmark, text=text, **names).filter("contaminated")
    return without(docs, bad.select("content.*"), text)


@query("op9_decontamination")
def op9_decontamination(spark, sf_dir):
    out = contaminated(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"),
                       key="doc_id", text="text", item="item_id", item_text="text")
    return out.select("doc_id", "contaminated", "item_id", F.coalesce("n_items", F.lit(0)).alias("n_items"), F.round(F.coalesce("cover", F.lit(0.0)), 6).alias("cover"), F.coalesce("exact", F.lit(False)).alias("exact"))
