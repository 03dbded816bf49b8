"""Line dedup by a suffix array over line ids.

The corpus is one sequence of line ids per text (lines without their outer
blanks; blank lines don't count).  Ranks of all line sequences of length 1, 2,
4, ... come by distributed prefix doubling: a round joins each place with the
one ``2^k`` lines on, counts the rank pairs, and orders them into new ranks by
prefix sums over buckets of the order.  A rank is the first place of its
interval in the suffix array; places whose interval has one member are done
and leave, so a round handles the repeated places only.

All suffixes with a common prefix of at least ``m`` lines are one interval: it
is named by the ranks of the two ``2^k``-blocks that cover the ``m`` lines.  A
repeated run counts if it has ``min_words`` words.  Every such run is the union
of the shortest such runs that start or end at its lines; so the intervals of
these shortest runs reveal all maximal repeated runs, however long, and
doubling ends at ``min_words`` lines.  In each interval the first run (by key,
then place) stays and the lines of the others are deleted.

Defined results: null and empty texts stay as they are; overlapping copies
within one text count; rows that repeat a key and text are one document, and
of the further ones all is deleted if they have ``min_words`` words; null keys
come last; an empty table gives an empty result; extra columns stay.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusflow.llm.common import BYTE_MIX_2, blocks, content_key, numbered, partitions, read_table, row_id, small_batches, span_hashes, spans, stored
from corpusflow.llm.registry import query
from corpusflow.operators.sizing import broadcast_if_small

MIN_WORDS = 50
MAX_BROADCAST_TEXTS = 200_000
DELETED = "n_deleted_lines"

_INK = np.ones(256, bool)
_INK[[9, 10, 11, 12, 13, 32]] = False
_LINE_TYPE = pa.struct([("a", pa.int64()), ("b", pa.int64()), ("place", pa.int32()), ("forth", pa.int32()), ("back", pa.int32())])
LINES = "lines array<struct<a:long,b:long,place:int,forth:int,back:int>>, n_words long"


def text_lines(data: np.ndarray, off: np.ndarray, min_words: int):
    """Of each line with ink: two hashes, its place among all lines of the text, and the
    number of lines, itself included, that make ``min_words`` words forth and back (0: the
    text has fewer); the first line per text; and the texts' words."""
    starts, ends = spans(_INK[data], off)
    breaks = np.concatenate([[0], np.cumsum(data == 10)])
    line = breaks[starts]
    first_word = np.searchsorted(starts, off)
    text = np.repeat(np.arange(len(off) - 1), np.diff(first_word))
    new = np.ones(len(starts), bool)
    new[1:] = (line[1:] != line[:-1]) | (text[1:] != text[:-1])
    head = np.flatnonzero(new)
    tail = np.append(head[1:], len(starts)) - 1 if len(head) else head
    a = span_hashes(data, starts[head], ends[tail]).view(np.int64)
    b = span_hashes(data, starts[head], ends[tail], BYTE_MIX_2).view(np.int64)
    place = line[head] - breaks[off[:-1]][text[head]]
    first = np.searchsorted(head, first_word)
    upto = np.concatenate([head, [len(starts)]])  # words before each line
    own = text[head]
    end, begin = first[own + 1] if len(own) else own, first[own] if len(own) else own
    at = np.arange(len(head))
    z = np.searchsorted(upto, upto[at] + min_words, "left")
    forth = np.where(z <= end, z - at, 0)
    y = np.searchsorted(upto, upto[at + 1] - min_words, "right") - 1
    back = np.where((upto[at + 1] >= min_words) & (y >= begin), at - y + 1, 0)
    return a, b, place, forth, back, first, np.diff(first_word)


def _lines(min_words: int):
    def run(batches):
        for b in batches:
            parts, bounds, n_words = [], [np.zeros(1, np.int64)], []
            for _, _, data, off in blocks(b.column(1)):
                *columns, first, words = text_lines(data, off, min_words)
                parts.append(columns)
                bounds.append(first[1:] + bounds[-1][-1])
                n_words.append(words)
            cols = [np.concatenate([p[i] for p in parts]) if parts else np.zeros(0, np.int64) for i in range(5)]
            arrays = [pa.array(c.astype(np.int64 if i < 2 else np.int32)) for i, c in enumerate(cols)]
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate(bounds).astype(np.int32)), pa.StructArray.from_arrays(arrays, fields=list(_LINE_TYPE)))
            words = np.concatenate(n_words).astype(np.int64) if n_words else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), lists, pa.array(words)], names=["e", "lines", "n_words"])
    return run


def _first_places(groups: DataFrame, order: list[str], bucket, name: str) -> DataFrame:
    """Groups (with their sizes ``n``) and ``r``: the number of members of smaller groups.
    ``bucket`` rises with ``order``; a window orders one bucket, and the buckets' totals
    (a few per partition) are summed up before."""
    groups = stored(groups.withColumn("bucket", bucket), name)
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    totals = groups.groupBy("bucket").agg(F.sum("n").alias("t")).select("bucket", F.coalesce(F.sum("t").over(before), F.lit(0)).alias("start"))
    inside = Window.partitionBy("bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    ranked = groups.withColumn("within", F.coalesce(F.sum("n").over(inside), F.lit(0)))
    return ranked.join(F.broadcast(totals), "bucket").withColumn("r", F.col("start") + F.col("within")).drop("bucket", "within", "start")


def doubled_ranks(lines: DataFrame, rounds: int) -> list[DataFrame]:
    """Per k the repeated places (id, at, r) with the ranks of their 2^k-blocks;
    from lines (id, at, a, b)."""
    n_buckets = 4 * partitions(lines.sparkSession)
    symbols = lines.groupBy("a", "b").agg(F.count("*").alias("n")).filter("n > 1")
    by_hash = F.floor((F.col("a") / F.lit(2.0 ** 64) + 0.5) * n_buckets).cast("long")
    symbols = stored(_first_places(symbols, ["a", "b"], by_hash, "symbols"), "ranked-symbols")
    now = stored(lines.join(symbols, ["a", "b"]).select("id", "at", "r", F.col("n").alias("size")), "ranks-0")
    levels = [now.select("id", "at", "r")]
    for k in range(rounds):
        n = now.count()
        if not n:
            break
        ahead = now.select("id", (F.col("at") - (1 << k)).alias("at"), F.col("r").alias("r2"))
        pairs = stored(now.join(ahead, ["id", "at"]), f"pairs-{k}")
        groups = pairs.groupBy("r", "r2").agg(F.count("*").alias("n"), F.first("size").alias("size")).filter("n > 1")
        # about where the pair stands among the places: rises with (r, r2), and spreads a hot rank
        about = F.col("r") + F.floor(F.col("size") * F.col("r2") / F.lit(float(n + 1)))
        groups = groups.select(F.col("r").alias("r1"), "r2", "n", about.alias("about"))
        ranked = stored(_first_places(groups, ["r1", "r2"], F.floor(F.col("about") / F.lit(max(1, n // n_buckets))), f"groups-{k}"), f"ranked-{k}")
        now = stored(pairs.withColumnRenamed("r", "r1").drop("size").join(ranked, ["r1", "r2"]).select("id", "at", "r", F.col("n").alias("size")), f"ranks-{k + 1}")
        levels.append(now.select("id", "at", "r"))
    return levels


def _keep(batches):
    """Per text: the parts of its lines that stay, from the deleted runs."""
    for b in batches:
        parts, counts = [], []
        for lines, runs in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
            last = -1
            gone = set()
            for s, e in sorted((r["s"], r["e"]) for r in runs):
                for j in range(max(s, last), e):
                    gone.add(lines[j])
                last = max(last, e)
            spans_, at = [], 0
            for p in sorted(gone):
                if p > at:
                    spans_.append({"start": at + 1, "size": p - at})
                at = p + 1
            spans_.append({"start": at + 1, "size": 1 << 30})
            parts.append(spans_)
            counts.append(len(gone))
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(parts, pa.list_(pa.struct([("start", pa.int32()), ("size", pa.int32())]))), pa.array(counts, pa.int64())], names=["content", "parts", "n_deleted"])


def repeated_runs(docs: DataFrame, *, key: str, text: str, min_words: int = MIN_WORDS) -> tuple[DataFrame, DataFrame]:
    """(texts, deleted): one narrow row per document with its number of lines and words;
    and per document that loses lines its content key and the parts that stay."""
    spark = docs.sparkSession
    small_batches(spark)
    given = docs.select(F.struct(F.col(key).cast("long").alias("key"), content_key(key, text).alias("content")).alias("e"), F.col(text).cast("string").alias("t"))
    rows = stored(given.mapInArrow(_lines(min_words), f"e {given.schema['e'].dataType.simpleString()}, {LINES}").select("e.*", "lines", "n_words", row_id().alias("id")), "text-lines")
    order = F.struct(F.col("key").isNull().alias("no_key"), "key", "id")
    # rows that repeat a key and a text are one document
    twins = stored(rows.groupBy("content").agg(F.min("id").alias("id"), F.count("*").alias("n_rows")).filter("n_rows > 1"), "twins")
    extra = rows.select("id", "content").join(broadcast_if_small(twins.select("content", F.col("id").alias("first")), MAX_BROADCAST_TEXTS), "content").filter("id <> first").select("id")
    one = rows.filter("n_words >= 1").join(broadcast_if_small(stored(extra, "twin-rows"), MAX_BROADCAST_TEXTS), "id", "left_anti") if not twins.isEmpty() else rows
    lines = stored(one.select(order.alias("o"), "id", F.posexplode("lines").alias("at", "line")).select("o", "id", "at", "line.*"), "lines")
    levels = doubled_ranks(lines.select("id", "at", "a", "b"), max(0, min_words.bit_length() - 1))
    ranks = levels[0].withColumn("k", F.lit(0))
    for k, level in enumerate(levels[1:], 1):
        ranks = ranks.unionByName(level.withColumn("k", F.lit(k)))
    # the shortest runs with enough words that start or end at a line
    forth = lines.filter("forth > 0").select("o", "id", "at", F.col("forth").alias("m"))
    back = lines.filter("back > 0").select("o", "id", (F.col("at") - F.col("back") + 1).alias("at"), F.col("back").alias("m"))
    k = F.floor(F.log2(F.col("m") + F.lit(0.5))).cast("int")
    runs = forth.unionByName(back).distinct().withColumn("k", k).withColumn("other", F.col("at") + F.col("m") - F.expr("shiftleft(1, k)"))
    runs = runs.join(ranks.select("k", "id", "at", F.col("r").alias("x")), ["k", "id", "at"])
    runs = runs.join(ranks.select("k", "id", F.col("at").alias("other"), F.col("r").alias("y")), ["k", "id", "other"])
    runs = stored(runs.select("o", "id", "at", "m", "x", "y"), "runs")
    place = F.struct("o", "at")
    first = stored(runs.groupBy("m", "x", "y").agg(F.min(place).alias("first"), F.count("*").alias("n")).filter("n > 1").select("m", "x", "y", "first"), "intervals")
    later = runs.join(first, ["m", "x", "y"]).filter(place != F.col("first")).select("id", F.col("at").alias("s"), (F.col("at") + F.col("m")).alias("e"))
    per = later.groupBy("id").agg(F.collect_set(F.struct("s", "e")).alias("runs"))  # at most two a line
    marked = rows.select("id", "content", F.col("lines.place").alias("lines")).join(per, "id")
    deleted = stored(marked.select("content", "lines", "runs").mapInArrow(_keep, "content struct<a:long,b:long>, parts array<struct<start:int,size:int>>, n_deleted long"), "deleted")
    texts = rows.select(F.col("key"), "content", F.size("lines").cast("long").alias("n_lines"), "n_words", "id")
    return texts, deleted


def dedup_lines(docs: DataFrame, *, key: str, text: str, min_words: int = MIN_WORDS, drop_empty: bool = False, deleted_lines: str = DELETED) -> DataFrame:
    """``docs`` without the later copies of repeated line runs, and their number ``deleted_lines``
    (which takes the place of a column of that name); with ``drop_empty`` texts of which nothing is left go."""
    texts, deleted = repeated_runs(docs, key=key, text=text, min_words=min_words)
    rows, own = numbered(docs)
    keyed = rows.withColumn("content", content_key(own[key], own[text]))
    few = broadcast_if_small(deleted.select(F.col("content.a").alias("a"), F.col("content.b").alias("b"), "parts", "n_deleted"), MAX_BROADCAST_TEXTS)
    out = keyed.join(few, (F.col("content.a") == F.col("a")) & (F.col("content.b") == F.col("b")), "left").drop("a", "b")
    whole = F.col(own[text])
    lines = F.split(whole.cast("string"), "\n", -1)
    left = F.array_join(F.flatten(F.transform("parts", lambda p: F.slice(lines, p["start"], p["size"]))), "\n")
    out = out.withColumns({own[text]: F.when(F.col("parts").isNull(), whole).otherwise(left), "n_deleted": F.coalesce("n_deleted", F.lit(0)).cast("long")}).drop("parts")
    twins = texts.groupBy("content", "n_words", "n_lines").agg(F.count("*").alias("n_rows")).filter("n_rows > 1")
    twins = stored(twins.filter(F.col("n_words") >= min_words).select(F.col("content.a").alias("a"), F.col("content.b").alias("b"), "n_lines"), "twin-texts")
    if not twins.isEmpty():  # of rows that repeat a key and a text one stays: the first, as they are stored
        is_twin = (F.col("content.a") == F.col("a")) & (F.col("content.b") == F.col("b"))
        side = broadcast_if_small(twins, MAX_BROADCAST_TEXTS)
        several = stored(out.join(side, is_twin), "twin-copies").withColumn("rid", row_id())
        first = stored(several.groupBy("a", "b").agg(F.min("rid").alias("rid")).select("rid", F.lit(True).alias("stays")), "twin-firsts")
        several = several.join(broadcast_if_small(first, MAX_BROADCAST_TEXTS), "rid", "left")
        several = several.withColumns({own[text]: F.when(F.col("stays"), F.col(own[text])).otherwise(""), "n_deleted": F.when(F.col("stays"), F.col("n_deleted")).otherwise(F.col("n_lines"))})
        out = out.join(side, is_twin, "left_anti").unionByName(several.select(*out.columns))
    if drop_empty:
        out = out.filter((F.col("n_deleted") == 0) | (F.trim(F.translate(own[text], "\t\r\n\x0b\x0c", "     ")) != ""))
    names = [c for c in docs.columns if c != deleted_lines]
    return out.select(*(own[c] for c in names), "n_deleted").toDF(*names, deleted_lines)


@query("op3_line_dedup")
def op3_line_dedup(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_lines(docs, key="doc_id", text="text")
