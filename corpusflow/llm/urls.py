"""URL filter: rules first, else words of host and path scored by naive Bayes.

Host names run words together.  A unigram model (word counts of the pages' own
text, of the paths and of hyphenated host labels) splits every letter run of a
host by Viterbi: the words of least total cost, where a word of the model
costs -log of its share and an unknown string ten times more for each
letter.  The model is a table, not a broadcast: every distinct run's substrings
are joined with it, so a corpus of any vocabulary uses all of it.

A multinomial naive Bayes model over host words and path tokens then tells pages
to block from others.  Its examples are the pages themselves: one with a word of
``seeds`` is an example to block, every other one to allow.  Tokens count in
``BUCKETS`` hash buckets, which bounds the model; a smoothed log ratio per
bucket is summed over a page's tokens, and a positive sum blocks.

Hosts and runs are split once, however many pages share them, and join back by
``spread_join``.

Defined results: the host lies between the first ``://`` and the next ``/``,
``?``, ``#`` or the end, with A-Z lower-cased; the path reaches from there to ``?``, ``#`` or
the end; both are empty for a null url or one without ``://``.  A rule fits its host
and all below it if the path starts with its own, which begins with the slash (so
an empty path has no rule); the longest wins, at equal lengths that of the longer host.
Digit runs are one token each.  Where no page, or every page, holds a seed, that one
class is every page's verdict; ties allow.  Repeated rows stay and count; null
keys stay; empty tables give an empty result; extra columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusflow.llm.common import read_table, spread_join, stored
from corpusflow.llm.registry import query

RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
#: Words that mark an example to block.
SEEDS = ("adult", "ads", "bet", "bets", "casino", "escort", "gambling", "hentai", "jackpot", "lottery", "nude", "pills", "poker", "porn", "sex", "slots",
         "spam", "torrent", "viagra", "warez", "xxx")
LONGEST = 24        # letters of a word
BUCKETS = 1 << 18
PIECE = r"[a-z]+|[0-9]+|[^\x00-\x7f]+"
NUMBER = "0"


def host_path(url: Column) -> tuple[Column, Column]:
    host = F.regexp_extract(url, r"(?s)://([^/?#]*)", 1)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return (F.coalesce(F.translate(host, upper, upper.lower()), F.lit("")), F.coalesce(F.regexp_extract(url, r"(?s)://[^/?#]*([^?#]*)", 1), F.lit("")))


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; nulls if there is none."""
    rule = verdict = F.lit(None).cast("string")
    for word, r in sorted(rules, key=lambda x: (len(x[1]), x[1].index("/"))):
        name, start = r.split("/", 1)
        fits = ((host == name) | host.endswith("." + name)) & path.startswith("/" + start)
        rule, verdict = F.when(fits, r).otherwise(rule), F.when(fits, word).otherwise(verdict)
    return rule, verdict


def _pieces(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(PIECE), 0)


def _tokens(text: Column) -> Column:
    return F.transform(_pieces(text), lambda x: F.when(x.rlike("^[0-9]"), F.lit(NUMBER)).otherwise(x))


def word_counts(texts: DataFrame, paths: DataFrame, hosts: DataFrame) -> DataFrame:
    """(word, n) over visible ``text``, ``path`` tokens, and hyphenated labels of ``host`` (n rows each)."""
    plain = F.lower(F.regexp_replace(F.col("text"), r"(?s)<[^>]*>", " "))
    whole = rf"(?<!\p{{L}})[a-z]{{1,{LONGEST}}}(?!\p{{L}})"
    seen = texts.select(F.explode(F.regexp_extract_all(plain, F.lit(whole), 0)).alias("word"), F.lit(1).cast("long").alias("n"))
    seen = seen.unionByName(paths.select(F.explode(_pieces(F.col("path"))).alias("word"), F.lit(1).cast("long").alias("n")))
    joined = F.flatten(F.transform(F.filter(F.split("host", r"\."), lambda x: x.contains("-")), _pieces))
    seen = seen.unionByName(hosts.select(F.explode(joined).alias("word"), "n"))
    return seen.filter(F.col("word").rlike(rf"^[a-z]{{1,{LONGEST}}}$")).groupBy("word").agg(F.sum("n").alias("n"))


def split_words(run: str, known: dict[tuple[int, int], float], total: float) -> list[str]:
    """The words of least cost; ``known`` holds the counts of substrings (start, length).
    Of equal costs the one with the longest last word wins."""
    n = len(run)
    cost, back = [0.0] + [math.inf] * n, [0] * (n + 1)
    unknown = math.log(max(total, 1.0))
    for end in range(1, n + 1):
        for start in range(max(0, end - LONGEST), end):
            size = end - start
            count = known.get((start, size))
            c = cost[start] + (unknown - math.log(count) if count else unknown + size * math.log(10))
            if c < cost[end]:
                cost[end], back[end] = c, start
    out, at = [], n
    while at:
        out.append(run[back[at]:at])
        at = back[at]
    return out[::-1]


def _split(total: float):
    def go(batches):
        for b in batches:
            runs, found = b.column(0).to_pylist(), b.column(1).to_pylist()
            words = [split_words(r, {(m["at"] - 1, m["size"]): m["n"] for m in f}, total) for r, f in zip(runs, found, strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(words, pa.list_(pa.string()))], names=["piece", "words"])
    return go


def segment(runs: DataFrame, words: DataFrame) -> DataFrame:
    """(piece, words) of distinct letter runs ``piece``, by the counts of ``words`` (word, n)."""
    total = float(words.agg(F.sum("n")).first()[0] or 0)
    size = F.length("piece")
    places = F.flatten(F.transform(F.sequence(F.lit(1), size), lambda i: F.transform(F.sequence(F.lit(1), F.least(F.lit(LONGEST), size - i + 1)), lambda k: F.struct(i.alias("at"), k.alias("size")))))
    parts = runs.select("piece", F.explode(places).alias("m")).select("piece", "m.at", "m.size", F.col("piece").substr(F.col("m.at"), F.col("m.size")).alias("word"))
    found = spread_join(stored(parts, "substrings"), words, "word")
    known = found.groupBy("piece").agg(F.collect_list(F.when(F.col("n").isNotNull(), F.struct("at", "size", "n"))).alias("known"))
    return known.mapInArrow(_split(total), "piece string, words array<string>")


def host_words(hosts: DataFrame, words: DataFrame) -> DataFrame:
    """(host, host_tokens) of distinct hosts."""
    pieces = stored(hosts.select("host", F.posexplode(_pieces(F.col("host"))).alias("pos", "piece")), "host-pieces")
    letters = pieces.filter(F.col("piece").rlike("^[a-z]")).select("piece").distinct()
    split = stored(segment(letters, words), "segments")
    own = F.array(F.when(F.col("piece").rlike("^[0-9]"), F.lit(NUMBER)).otherwise(F.col("piece")))
    got = spread_join(pieces, split, "piece").select("host", F.struct("pos", F.coalesce("words", own).alias("words")).alias("w"))
    return got.groupBy("host").agg(F.flatten(F.transform(F.array_sort(F.collect_list("w")), lambda x: x["words"])).alias("host_tokens"))


def _weights(rows: DataFrame) -> tuple[np.ndarray | None, float]:
    """Log ratio per bucket and of the classes, from (block, buckets); None if there is one class."""
    classes = {r.block: r["count"] for r in rows.groupBy("block").count().collect()}
    if len(classes) < 2:
        return None, 1.0 if classes.get(True) else -1.0
    one = F.when(F.col("block"), 1).otherwise(0)
    counts = rows.select(one.alias("block"), F.explode("buckets").alias("bucket")).groupBy("bucket").agg(F.sum("block").alias("bad"), F.count(F.lit(1)).alias("n"))
    got = counts.toArrow()  # at most BUCKETS rows
    at, bad, n = (got[c].to_numpy().astype(float) for c in ("bucket", "bad", "n"))
    out = np.zeros(BUCKETS)
    out[at.astype(int)] = np.log((bad + 1) / (bad.sum() + len(at))) - np.log((n - bad + 1) / ((n - bad).sum() + len(at)))
    return out, math.log(classes[True] / classes[False])


def _score(weights: np.ndarray | None, prior: float):
    def run(batches):
        for b in batches:
            lists = b.column(b.schema.get_field_index("buckets"))
            sizes = np.asarray(pa.compute.list_value_length(lists))
            ends = np.cumsum(sizes)
            sums = np.concatenate([[0.0], np.cumsum(weights[np.asarray(lists.flatten())])]) if weights is not None else np.zeros(ends[-1] + 1 if len(ends) else 1)
            score = np.round(prior + sums[ends] - sums[ends - sizes], 6)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(score)], names=[*b.schema.names, "score"])
    return run


def judge(pages: DataFrame, *, key: str, url: str, text: str, rules=RULES, seeds: tuple[str, ...] = SEEDS) -> DataFrame:
    """Per row: key, host, path, rule, verdict, score (of the method, positive: block), tokens."""
    host, path = host_path(F.col(url).cast("string"))
    rows = pages.select(F.col(key).alias("key"), host.alias("host"), path.alias("path"), F.col(text).cast("string").alias("text"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    urls = stored(rows.select("key", "host", "path", rule.alias("rule"), verdict.alias("ruled")), "urls")
    hosts = stored(urls.groupBy("host").agg(F.count(F.lit(1)).alias("n")), "hosts")
    words = stored(word_counts(rows.select("text"), urls.select("path"), hosts), "words")
    split = stored(host_words(hosts, words), "host-words")
    tokens = F.concat(F.coalesce("host_tokens", F.array().cast("array<string>")), _tokens(F.col("path")))
    got = spread_join(urls, split, "host").select("key", "host", "path", "rule", "ruled", tokens.alias("tokens"))
    got = stored(got.withColumns({"block": F.arrays_overlap("tokens", F.array(*map(F.lit, seeds))),
                                  "buckets": F.transform("tokens", lambda t: F.pmod(F.xxhash64(t), F.lit(BUCKETS)).cast("int"))}), "url-tokens")
    weights, prior = _weights(got)
    scored = got.mapInArrow(_score(weights, prior), f"{', '.join(f'{f.name} {f.dataType.simpleString()}' for f in got.schema.fields)}, score double")
    return scored.select(F.col("key").alias(key), "host", "path", "rule", F.coalesce("ruled", F.when(F.col("score") > 0, "block").otherwise("allow")).alias("verdict"), "score", "tokens")


@query("op12_url_words")
def op12_url_words(spark, sf_dir):
    found = judge(read_table(spark, sf_dir, "pages"), key="page_id", url="url", text="html")
    return found.select("page_id", "host", "path", "rule", "verdict", "score", F.array_join("tokens", " ").alias("words"))
