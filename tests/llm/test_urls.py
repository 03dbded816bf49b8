"""URL filter against a plain model: parsing, rules, segmentation, scores."""

import itertools
import math
import re
from collections import Counter

import pytest

from corpusflow.llm import urls
from corpusflow.llm.common import spread_join

SCHEMA = "page_id long, url string, html string, host string, path string, n long, word string, key string, piece string, block boolean"


def parse(url):
    at = (url or "").find("://")
    if at < 0:
        return "", ""
    rest = url[at + 3:]
    end = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
    path = rest[end:]
    path = path[:min((path.find(c) for c in "?#" if c in path), default=len(path))]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end]), path


def rule(host, path):
    best = (0, 0, None, None)
    for verdict, r in urls.RULES:
        name, start = r.split("/", 1)
        if (host == name or host.endswith("." + name)) and path.startswith("/" + start):
            best = max(best, (len(r), len(name), r, verdict))
    return best[2:]


def pieces(text):
    return re.findall(urls.PIECE, text.lower())


def best_split(run, counts, total):
    """All splits of a short run, tried."""
    def cost(w):
        return math.log(total) - math.log(counts[w]) if counts.get(w) else math.log(total) + len(w) * math.log(10)
    found = []
    for cut in itertools.product((False, True), repeat=len(run) - 1):
        words, at = [], 0
        for i, c in enumerate([*cut, True], 1):
            if c:
                words.append(run[at:i])
                at = i
        found.append((round(sum(map(cost, words)), 9), words))
    low = min(c for c, _ in found)
    return [w for c, w in found if c < low + 1e-6]


def model(rows):
    parsed = [parse(u) for _, u, _ in rows]
    counts = Counter()
    for (_, _, html), (host, path) in zip(rows, parsed, strict=True):
        text = re.sub(r"(?s)<[^>]*>", " ", html or "").lower()
        counts.update(w for w in re.findall(r"[^\W\d_]+", text) if re.fullmatch("[a-z]{1,24}", w))
        counts.update(w for w in pieces(path) if re.fullmatch("[a-z]{1,24}", w))
        counts.update(w for label in host.split(".") if "-" in label for w in pieces(label) if re.fullmatch("[a-z]{1,24}", w))
    return parsed, counts


@pytest.fixture(scope="module")
def rows():
    words = ["<p>free bets and casino win cheap</p> pills", "the news of the day", "weather news", "good day shop", "über cheap täglich shop", None, ""]
    names = ["freebets.example.com", "www.dailynews.org", "cheap-pills.example.com", "cheappills.test.com", "NEWSDAY.Example.NET", "spam-farm.org", "shop24day.com", "täglich.de",
             "weather.co", "goodshop.example.com", "farmnews.com", "net", "x.net"]
    paths = ["/en/12", "/de/news/7.html", "/fr/9?x=1", "/shop#top", "", "/cheap/pills", "?q=://a/b", "/EN/3"]
    out = [(i, f"http://{n}{p}", words[i % len(words)]) for i, (n, p) in enumerate(itertools.product(names, paths))]
    out += [(None, None, None), (900, "no scheme", "<b>day"), (901, "", ""), (902, "://", "x"), (903, "a://b://c/d", ""), (904, "http://" + "longname" * 40 + ".com/x", "long name"), (1, out[1][1], out[1][2])]
    return out


def test_against_model(spark, rows):
    df = spark.createDataFrame([(*r, "h", "p", 1, "w", "k", "q", True) for r in rows], SCHEMA).repartition(5)
    out = urls.judge(df, key="page_id", url="url", text="html")
    assert out.columns == ["page_id", "host", "path", "rule", "verdict", "score", "tokens"]
    got = out.collect()
    parsed, counts = model(rows)
    total = sum(counts.values())
    assert len(got) == len(rows)
    by = {}
    for r in got:
        by.setdefault(r.page_id, []).append(r)
    splits = {}
    for (key, _, _), (host, path) in zip(rows, parsed, strict=True):
        r = by[key][0]
        assert (r.host, r.path) == (host, path)
        assert r.rule == rule(host, path)[0]
        left = list(r.tokens)
        for piece in pieces(host):
            if re.match("[a-z]", piece):
                n, words = 0, []
                while n < len(piece):
                    words.append(left.pop(0))
                    n += len(words[-1])
                assert "".join(words) == piece
                if len(piece) <= 12:
                    splits[piece] = words
            else:
                assert left.pop(0) == ("0" if piece[0].isdigit() else piece)
        assert left == ["0" if x[0].isdigit() else x for x in pieces(path)]
    for piece, words in splits.items():
        assert words in best_split(piece, counts, total), piece
    assert splits["freebets"] == ["free", "bets"] and splits["cheappills"] == ["cheap", "pills"] and splits["newsday"] == ["news", "day"]

    bad = [bool(set(r.tokens) & set(urls.SEEDS)) for r in got]
    seen = {y: Counter(t for r, b in zip(got, bad, strict=True) if b == y for t in r.tokens) for y in (False, True)}
    size = len(seen[False] | seen[True])
    for r in got:
        score = math.log(sum(bad) / (len(bad) - sum(bad)))
        score += sum(math.log((seen[True][t] + 1) / (seen[True].total() + size)) - math.log((seen[False][t] + 1) / (seen[False].total() + size)) for t in r.tokens)
        assert abs(score - r.score) < 1e-5
        assert r.verdict == (rule(r.host, r.path)[1] or ("block" if r.score > 0 else "allow"))
    farm = next(r for r in got if r.host == "farmnews.com")
    assert "farm" in farm.tokens and not set(farm.tokens) & set(urls.SEEDS)


def test_one_class_and_empty(spark):
    clean = spark.createDataFrame([(1, "http://news.com/a", "news")], "page_id long, url string, html string")
    assert [r.verdict for r in urls.judge(clean, key="page_id", url="url", text="html").collect()] == ["allow"]
    bad = spark.createDataFrame([(1, "http://spam.com/a", "spam")], "page_id long, url string, html string")
    assert [r.verdict for r in urls.judge(bad, key="page_id", url="url", text="html").collect()] == ["block"]
    none = spark.createDataFrame([], "page_id long, url string, html string")
    assert urls.judge(none, key="page_id", url="url", text="html").count() == 0


def test_spread_join_with_frequent_and_null_keys(spark):
    rows = spark.createDataFrame([(i, "hot" if i % 3 == 0 else None if i % 3 == 1 else f"k{i}") for i in range(3000)], "i int, k string")
    table = spark.createDataFrame([("hot", 1), (None, 2), *((f"k{i}", i) for i in range(0, 3000, 2))], "k string, v int")
    got = {r.i: r.v for r in spread_join(rows, table, "k").collect()}
    assert len(got) == 3000
    assert all(got[i] == (1 if i % 3 == 0 else 2 if i % 3 == 1 else i if i % 2 == 0 else None) for i in range(3000))
    assert spread_join(rows.filter("i < 0"), table, "k").count() == 0
