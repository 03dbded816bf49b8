"""Fill-in-the-middle against a plain model, with its edge cases."""

import hashlib
import re

import pytest

from corpusflow.llm import fim

SCHEMA = "doc_id long, text string, n long, form string, a long, h string, output string, prefix_chars long"
TEXTS = [None, "", "a", " ", "ab c", "no newline\nand\ttabs  é\U0001f916x", "$1 \\2 (a){3}+ \\Q[", "holds <P> itself", "<S>", "almost <P <S and >",
         "<", "ends with <S", "x" * 5000, "word 12 " * 60_000, "\U0001f916" * 70_000, "one two\r\nthree", "\x00nul\x00"]


def model(key, text):
    text = text or ""
    tokens = re.findall("[A-Za-z]+|[^A-Za-z]", text)
    d = hashlib.sha256(("1:" + ("" if key is None else str(key))).encode()).hexdigest()
    h = [int(d[8 * i:8 * i + 8], 16) for i in range(4)]
    n = len(tokens)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if text == "" or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return key, n, "plain", None, None, text
    p, m, s = "".join(tokens[:a]), "".join(tokens[a:b]), "".join(tokens[b:])
    if h[3] % 100 < 20:
        return key, n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return key, n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@pytest.fixture(scope="module")
def rows():
    got = [(k, t) for k, t in enumerate(TEXTS)] + [(None, "null key of a row"), (10**12, "big key"), (4, "ab c"), (4, "ab c")]
    return got + [(100 + i, f"ab c, {i} d\n") for i in range(200)]


def test_against_model(spark, rows):
    # extra columns named like every column inside
    docs = spark.createDataFrame([(k, t, 1, "x", 2, "y", "z", 3) for k, t in rows], SCHEMA)
    out = fim.fill_in_middle(docs, key="doc_id", text="text")
    assert out.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]
    got = out.withColumn("restored", fim.restored()).collect()
    order = [lambda r: (r[0] is None, r[0] or 0, r[5])] * 2
    assert sorted((tuple(r)[:6] for r in got), key=order[0]) == sorted((model(k, t) for k, t in rows), key=order[1])
    assert sorted((r.doc_id or -1, r.restored) for r in got) == sorted((k or -1, t or "") for k, t in rows)
    assert {r.form for r in got} == {"plain", "psm", "spm"}


def test_empty_table_and_own_markers(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert fim.fill_in_middle(docs, key="doc_id", text="text").count() == 0
    one = spark.createDataFrame([(i, "a <P> b c") for i in range(30)], "k int, t string")
    out = fim.fill_in_middle(one, key="k", text="t", markers=("<|pre|>", "<|suf|>", "<|mid|>"), plain_share=0)
    got = out.select("form", fim.restored(("<|pre|>", "<|suf|>", "<|mid|>")).alias("r")).collect()
    assert {r.r for r in got} == {"a <P> b c"} and {r.form for r in got} == {"psm", "spm"}
    with pytest.raises(ValueError):
        fim.fill_in_middle(one, key="k", text="t", markers=("P", "PS", "M"))


def test_one_match_without_python(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    plan = fim.fill_in_middle(docs, key="doc_id", text="text")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan
