import random

from pyspark.sql import functions as F

from corpusflow.functions.text import pieces, stripped_length
from corpusflow.operators.filters import corpus_filters

WS = ["\t", "\n", "\x0b", "\x0c", "\r", "\x1c", "\x1f", " ", "\x85", "\xa0", " ",
      " ", " ", " ", " ", " ", " ", "　"]


def _cases():
    base = ["", "   ", "a", "x" * 49, "x" * 50, "ab cd", "\xa0" + "y" * 49 + "　",
            "　" + "y" * 50 + "\xa0", " \x1c" + "z" * 9 + " ", "z" * 10, "​" + "q" * 49]
    rng = random.Random(1)
    for _ in range(60):
        s = "".join(rng.choice(WS + list("abcé日")) for _ in range(rng.randint(0, 30)))
        base.append(s)
    return base


def test_strip_matches_python(spark):
    cases = _cases()
    df = spark.createDataFrame([(i, s) for i, s in enumerate(cases)], "i INT, t STRING")
    got = {r["i"]: r["n"] for r in df.select("i", stripped_length(F.col("t")).alias("n")).collect()}
    for i, s in enumerate(cases):
        assert got[i] == len(s.strip()), repr(s)


def test_pieces_match_python_split(spark):
    cases = _cases()
    df = spark.createDataFrame([(i, s) for i, s in enumerate(cases)], "i INT, t STRING")
    got = {r["i"]: r["p"] for r in df.select("i", pieces(F.col("t")).alias("p")).collect()}
    for i, s in enumerate(cases):
        assert got[i] == s.split(), repr(s)


def test_filters_null_empty_padding(spark):
    rows = [(1, None), (2, ""), (3, " " * 60), (4, "\xa0" + "w" * 49 + "　"),
            (5, "\xa0" + "w" * 50 + "　"), (6, "v" * 50)]
    df = spark.createDataFrame(rows, "doc_id INT, text STRING").withColumn("lang", F.lit("de"))
    kept = sorted(r["doc_id"] for r in corpus_filters(df, 50, "de").collect())
    assert kept == [5, 6]
    assert corpus_filters(df, 50, "en").count() == 0


def test_byte_level_pieces_match_python_regex(spark):
    import regex
    from corpusflow.functions.text import BYTE_LEVEL_PATTERN
    import __spark_entry__ as E
    from tests.conftest import SF_SMALL
    docs = {r["doc_id"]: r["text"] for r in
            spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()}
    extra = {-1: "it's 12 cafés 　 ok?  \n\tend", -2: "x'll  y"}
    df = spark.createDataFrame(list(extra.items()), "doc_id BIGINT, text STRING")
    got = {r["doc_id"]: r["p"] for r in df.select("doc_id", pieces(F.col("text"), BYTE_LEVEL_PATTERN).alias("p")).collect()}
    py = regex.compile(BYTE_LEVEL_PATTERN[4:])
    for k, t in extra.items():
        assert got[k] == py.findall(t) and "".join(got[k]) == t
    counts = {r["doc_id"]: r["n_tokens"] for r in E.queries()["pretoken_counts"](spark, SF_SMALL).collect()}
    assert counts == {k: len(py.findall(t)) for k, t in docs.items() if t}


def test_detector_minimum_length(spark):
    from corpusflow.operators.language import score_languages, train_profile
    train = spark.createDataFrame([("de", "der die das und ist nicht ein eine"), ("en", "the and is not a an of to")],
                                  "lang STRING, text STRING")
    prof = train_profile(train)
    docs = spark.createDataFrame([(1, "  " + "x" * 9 + " "), (2, "　" + "und ist da" + " "), (3, None)],
                                 "doc_id INT, text STRING")
    got = {r["doc_id"]: r["pred_lang"] for r in score_languages(docs, ["doc_id"], prof).collect()}
    assert got[1] is None and got[3] is None   # under 10 stripped characters / no text
    assert got[2] == "de"


def test_utf8_bucket_monotone_and_vocab_ties(spark):
    from corpusflow.operators.tokens import build_vocab, utf8_prefix_bucket
    words = ["a", "ab", "abc", "abd", "b", "é", "éa", "日本", "日", "z", "\x01", "aé", "ÿ"]
    df = spark.createDataFrame([(w,) for w in words], "w STRING")
    got = [(r["w"], r["b"]) for r in df.select("w", utf8_prefix_bucket(F.col("w")).alias("b")).collect()]
    by_bytes = sorted(got, key=lambda x: x[0].encode("utf-8"))
    assert [b for _, b in by_bytes] == sorted(b for _, b in by_bytes)
    text = "x x x y y q p o n m é é"   # x:3 y:2 é:2, then five pieces tied at 1
    v = build_vocab(spark.createDataFrame([(text,)], "text STRING"), vocab_size=6)
    assert [(r["piece"], r["id"]) for r in v.orderBy("id").collect()] == \
        [("x", 1), ("y", 2), ("é", 3), ("m", 4), ("n", 5)]


def test_hashed_id_functions(spark):
    from corpusflow.operators.tokens import encode_hashed
    df = spark.createDataFrame([(1, "a b  a c")], "doc_id INT, text STRING")
    for fn in ("md5", "xxhash64"):
        r = encode_hashed(df, vocab_size=11, id_fn=fn).collect()[0]
        assert r["n_tokens"] == 4 and r["tokens"][0] == r["tokens"][2] and all(0 <= t < 11 for t in r["tokens"])


def test_language_profile_held_out_accuracy(spark):
    from corpusflow.operators.filters import corpus_filters
    from corpusflow.operators.language import score_languages, train_profile
    from corpusflow.plans.corpus import documents_rows
    docs = corpus_filters(documents_rows(spark, "/root/testdata/sf0.01"), 50, None)
    train = docs.filter(F.pmod("doc_id", F.lit(2)) == 0)
    test = docs.filter(F.pmod("doc_id", F.lit(2)) == 1)
    scored = score_languages(test, ["doc_id"], train_profile(train), carry=["lang"])
    acc = scored.agg(F.avg((F.col("lang") == F.col("pred_lang")).cast("double"))).first()[0]
    assert acc >= 0.98


def _grams(text):
    return [f" {w} "[i:i + 3] for w in (text or "").split() for i in range(len(w))]


def test_gram_codes_match_padded_pieces(spark):
    from corpusflow.operators.language import gram_code, gram_codes, gram_text
    texts = _cases() + ["\U0001f916é \u2003x", "", "tail "]
    codes, owner = gram_codes(texts)
    got = [[] for _ in texts]
    for c, i in zip(codes.tolist(), owner.tolist()):
        got[i].append(gram_text(c))
    assert got == [_grams(t) for t in texts]
    some = sorted({(gram_text(c), c) for c in codes.tolist()})
    df = spark.createDataFrame(some, "g STRING, c BIGINT")
    assert df.filter(gram_code(F.col("g")) != F.col("c")).count() == 0


def test_scores_match_formula_and_nothing_is_exploded(spark):
    import math
    from collections import Counter
    from corpusflow.operators.language import score_languages, train_profile
    train = [("de", "der hund und die katze"), ("en", "the dog and the cat"), ("en", "a cat"), (None, "zzz"), ("de", None)]
    docs = [(1, "der die das katze", 7), (2, "the cat  and\nthe", 7), (3, "kurz", 7), (4, None, 7), (5, "qqq www xxx yyy", None), (None, "und die katzen hier", 1)]
    prof = train_profile(spark.createDataFrame(train, "lang STRING, text STRING"))
    counts = {"de": Counter(), "en": Counter()}
    for lang, text in train:
        if lang:
            counts[lang].update(_grams(text))
    assert {(r["lang"], r["gram"]): r["cnt"] for r in prof.collect()} == {(x, g): n for x, c in counts.items() for g, n in c.items()}
    v = len(set(counts["de"]) | set(counts["en"]))
    df = spark.createDataFrame(docs, "k INT, text STRING, other INT")
    for max_bytes in (1 << 20, 24 * 7):  # the second: grams share seven slots
        out = score_languages(df, ["k"], prof, carry=["other"], max_bytes=max_bytes)
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "Generate" not in plan and "Exchange" not in plan
        got = {r["k"]: r for r in out.collect()}
        assert got[3]["pred_lang"] is None and got[4]["pred_lang"] is None and got[3]["score_de"] is None
        assert len(got) == 6 and got[1]["other"] == 7
        if max_bytes > 1000:
            assert (got[1]["pred_lang"], got[2]["pred_lang"], got[None]["pred_lang"]) == ("de", "en", "de")
            for k, text, _ in docs:
                for lang, c in counts.items():
                    grams = _grams(text)
                    want = sum(math.log(c[g] + 1) for g in grams) - len(grams) * math.log(c.total() + v)
                    if got[k]["pred_lang"]:
                        assert abs(got[k][f"score_{lang}"] - want) < 1e-9


def test_empty_profile_and_empty_rows(spark):
    from corpusflow.operators.language import score_languages, train_profile
    none = train_profile(spark.createDataFrame([], "lang STRING, text STRING"))
    df = spark.createDataFrame([(1, "some text here")], "k INT, text STRING")
    assert [r["pred_lang"] for r in score_languages(df, ["k"], none).collect()] == [None]
    prof = train_profile(spark.createDataFrame([("de", "ein text")], "lang STRING, text STRING"))
    assert score_languages(df.filter("k > 1"), ["k"], prof).count() == 0
