"""A profile above the bound of one table gives the same scores as one within it."""

import random

from corpusflow.operators import language


def _rows():
    rng = random.Random(3)
    words = {"de": ["straße", "über", "und", "der", "haus"], "en": ["the", "house", "and", "over"], "zh": ["一二三", "四五六七", "\U0001f916é"]}
    train = [(lang, " ".join(rng.choices(w, k=8)) + f" {rng.random()}") for lang, w in words.items() for _ in range(30)]
    texts = [" ".join(rng.choices(sum(words.values(), []), k=rng.randint(1, 60))) for _ in range(80)]
    return train, [*enumerate(texts), (900, None), (901, ""), (902, "kurz"), (903, "\u0416\u0416\u0416 \u0429\u0429\u0429 \u042f\u042f\u042f\u042f\u042f"), (None, "und der über"), (0, texts[0])]


def test_scores_do_not_depend_on_the_size_of_the_profile(spark, monkeypatch):
    train, docs = _rows()
    profile = language.train_profile(spark.createDataFrame(train, "lang STRING, text STRING"))
    df = spark.createDataFrame(docs, "k INT, text STRING").repartition(3)
    monkeypatch.setattr(language, "LOOKUP_CHARS", 300)  # many blocks
    small, large = (sorted(map(tuple, language.score_languages(df, ["k"], profile, max_bytes=n).collect()), key=repr) for n in (1 << 20, 100))
    assert len(small) == len(docs) and small == large
    assert {r[-1] for r in small} >= {"de", "en", None}


def test_blocks_without_a_known_gram(spark):
    profile = language.train_profile(spark.createDataFrame([("de", "ein text hier")], "lang STRING, text STRING"))
    df = spark.createDataFrame([(1, "\u0416" * 20), (2, None)], "k INT, text STRING")
    for n in (1 << 20, 1):
        assert {r["k"]: r["pred_lang"] for r in language.score_languages(df, ["k"], profile, max_bytes=n).collect()} == {1: "de", 2: None}
