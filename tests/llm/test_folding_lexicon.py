"""Toxicity: folding of accents and look-alikes, the lexicon against plain counts, scores against a plain scorer."""

import math
import random

from pyspark.sql import functions as F

from corpusflow.llm import toxicity


def test_precomposed_and_combining_accents_fold_alike():
    for word, want in {"fück": "fuck", "fück": "fuck", "ÎDIÖT": "idiot", "ídìőţ": "idiot", "søđłħŧ": "sodlht", "ｉｄｉｏｔ": "idiot", "𝐢𝓭𝕚𝔬𝚝": "idiot",
                       "ɪᴅɪᴏᴛ": "idiot", "ⓘⓓⓘⓞⓣ": "idiot", "🅸🅳🅸🅾🆃": "idiot", "ﬁlth": "filth", "і​dіоt": "idiot", "ıdιοτ": "idiot", "1d­10t": "idiot", "ѐvil": "evil"}.items():
        assert toxicity.fold(word) == f" {want} ", word


def test_what_folding_leaves_alone():
    assert toxicity.fold("１９９８ 1998 $5") == "  "
    assert toxicity.fold("日本語 한국어 पानी") == f" 日本語 한국어 {toxicity.fold('पानी').strip()} "
    assert toxicity.fold(None) == toxicity.fold("") == toxicity.fold(" \n\t!?") == "  "
    assert toxicity.fold("a" * 300_000) == " " + "a" * 300_000 + " "


def _corpus():
    rng = random.Random(2)
    rows = []
    for i in range(900):
        bad = i % 3 == 0
        text = [f"w{rng.randrange(70)}ord" for _ in range(rng.randrange(5, 40))]
        if bad:
            text += rng.choices(["grömpf", "gr0mpfen", "zлоtch", "vilexx"], k=3)
        elif i % 9 == 1:
            text += ["grompfalia"]
        rng.shuffle(text)
        rows.append((i, " ".join(text), int(bad)))
    return [*rows, *rows[:5], (2000, None, 0), (2001, "", 1), (None, "grompf", 0)]


def _plain_lexicon(rows, support=4):
    bad, good, n = {}, {}, [0, 0]
    for _, text, y in rows:
        n[y] += 1
        seen = set()
        for w in toxicity.fold(text).split():
            seen |= {f" {w} "} | {f" {w[:k]}" for k in range(4, 9) if len(w) > k}
        for t in seen:
            side = bad if y else good
            side[t] = side.get(t, 0) + 1
    weights = {t: math.log((b + 0.1) / n[1]) - math.log((good.get(t, 0) + 0.5) / n[0]) for t, b in bad.items() if b >= support and b >= good.get(t, 0)}
    weights = {t: w for t, w in weights.items() if w >= 2}
    terms = {t: w for t, w in weights.items() if not any(o != t and t.startswith(o) for o in weights)}
    stems = [t for t in terms if not t.endswith(" ")]
    spared = {t.strip() for t, g in good.items() if t.endswith(" ") and g >= 3 and g > 4 * bad.get(t, 0) and any(t.startswith(s) and len(t) > len(s) for s in stems)}
    return terms, spared


def test_lexicon_and_exceptions_against_plain_counts(spark):
    rows = _corpus()
    train = spark.createDataFrame([(y, t) for _, t, y in rows], "y long, text string").repartition(4)
    terms, harmless, share = toxicity.learn_lexicon(train)
    want, spared = _plain_lexicon(rows)
    assert terms.keys() == want.keys() and all(abs(terms[t] - want[t]) < 1e-9 for t in want)
    assert set(harmless) == spared and len(terms) > 2
    assert abs(share - sum(y for *_, y in rows) / len(rows)) < 1e-12


def test_scores_against_a_plain_scorer(spark):
    rows = _corpus()
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string").repartition(3)
    labels = spark.createDataFrame([(i, y) for i, _, y in rows[:900]], "doc_id long, toxic int")
    model = toxicity.learn(docs, labels, key="doc_id", text="text", label="toxic")
    got = sorted((r.doc_id is None, r.doc_id or 0, r.score) for r in toxicity.toxicity(docs, model, key="doc_id", text="text").collect())
    want = []
    for i, text, _ in rows:
        folded = toxicity.fold(text)
        spared = {(at, at + len(p)) for p in map(toxicity.fold, model["exceptions"]) for at in range(len(folded)) if folded.startswith(p, at)}
        total = sum(w for t, w in model["terms"].items() for at in range(len(folded))
                    if folded.startswith(t, at) and not any(a <= at and at + len(t) <= b for a, b in spared))
        z = model["weights"] @ [1, math.log1p(total), math.log1p(100 * total / folded.count(" "))]
        want.append((i is None, i or 0, 1 / (1 + math.exp(-z))))
    assert len(got) == len(want)
    for a, b in zip(got, sorted(want), strict=True):
        assert a[:2] == b[:2] and abs(a[2] - b[2]) < 1e-9
    truth = {i: y for i, _, y in rows[:900]}
    assert all((s >= 0.3) == bool(truth[i]) for null, i, s in got if not null and i in truth)


def test_labels_of_one_class_and_none(spark):
    docs = spark.createDataFrame([(i, "grompf") for i in range(9)], "doc_id long, text string")
    for y, want in ((1, 1.0), (0, 0.0)):
        labels = docs.select("doc_id", F.lit(y).alias("toxic"))
        model = toxicity.learn(docs, labels, key="doc_id", text="text", label="toxic")
        assert {r.score for r in toxicity.toxicity(docs, model, key="doc_id", text="text").collect()} == {want}
