"""Extra columns named like every column inside, for the operators that return rows whole; and the pipeline."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from corpusflow.llm import decontam, langid, line_dedup, near_dups
from corpusflow.llm.common import stored, without
from tests.llm.test_operators import words

NAMES = ["r", "content", "a", "b", "_a", "_b", "_content", "n_deleted", "n_deleted_lines", "deleted", "left", "rid", "parts", "e", "t", "row_id", "id", "k", "n", "stays",
         "n_lines", "key", "_rid", "ta", "tb", "_nth", "hits", "w", "item", "component", "kept", "n_copies", "lang_id", "posterior", "declared", "host"]


def texts():
    base = words(1, 150)
    near = base.split()
    near[70] = "changed"
    run = "\n".join(words(40 + i, 20) for i in range(4))
    item = words(7, 40)
    out = [base, base, " ".join(near), None, "", words(2, 90), "intro of one\n" + run + "\nend", run + "\nother tail here", words(3, 30) + " " + item + " " + words(4, 30), words(9, 4000)]
    return out, item


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i if i != 5 else None, t, "en", "src0", len(t or "")) for i, t in enumerate(texts()[0])]
    rows += [rows[5], rows[6]]  # repeated rows
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for i, name in enumerate(NAMES):
        df = df.withColumn(name, F.concat(F.lit(f"{i}-"), F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))))
    return df


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.createDataFrame([(1, texts()[1], "x", "y")], "item_id long, text string, e string, item string")


def own(rows):
    """The extra columns of every row are its own."""
    for r in rows:
        for i, name in enumerate(NAMES):
            if name in r.asDict():
                assert r[name] == f"{i}-{'none' if r.doc_id is None else r.doc_id}", name
    return rows


def test_line_dedup_keeps_other_columns(docs):
    out = line_dedup.dedup_lines(docs, key="doc_id", text="text", deleted_lines="gone")
    assert out.columns == [*docs.columns, "gone"]
    rows = own(out.collect())
    assert len(rows) == 12
    assert sorted(r.gone for r in rows if r.doc_id == 6) == [0, 6]
    assert [r.text for r in rows if r.doc_id == 7] == ["other tail here"]
    named = line_dedup.dedup_lines(docs, key="doc_id", text="text")
    assert named.columns == [*(c for c in docs.columns if c != "n_deleted_lines"), "n_deleted_lines"]
    assert max(r.n_deleted_lines for r in named.collect()) == 6


def test_near_dedup_keeps_other_columns(docs):
    out = near_dups.deduplicate(docs, key="doc_id", text="text")
    assert out.columns == docs.columns
    kept = [r.doc_id for r in own(out.collect())]
    assert kept.count(0) == 1 and 1 not in kept and 2 not in kept and kept.count(None) == 1 and kept.count(6) == 1


def test_decontamination_keeps_other_columns(docs, benchmark):
    out = decontam.decontaminate(docs, benchmark, key="doc_id", text="text", item="item_id", item_text="text")
    assert out.columns == docs.columns
    assert 8 not in [r.doc_id for r in own(out.collect())] and out.count() == 11


def test_language_id_keeps_other_columns(docs):
    out = langid.accepted_documents(docs, docs)
    assert out.columns == docs.columns
    own(out.collect())


def test_without_compares_whole_rows(docs):
    from corpusflow.llm.common import content_key
    bad = docs.filter("doc_id = 1").select(content_key("text").alias("c")).select("c.*")
    assert without(docs, bad, "text").count() == 10  # both documents of that text


def test_pipeline_on_hard_rows(spark, docs, benchmark, tmp_path):
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    benchmark.write.parquet(f"{tmp_path}/benchmark.parquet")
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stored(stage(spark, kept, str(tmp_path)), f"test-{name}")
        assert kept.columns == docs.columns, name
        own(kept.collect())
    ids = [r.doc_id for r in kept.collect()]
    # null and empty texts have no language; copies, the repeated rows and the benchmark passage go
    assert sorted(i for i in ids if i is not None) == [0, 6, 7, 9] and ids.count(None) == 1
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in out} == {None, 0, 6, 7, 9} and all(r.round_trip for r in out)
    assert next(r.n_chars for r in kept.collect() if r.doc_id == 7) == len("other tail here")


def test_pipeline_on_empty_tables(spark, docs, benchmark, tmp_path):
    docs.filter("false").write.parquet(f"{tmp_path}/documents.parquet")
    benchmark.filter("false").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
