import json
import os

from pyspark.sql import functions as F

from corpusflow.sources.catalog import SourceSpec, catalog_frame, read_sources
from corpusflow.sources.runlog_io import append_runlog
from corpusflow.sources.synthetic import synthetic_pieces
from corpusflow.sources.token_io import read_legacy_flat, read_tokens, write_tokens
from corpusflow.streaming.monitor import OUT_SCHEMA, start_monitor
from tests.conftest import SF_SMALL
from tests.models import monitor_loop


def test_tolerant_union_and_missing_column(spark, tmp_dir):
    specs = [SourceSpec("docs", f"{SF_SMALL}/documents.parquet", 0.6, order_expr="doc_id"),
             SourceSpec("broken", f"{tmp_dir}/nope.parquet", 0.2, order_expr="doc_id"),
             SourceSpec("pages_wrong_col", f"{SF_SMALL}/pages.parquet", 0.1, order_expr="page_id"),
             SourceSpec("pages", f"{SF_SMALL}/pages.parquet", 0.1, text_column="html", order_expr="page_id")]
    union, skipped = read_sources(spark, specs)
    assert skipped == ["broken"]
    counts = {r["source"]: r["n"] for r in union.groupBy("source").agg(F.count("*").alias("n")).collect()}
    assert counts == {"docs": 200, "pages": 50}
    assert catalog_frame(spark, specs).count() == 4
    assert SourceSpec("x", "p", 1.0, order_expr="id", subset="s", config=None).location(True) == "p/s"
    assert SourceSpec("x", "p", 1.0, order_expr="id", subset="s", config=None).location(False) == "p"
    assert SourceSpec("x", "p", 1.0, order_expr="id", subset="s", config="c").location(True) == "p/c"


def test_source_filter_pushed_to_scan(spark):
    spec = SourceSpec("docs", f"{SF_SMALL}/documents.parquet", 1.0, order_expr="doc_id",
                      lang_column="lang", filters=("de",))
    union, _ = read_sources(spark, [spec], with_lang=True)
    plan = union._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "In(lang" in plan or "EqualTo(lang" in plan
    assert {r["lang"] for r in union.select("lang").distinct().collect()} == {"de"}


def test_token_roundtrip_and_legacy(spark, tmp_dir):
    df = spark.createDataFrame([("a", 0, [1, 2, 3]), ("b", 1, [4, 5, 6]), ("a", 2, [7, 8, 9])],
                               "source STRING, doc_id BIGINT, chunk ARRAY<INT>")
    write_tokens(df, f"{tmp_dir}/tok")
    back = read_tokens(spark, f"{tmp_dir}/tok").orderBy("doc_id").collect()
    assert [r["chunk"] for r in back] == [[1, 2, 3], [4, 5, 6], [7, 8, 9]]
    with open(f"{tmp_dir}/flat.json", "w") as f:
        json.dump(list(range(1, 10)), f)
    legacy = read_legacy_flat(spark, f"{tmp_dir}/flat.json").collect()
    assert legacy[0]["tokens"] == list(range(1, 10))


def test_synthetic_pieces_are_bounded_and_seeded(spark):
    a = synthetic_pieces(spark, 2500, 1000, vocab_size=97, seed=3)
    rows = a.orderBy("piece_id").collect()
    assert [len(r["tokens"]) for r in rows] == [1000, 1000, 500]
    assert all(0 <= t < 97 for r in rows for t in r["tokens"])
    b = synthetic_pieces(spark, 2500, 1000, vocab_size=97, seed=3).orderBy("piece_id").collect()
    assert rows == b


def test_monitor_stream_matches_poll_model(spark, tmp_dir):
    log, out, ckpt = f"{tmp_dir}/log", f"{tmp_dir}/out", f"{tmp_dir}/ckpt"
    polls = [
        [{"seq": 1, "step": 0, "loss": 3.0}],                                     # step 0: never shown
        [{"seq": 2, "step": 10, "loss": 2.5, "perplexity": 12.0}],               # first shown: no arrows
        [{"seq": 3, "step": 20, "loss": 2.6}, {"seq": 4, "step": 30, "loss": 2.4, "perplexity": 12.0,
                                               "tokens_per_second": 5.0}],       # only the newest
        [{"seq": 5, "step": 25, "loss": 1.0}],                                    # older step: nothing
        [{"seq": 6, "step": 40, "loss": 2.4, "tokens_per_second": 4.0}],          # vs last shown
    ]
    schema = "run_id BIGINT, seq BIGINT, step BIGINT, loss DOUBLE, perplexity DOUBLE, tokens_per_second DOUBLE"
    for batch in polls:
        rows = [(1, r["seq"], r["step"], r.get("loss"), r.get("perplexity"), r.get("tokens_per_second"))
                for r in batch]
        append_runlog(spark.createDataFrame(rows, schema), log)
        start_monitor(spark, log, out, ckpt, available_now=True).awaitTermination()
    shown = spark.read.schema(OUT_SCHEMA).parquet(out).orderBy("seq").collect()
    got = [(r["step"], {"loss": r["loss_trend"], "perplexity": r["perplexity_trend"],
                        "tokens_per_second": r["tokens_per_second_trend"]}) for r in shown]
    assert got == monitor_loop(polls)
    assert os.path.isdir(ckpt)


def _ingest_rows(spark, rows, path):
    words = " ".join(f"w{i % 13}" for i in range(40))
    data = [(d, f"src{d % 3}", f"{words} {t}", "de") for d, t in rows]
    spark.createDataFrame(data, "doc_id BIGINT, source STRING, text STRING, lang STRING") \
        .coalesce(1).write.mode("append").parquet(path)


def test_ingest_batch_mode_first_wins_across_batches(spark, tmp_dir):
    from corpusflow.streaming.ingest import start_ingest
    src, out, ckpt = f"{tmp_dir}/src", f"{tmp_dir}/out", f"{tmp_dir}/ckpt"
    spec = SourceSpec("docs", src, 1.0, order_expr="doc_id", lang_column="lang")
    _ingest_rows(spark, [(5, "a"), (2, "a"), (7, "b"), (3, "b"), (9, "c")], src)
    kw = dict(min_len=4, max_len=1000, target=8)
    start_ingest(spark, [spec], out, ckpt, **kw).awaitTermination()
    _ingest_rows(spark, [(1, "a"), (11, "d"), (12, "d")], src)   # 'a' already seen: dropped
    start_ingest(spark, [spec], out, ckpt, **kw).awaitTermination()
    landed = spark.read.parquet(out)
    firsts = sorted((r["doc_ord"], r["batch_id"]) for r in
                    landed.filter("chunk_idx = 0").select("doc_ord", "batch_id").collect())
    assert firsts == [(2, 0), (3, 0), (9, 0), (11, 1)]
    state_out = f"{tmp_dir}/out_state"
    start_ingest(spark, [spec], state_out, f"{tmp_dir}/ckpt_state", mode="state", **kw).awaitTermination()
    a = {r["h"] for r in landed.select("h").distinct().collect()}
    b = {r["h"] for r in spark.read.parquet(state_out).select("h").distinct().collect()}
    assert a == b and len(a) == 4


def test_streaming_variant_precedence(spark, tmp_dir):
    from corpusflow.sources.catalog import read_source
    base = f"{tmp_dir}/ds"
    for variant, text in [("cfgA", "from config"), ("subB", "from subset")]:
        spark.createDataFrame([(1, text)], "id BIGINT, text STRING").write.parquet(f"{base}/{variant}")
    def landed(spec, name):
        out, ckpt = f"{tmp_dir}/{name}", f"{tmp_dir}/{name}-ckpt"
        q = (read_source(spark, spec, 0, streaming=True).writeStream.format("parquet")
             .option("path", out).option("checkpointLocation", ckpt).trigger(availableNow=True).start())
        q.awaitTermination()
        return [r["text"] for r in spark.read.parquet(out).collect()]
    assert landed(SourceSpec("x", base, 1.0, config="cfgA", subset="subB", order_expr="id"), "o1") == ["from config"]
    assert landed(SourceSpec("x", base, 1.0, subset="subB", order_expr="id"), "o2") == ["from subset"]
    batch = read_source(spark, SourceSpec("x", base, 1.0, config="cfgA", subset="subB", order_expr="id"))
    assert [r["text"] for r in batch.collect()] == ["from config"]


def test_sources_that_would_give_wrong_rows_are_refused(spark):
    import pytest
    from corpusflow.sources.catalog import SourceError
    for bad in ({}, {"order_expr": "0"}, {"order_expr": "doc_id", "filters": ("de",)}):
        with pytest.raises(SourceError):
            SourceSpec("x", "p", 1.0, **bad)
    lacking = SourceSpec("x", f"{SF_SMALL}/benchmark.parquet", 1.0, order_expr="item_id", lang_column="lang", filters=("de",))
    with pytest.raises(SourceError):
        read_sources(spark, [lacking])


def test_monitor_of_many_runs_calls_once_per_bucket(spark, tmp_dir, monkeypatch):
    """Runs share their bucket's state: each is shown as if it were alone, the runs without an id too."""
    import random

    from corpusflow.streaming import monitor

    monkeypatch.setattr(monitor, "BUCKETS", 3)
    rng = random.Random(4)
    log, out, ckpt = f"{tmp_dir}/log", f"{tmp_dir}/out", f"{tmp_dir}/ckpt"
    schema = "run_id BIGINT, seq BIGINT, step BIGINT, loss DOUBLE, perplexity DOUBLE, tokens_per_second DOUBLE"
    some = lambda: rng.choice([None, 1.0, 2.0, 3.0])
    runs = [None, *range(-3, 40), (1 << 62) + 1, (1 << 62) + 3]
    polls = {r: [] for r in runs}
    seq = 0
    for _ in range(3):
        rows = []
        for r in runs:
            own = []
            for _ in range(rng.randint(0, 3)):
                seq += 1
                own.append({"seq": (1 << 60) + seq, "step": rng.choice([None, 0, 10, 20, 30, (1 << 60) + 1]), "loss": some(), "perplexity": some(), "tokens_per_second": some()})
            rows += [(r, *x.values()) for x in own]
            polls[r].append(own)
        append_runlog(spark.createDataFrame(rows, schema).repartition(3), log)
        start_monitor(spark, log, out, ckpt, available_now=True).awaitTermination()
    shown = spark.read.schema(OUT_SCHEMA).parquet(out).orderBy("seq").collect()
    got = {r: [(x["step"], {m: x[f"{m}_trend"] for m in monitor.TRACKED}) for x in shown if x["run_id"] == r] for r in runs}
    assert got == {r: monitor_loop([[{**x, "step": x["step"] or 0} for x in p] for p in polls[r] if p]) for r in runs}
    calls = [0, 0]

    class State:
        exists = False

        def update(self, value):
            calls[0] += 1
    import pandas as pd
    many = pd.DataFrame({"run_id": range(500), "seq": 1, "step": 10, "loss": 1.0, "perplexity": None, "tokens_per_second": 2.0})
    calls[1] = sum(len(x) for x in monitor.show_latest((0,), iter([many]), State()))
    assert calls == [1, 500]
