"""Flat token arrays read by byte ranges, scans that report what they couldn't read,
logs whose order comes from the files, batches that change size, and keyed ingest."""

import glob
import json
import random

from pyspark.sql import functions as F

from corpusflow.operators import runlog as R
from corpusflow.sources.catalog import SourceSpec
from corpusflow.sources.runlog_io import append_runlog, append_runlog_maps, read_runlog_maps
from corpusflow.sources.token_io import read_flat, write_flat
from corpusflow.sources.tolerant import read_files, read_lines


def test_flat_parts_are_one_array(spark, tmp_dir):
    rng, rows, at = random.Random(5), [], 0
    for _ in range(300):
        ids = [rng.randint(0, 60_000) for _ in range(rng.randint(0, 40))]
        rows.append((at, ids))
        at += len(ids)
    flat = [i for _, ids in rows for i in ids]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "offset BIGINT, chunk ARRAY<INT>").repartition(6)
    write_flat(df, f"{tmp_dir}/flat", len(flat), parts=4)
    parts = sorted(glob.glob(f"{tmp_dir}/flat/part-*"))
    assert len(parts) > 1 and json.loads("".join(open(p).read() for p in parts)) == flat
    back = sorted(map(tuple, read_flat(spark, f"{tmp_dir}/flat").collect()))
    assert back == list(enumerate(flat))


def test_one_flat_file_is_read_by_several_tasks(spark, tmp_dir):
    for name, ids, text in (("a", list(range(40_000, 0, -1)), None), ("b", [], "[]"), ("c", [7], "[7]\n"), ("d", [1, 2, 3], "[1,\n2 , \n\n3]")):
        with open(f"{tmp_dir}/{name}.json", "w") as f:
            f.write(text or json.dumps(ids))
        old = spark.conf.get("spark.sql.files.maxPartitionBytes")
        spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
        try:
            got = read_flat(spark, f"{tmp_dir}/{name}.json")
            tasks = spark.read.option("lineSep", ",").text(f"{tmp_dir}/{name}.json").rdd.getNumPartitions()
        finally:
            spark.conf.set("spark.sql.files.maxPartitionBytes", old)
        assert sorted(map(tuple, got.collect())) == list(enumerate(ids))
        assert tasks > 5 or name != "a"


def test_files_that_fail_are_named(spark, tmp_dir):
    df = spark.range(100).select("id", F.lit("x").alias("text"))
    df.coalesce(1).write.parquet(f"{tmp_dir}/src/good")
    df.filter("id < 0").coalesce(1).write.parquet(f"{tmp_dir}/src/empty")
    with open(f"{tmp_dir}/src/broken.parquet", "wb") as f:
        f.write(b"PAR1 and no more")
    rows, report = read_files(spark, f"{tmp_dir}/src", df.schema)
    assert rows.count() == 100
    got = {r["file"].rsplit("/", 2)[-2 if "part-" in r["file"] else -1]: r["n_rows"] for r in report.collect()}
    assert got == {"good": 100, "empty": 0, "broken.parquet": 0}


def test_lines_that_fail_are_kept(spark, tmp_dir):
    with open(f"{tmp_dir}/log.json", "w") as f:
        f.write('{"step": 1, "loss": 2.5}\n{"step": 2, "lo\n{"step": 3}\n[1, 2]x\n{"step": "four", "loss": 1.0}\n')
    rows, bad = read_lines(spark, f"{tmp_dir}/log.json", spark.createDataFrame([], "step BIGINT, loss DOUBLE").schema)
    assert [(r["step"], r["loss"]) for r in rows.orderBy("step").collect()] == [(1, 2.5), (3, None)]
    assert sorted(r["line"] for r in bad.collect()) == sorted(['{"step": 2, "lo', "[1, 2]x", '{"step": "four", "loss": 1.0}'])


def test_order_of_appends_and_null_against_absent(spark, tmp_dir):
    log = f"{tmp_dir}/log"
    schema = "run_id BIGINT, n BIGINT, metrics MAP<STRING, DOUBLE>"
    first = [(1, 1, {"step": 1.0, "loss": 3.0}), (1, 2, {"step": 2.0, "loss": None}), (1, 3, {"step": 3.0}), (2, 4, {"loss": 9.0})]
    again = [(1, 1, {"step": 2.0, "loss": 2.5}), (1, 2, {"step": 3.0, "loss": 2.4})]  # a resume repeats steps
    for rows in (first, again):
        append_runlog_maps(spark.createDataFrame(rows, schema).repartition(3), log, ["n"])
    back = read_runlog_maps(spark, log)
    assert back.columns == ["run_id", "arrival", "metrics"]
    h = R.history(back.filter("run_id = 1"), "loss", map_col="metrics").orderBy("arrival").collect()
    assert [r["value"] for r in h] == [3.0, None, 2.5, 2.4]
    per = R.latest_per_step(back.filter("run_id = 1").select("run_id", F.col("metrics")["step"].alias("step"), F.col("metrics")["loss"].alias("loss"), "arrival"), [F.col("arrival")], ["loss"])
    assert {r["step"]: (r["n_logged"], r["loss"]) for r in per.collect()} == {1.0: (1, 3.0), 2.0: (2, 2.5), 3.0: (2, 2.4)}


def test_typed_append_keeps_its_order(spark, tmp_dir):
    rows = spark.createDataFrame([(1, i) for i in range(500)], "run_id BIGINT, n BIGINT").repartition(7)
    append_runlog(rows, f"{tmp_dir}/log", ["n"])
    append_runlog(rows.filter("n < 50").withColumn("n", F.col("n") + 1000), f"{tmp_dir}/log", ["n"])
    back = spark.read.json(f"{tmp_dir}/log").orderBy("arrival").collect()
    assert [r["n"] for r in back] == [*range(500), *range(1000, 1050)]


def test_batches_against_a_loop(spark):
    crossings = spark.createDataFrame([(1, 20), (2, None), (3, 0)], "run_id BIGINT, cross_step BIGINT")
    breaks = R.batch_breaks(crossings, 16, 8)
    steps = breaks.crossJoin(spark.range(40).withColumnRenamed("id", "step")).withColumn("b", R.batch_at(F.col("breaks"), F.col("step")))
    got = {(r["run_id"], r["step"]): (r["b"]["batch_size"], r["b"]["first_sample"]) for r in steps.collect()}
    owner = {}
    for run, cross in ((1, 20), (2, None), (3, 0)):
        at = 0
        for step in range(40):
            size = 8 if cross is not None and step > cross else 16
            assert got[run, step] == (size, at)
            owner.update({(run, at + i): step for i in range(size)})
            at += size
    samples = breaks.crossJoin(spark.range(300).withColumnRenamed("id", "s")).select("run_id", "s", R.batch_of_sample(F.col("breaks"), F.col("s")).alias("step"))
    assert all(owner[r["run_id"], r["s"]] == r["step"] for r in samples.collect())


def test_keyed_ingest_first_wins_across_batches(spark, tmp_dir):
    from corpusflow.streaming.ingest import start_ingest
    src, out, ckpt = f"{tmp_dir}/src", f"{tmp_dir}/out", f"{tmp_dir}/ckpt"
    spec = SourceSpec("docs", src, 1.0, order_expr="doc_id", lang_column="lang")
    words = " ".join(f"w{i % 13}" for i in range(40))
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    feeds = [[(5, "a"), (2, "a"), (7, "b"), (3, "b"), (9, "c"), *((100 + i, "hot") for i in range(3000))],
             [(1, "a"), (11, "d"), (12, "d"), *((5000 + i, "hot") for i in range(500))], [(13, "d"), (14, "e"), (0, "hot")]]
    for rows in feeds:
        spark.createDataFrame([(d, f"{words} {t}", "de") for d, t in rows], "doc_id BIGINT, text STRING, lang STRING").repartition(3).write.mode("append").parquet(src)
        start_ingest(spark, [spec], out, ckpt, mode="keyed", min_len=4, max_len=1000, target=8).awaitTermination()
    landed = spark.read.parquet(out)
    assert sorted(r["doc_ord"] for r in landed.filter("chunk_idx = 0").collect()) == [2, 3, 9, 11, 14, 100]
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") == before


def test_one_copy_per_arrow_batch():
    import pyarrow as pa
    from corpusflow.streaming.ingest import _one_copy
    from corpusflow.streaming.monitor import newest_rows
    b = pa.RecordBatch.from_pydict({"h": ["x", "y", "x", "x"], "source_ord": [1, 0, 0, 0], "doc_ord": [1, 5, 9, 3], "text": ["t"] * 4})
    out = next(_one_copy(iter([b])))
    assert sorted(zip(out.column("h").to_pylist(), out.column("doc_ord").to_pylist())) == [("x", 3), ("y", 5)]
    logs = pa.RecordBatch.from_pydict({"run_id": [1, 1, 2, 1], "seq": [3, None, 1, 2], "step": [30, 0, 10, 20]})
    assert sorted(next(newest_rows(iter([logs]))).column("step").to_pylist()) == [10, 30]
