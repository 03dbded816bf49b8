"""Files that many tasks write."""

from pyspark.sql import functions as F


def test_tolerant_scan_writes_by_many_tasks(spark, tmp_dir, monkeypatch):
    from corpusflow.plans import io_queries as Q
    spark.range(400).select(F.col("id").alias("doc_id"), F.lit("some text").alias("text"), F.lit("en").alias("lang"), F.lit("src0").alias("source")) \
        .repartition(4).write.parquet(f"{tmp_dir}/documents.parquet")
    spark.range(10).selectExpr("id as event_id", "id as user_id", "timestamp_ntz'2024-01-01' as ts", "'a' as event_type", "1.0 as value").write.parquet(f"{tmp_dir}/events.parquet")
    files = []
    read = Q.read_files
    monkeypatch.setattr(Q, "read_files", lambda s, path, schema: files.extend(s.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path").collect()) or read(s, path, schema))
    got = {(r["kind"], r["name"]): r["n_rows"] for r in Q.tolerant_scan(spark, tmp_dir).collect()}
    assert got["file", "part=0"] == 100 and got["file", "part=broken"] == 0 and got["lines", "read"] == 10
    assert sum("part=0" in f["path"] for f in files) > 1  # one task wrote it all before
