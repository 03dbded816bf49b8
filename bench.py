"""Benchmark: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]
and print one JSON line.

Each query is executed in full through the ``noop`` sink (no collect to the
driver).  The rate compared with the published one (about 1,700 documents/s) is that of
the like-for-like run: all text tables as sources, language detected, dedup, ids,
weighted mix, and its training windows written (``corpus_mix_windows``).
"""

from __future__ import annotations

import json
import os
import platform
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

REFERENCE_DOCS_PER_SEC = 1700

HEADLINE = [
    "corpus_by_source", "corpus_mix_windows", "dedup_first_wins", "token_ids", "token_ids_subword", "vocab_topk", "chunk_windows",
    "pairs_per_chunk", "pack_flat", "batches", "lang_detect", "capped_chunks", "interleave_race",
    "budget_cut", "split_hash", "union_sources", "metric_series", "eval_by_run", "trend",
    "running_peak", "crossing", "checkpoint_latest", "token_roundtrip", "ingest_stream",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    # default: every registered query; BENCH_QUICK=1 runs the headline subset
    names = sys.argv[1:] or (HEADLINE if os.environ.get("BENCH_QUICK") else None)
    from corpusflow.plans.queries import QUERIES
    from corpusflow.session import get_session
    spark = get_session(f"local[{cpus}]", app="corpusflow-bench", shuffle_partitions=cpus * 2,
                        extra={"spark.driver.memory": "16g",
                               "spark.sql.files.maxPartitionBytes": str(16 * 1024 * 1024)})
    names = names or sorted(QUERIES)
    # warm-up (not timed): JVM start, JIT of the regex/hash paths, Python
    # workers, first checkpoint - one run of the flagship
    QUERIES["corpus_by_source"].build(spark, sf_dir).write.format("noop").mode("overwrite").save()

    times = {}
    for name in names:
        t0 = time.perf_counter()
        QUERIES[name].build(spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)

    n_docs = spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    source_rows = sum(spark.read.parquet(f"{sf_dir}/{t}.parquet").count() for t in ("documents", "conversations", "pages", "benchmark"))
    mix = times.get("corpus_mix_windows")
    out = {
        "metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(sf_dir).replace("sf", ""),
        "docs": n_docs, "source_rows": source_rows,
        "mix_docs_per_sec": round(source_rows / mix, 1) if mix else None,
        "reference_docs_per_sec": REFERENCE_DOCS_PER_SEC,
        "mix_speedup_vs_reference": round(source_rows / mix / REFERENCE_DOCS_PER_SEC, 2) if mix else None,
        "cores": cpus, "spark": spark.version, "python": platform.python_version(),
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
