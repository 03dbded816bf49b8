"""Flat arrays read by lines, a record being a chunk."""

import random

import pytest

from corpusflow.sources.token_io import read_flat, write_flat


def test_flat_lines(spark, tmp_dir):
    rng, rows, at = random.Random(3), [], 0
    for _ in range(200):
        ids = [rng.randint(0, 60_000) for _ in range(rng.randint(0, 30))]
        rows.append((at, ids))
        at += len(ids)
    flat = [i for _, ids in rows for i in ids]
    write_flat(spark.createDataFrame(rows, "offset BIGINT, chunk ARRAY<INT>").repartition(5), f"{tmp_dir}/flat", len(flat), parts=4)
    for lines in (True, False):
        assert sorted(map(tuple, read_flat(spark, f"{tmp_dir}/flat", lines=lines).collect())) == list(enumerate(flat))
    spark.createDataFrame([("[1, 2",), (", 2.5]",)], "value STRING").coalesce(1).write.text(f"{tmp_dir}/bad")
    with pytest.raises(Exception, match="2.5"):
        read_flat(spark, f"{tmp_dir}/bad", lines=True).collect()
