"""Exact rounding of binary doubles against Python's formatter."""

import random

from pyspark.sql import functions as F

from corpusflow.functions.format import fixed, scientific


def test_fixed_matches_python(spark):
    rng = random.Random(11)
    values = [0.0, 0.5, 1.5, 2.5, 0.125, 0.375, 2.675, 1.005, 0.00005, 0.00015, 1e-9, 0.99995, 9.99995, 123456.78905, 4.85e8, 2.0**51 + 0.5, 1e12 + 0.12345, 1e15, 1e17, -2.5, -0.00004, -1.005]
    values += [round(rng.uniform(0, 20), 5) for _ in range(3000)]           # many ties in shortest decimals
    values += [rng.randint(0, 4000) / 32 for _ in range(1000)]              # exact ties
    values += [rng.uniform(-1e6, 1e10) for _ in range(1000)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i INT, v DOUBLE")
    for digits in (0, 2, 4):
        got = {r["i"]: r["t"] for r in df.select("i", fixed(F.col("v"), digits).alias("t")).collect()}
        for i, v in enumerate(values):
            assert got[i] == f"{v:.{digits}f}", (v, digits)


def test_scientific_matches_python(spark):
    rng = random.Random(12)
    values = [0.0, 5e-4, 1e-6, 1e-5, 9.995e-4, 9.994999e-4, 9.9949999999e-5, 1.005e-4, 2.675e-5, 1.0, 99.95, 10.0, 3.5e-12, 123.0, 7e20, -2.5e-4]
    values += [5e-4 * t / 50 for t in range(1, 60)] + [round(rng.uniform(1e-7, 1e-3), 9) for _ in range(2000)] + [rng.randint(1, 9999) / 10**7 for _ in range(2000)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i INT, v DOUBLE")
    got = {r["i"]: r["t"] for r in df.select("i", scientific(F.col("v")).alias("t")).collect()}
    for i, v in enumerate(values):
        assert got[i] == f"{v:.2e}", v
