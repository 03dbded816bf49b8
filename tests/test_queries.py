"""Registered queries: flagship smoke test, SURVEY expected values, and every
query against its DuckDB oracle on sf0.001."""

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from tests.conftest import SF_SMALL
from tools.oracle_check import TABLES, digest


def test_entry_flagship(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["source", "n_chunks", "n_tokens", "n_docs", "token_share"]
    assert len(rows) == 7
    assert sum(r["n_chunks"] for r in rows) == 18 and sum(r["n_tokens"] for r in rows) == 9001


def test_expected_slice_numbers(spark):
    from corpusflow.operators.chunks import pairs_per_chunk
    from corpusflow.plans.corpus import chunks, clean_documents, tokenized
    docs = tokenized(clean_documents(spark, SF_SMALL, "de"))
    assert docs.count() == 30 and docs.agg(F.sum("n_tokens")).first()[0] == 10510
    ch = chunks(docs.drop("text"))
    assert pairs_per_chunk(ch, 512).count() == 2


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(E.queries()))
def test_query_against_oracle(spark, duck, name):
    pdf = E.queries()[name](spark, SF_SMALL).toPandas()
    sql = E.oracle_sql().get(name)
    if sql is None:
        assert len(pdf.columns) > 0
        return
    assert digest(pdf) == digest(duck.execute(sql).df())
