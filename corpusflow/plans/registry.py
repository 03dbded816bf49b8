"""Registry of named queries: a Spark builder ``(spark, sf_dir) -> DataFrame``
and, where the semantics are expressible in SQL, a DuckDB oracle string."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    build: Builder
    sql: str | None
    ops: str


QUERIES: dict[str, Query] = {}


def register(name: str, ops: str, sql: str | None = None):
    def wrap(fn: Builder) -> Builder:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = Query(name, fn, sql, ops)
        return fn
    return wrap
