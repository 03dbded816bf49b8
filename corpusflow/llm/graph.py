"""Connected components by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusflow.llm.common import stored


def _starred(edges: DataFrame, name: str) -> DataFrame:
    """Edges (u, v) of a star step: all v of a u move to the least of them and u.
    The least ids are stored, so that both sides of the join are plain shuffles
    and a vertex of many edges can be split."""
    least = stored(edges.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), f"{name}-least")
    return edges.join(least, "u")


def _stars(edges: DataFrame) -> bool:
    """Whether every edge (u, v) leads from a vertex of no other edge to its centre, so that no further step moves one."""
    ends = edges.select(F.col("u").alias("id"), F.lit(1).alias("left"), F.lit(0).alias("right"))
    ends = ends.unionByName(edges.select(F.col("v").alias("id"), F.lit(0).alias("left"), F.lit(1).alias("right")))
    ends = ends.groupBy("id").agg(F.sum("left").alias("left"), F.sum("right").alias("right"))
    return ends.filter("left > 1 or left = 1 and right > 0").agg(F.count("*")).first()[0] == 0


def components(edges: DataFrame, most: int = 60) -> DataFrame:
    """(id, component) of every vertex of the undirected ``edges`` (a, b); the component is its smallest id.

    Each round halves the depth of the trees at least, so rounds grow with the
    logarithm of the longest chain; every round is written to the shared folder, the last is known by its stars."""
    now = stored(edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    for _ in range(most):
        if _stars(now):
            stars = now.select(F.col("u").alias("id"), F.col("v").alias("component"))
            return stars.unionByName(now.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _starred(both, "large").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        large = stored(large, "large-star")
        small = _starred(large, "small")
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(small.select("u", F.col("m").alias("v")))
        now = stored(small.filter("u <> v").distinct(), "small-star")
    raise RuntimeError("components did not settle")
