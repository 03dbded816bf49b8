"""Broadcast only behind a size check.

``broadcast_if_small`` counts at most ``max_rows + 1`` rows (a bounded job)
and marks the frame for broadcast only when it fits; otherwise the join is
left to the planner (shuffle join, AQE skew handling).  Small configuration
tables pass trivially; data-derived tables get the same check.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Default row bound for small per-key tables (catalog, caps, weights).
SMALL_TABLE_ROWS = 100_000


def fits(df: DataFrame, max_rows: int) -> bool:
    return df.limit(max_rows + 1).count() <= max_rows


def broadcast_if_small(df: DataFrame, max_rows: int = SMALL_TABLE_ROWS) -> DataFrame:
    return F.broadcast(df) if fits(df, max_rows) else df
