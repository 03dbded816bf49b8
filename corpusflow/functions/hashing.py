"""Deterministic hash-derived numbers (no ``rand()``: recomputation after a lost
executor must give the same values)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_POW_48 = 281474976710656.0


def md5_int(expr: Column, hex_digits: int = 8) -> Column:
    """Leading ``hex_digits`` of md5 as a non-negative BIGINT."""
    return F.conv(F.substring(F.md5(expr.cast("string")), 1, hex_digits), 16, 10).cast("bigint")


def md5_bucket(expr: Column, modulus: int) -> Column:
    return F.pmod(md5_int(expr, 8), F.lit(modulus))


def md5_uniform(*parts: Column) -> Column:
    """A uniform in the open interval (0, 1) from md5 of the joined parts."""
    key = F.concat_ws(":", *[p.cast("string") for p in parts])
    return (md5_int(key, 12).cast("double") + F.lit(1.0)) / F.lit(TWO_POW_48 + 1.0)
