"""Learning-rate schedules (X1, X2) and scalar metric formulas (A5, A7) as
column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def perplexity(loss: Column, cap: float = 20.0) -> Column:
    """exp(min(loss, cap)); the cap guards against overflow."""
    return F.exp(F.least(loss, F.lit(float(cap))))


def descale_loss(micro_loss: Column, accumulation: int) -> Column:
    """Logged loss = micro-batch loss x accumulation steps."""
    return micro_loss * F.lit(float(accumulation))


def update_index(step: Column, accumulation: int) -> Column:
    """Number of optimizer updates done after micro-step ``step`` (0-based):
    the scheduler advances only when (step + 1) is a multiple of accumulation."""
    return F.floor((step + F.lit(1)) / F.lit(accumulation)).cast("bigint")


def cosine_with_warmup(t: Column, base_lr: float, warmup: int, horizon: int,
                       min_lr: float) -> Column:
    """Linear warmup to base_lr, then cosine decay towards min_lr over
    ``horizon`` updates; not clamped past the horizon."""
    ratio = float(min_lr) / float(base_lr)
    td = t.cast("double")
    warm = td / F.lit(float(warmup)) if warmup > 0 else F.lit(1.0)
    progress = (td - F.lit(float(warmup))) / F.lit(float(horizon - warmup))
    decay = F.lit(0.5) * (F.lit(1.0) + F.cos(F.lit(math.pi) * progress))
    factor = F.when(td < F.lit(float(warmup)), warm).otherwise(
        F.lit(ratio) + F.lit(1.0 - ratio) * decay)
    return F.lit(float(base_lr)) * factor


def linear_decay(t: Column, base_lr: float, horizon: int, min_lr: float) -> Column:
    """base_lr x (1 + (ratio - 1) x min(t, horizon) / horizon), no warmup."""
    ratio = float(min_lr) / float(base_lr)
    frac = F.least(t.cast("double"), F.lit(float(horizon))) / F.lit(float(horizon))
    return F.lit(float(base_lr)) * (F.lit(1.0) + F.lit(ratio - 1.0) * frac)
