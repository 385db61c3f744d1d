"""Broadcast only what has been measured."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_BROADCAST_ROWS = 200_000


def is_small(df: DataFrame, weight: Column | None = None, limit: int = MAX_BROADCAST_ROWS) -> bool:
    """Whether the counted size is within ``limit``.

    Size is the row count, or the sum of ``weight`` for rows of varying width
    (polygon edges).
    """
    size = df.agg(F.count(F.lit(1)) if weight is None else F.sum(weight)).first()[0] or 0
    return size <= limit


def broadcast_if_small(df: DataFrame, weight: Column | None = None, limit: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast of a small frame; a larger one is left to shuffle."""
    return F.broadcast(df) if is_small(df, weight, limit) else df
