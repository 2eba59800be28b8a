"""Broadcast only what is provably small."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Spark's own limit: sizes are of compressed files, which grow several times in memory.
BROADCAST_LIMIT_BYTES = 10 * 1024 * 1024


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of the optimised plan (no job is run)."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def fits_broadcast(df: DataFrame, limit: int = BROADCAST_LIMIT_BYTES) -> bool:
    """Whether the estimate is within ``limit``."""
    return estimated_bytes(df) <= limit


def small_side(df: DataFrame, limit: int = BROADCAST_LIMIT_BYTES) -> DataFrame:
    """Hint a broadcast if the estimate is within ``limit``.

    Beyond it the frame is returned without a hint: the join is then planned as
    a shuffle join whose hot keys AQE splits.
    """
    return F.broadcast(df) if fits_broadcast(df, limit) else df
