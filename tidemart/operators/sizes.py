"""Size checks: when a side may be broadcast."""

from __future__ import annotations

from pyspark.sql import DataFrame

BROADCAST_BYTES = 32 << 20


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of a plan (for files: what the scan has to read)."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def is_small(df: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    return estimated_bytes(df) <= limit
