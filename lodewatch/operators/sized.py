"""Broadcasts only behind a check of size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LIMIT_BYTES = 64 << 20


def maybe_broadcast(df: DataFrame, limit: int = LIMIT_BYTES) -> DataFrame:
    """A broadcast hint if the optimizer's estimate of the plan's size is within ``limit``; else the plan as it is, for a shuffle join that AQE may still improve."""
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return F.broadcast(df) if int(str(size)) <= limit else df


def settled(df: DataFrame, limit: int = LIMIT_BYTES) -> DataFrame:
    """The same by the size of the rows themselves, which are worked out once and kept: for small results of plans whose estimate is large."""
    kept = df.persist()
    kept.count()
    return maybe_broadcast(kept.select("*"), limit)
