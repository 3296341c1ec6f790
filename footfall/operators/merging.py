"""Union and merge of scored rows, and table-based incremental state."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def union_weighted(frames: Sequence[tuple[DataFrame, float]], score: str) -> DataFrame:
    return union_all([
        f if w == 1.0 else f.withColumn(score, F.col(score) * w) for f, w in frames
    ])


def merge_scores(
    df: DataFrame, keys: Sequence[str], score: str, how: str, digits: int | None = None
) -> DataFrame:
    """One row per key: the sum, min or avg of its scores."""
    merged = {"sum": F.sum, "min": F.min, "avg": F.avg}[how](score)
    if digits is not None:
        merged = F.round(merged, digits)
    return df.groupBy(*keys).agg(merged.alias(score))


def compact_counts(
    state: DataFrame, batch: DataFrame, keys: Sequence[str], count: str, min_total: int
) -> DataFrame:
    """Add a batch of counts to the state and drop what stays at or below min_total."""
    total = state.unionByName(batch).groupBy(*keys).agg(F.sum(count).alias(count))
    return total.filter(F.col(count) > min_total)


def decay_state(state: DataFrame, score: str, factor: float, floor: float) -> DataFrame:
    """Drop weak rows, then fade the rest."""
    return state.filter(F.col(score) > floor).withColumn(score, F.col(score) * factor)
