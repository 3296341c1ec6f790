"""Top-k and arg-max per group.

``row_number() <= k`` plans as a partial and a final WindowGroupLimit, so each task sends at most k
rows of a group through the shuffle, however large the group is.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def rank_key(score: str | Column) -> Column:
    """Score in steps of 1e-6, so that the last bits of a float sum do not decide a tie."""
    col = F.col(score) if isinstance(score, str) else score
    return F.floor(col * 1e6 + 0.5)


def first_k(df: DataFrame, keys: Sequence[str], k: int, order: Sequence[Column]) -> DataFrame:
    rn = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rn", rn).filter(F.col("_rn") <= k).drop("_rn")


def top_k_per_group(
    df: DataFrame, keys: Sequence[str], k: int, score: str, ties: Sequence[str]
) -> DataFrame:
    """The k best-scored rows of each group; ties by the given columns, ascending."""
    return first_k(df, keys, k, [rank_key(score).desc(), *[F.col(t).asc() for t in ties]])


def argmax_per_group(df: DataFrame, key: str, value: str, by: str) -> DataFrame:
    """The value with the largest ``by`` per key, the smallest value on ties.

    One aggregate with map-side combine instead of a sort."""
    best = F.min(F.struct((-F.col(by)).alias("neg"), F.col(value).alias("v")))
    return df.groupBy(key).agg(best.alias("_best")).select(key, F.col("_best.v").alias(value))
