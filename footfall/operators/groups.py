"""Group totals joined back to detail rows.

Totals are computed by ``groupBy`` (map-side combine) and joined back, not by a window over the group:
a window sends the whole group to one task, a join partition that is too large is split at run time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from footfall.operators.joins import join_per_key


def with_group_stats(df: DataFrame, keys: Sequence[str], **stats: Column) -> DataFrame:
    totals = df.groupBy(*keys).agg(*[c.alias(n) for n, c in stats.items()])
    return join_per_key(df, totals, keys)


def share_of_total(
    df: DataFrame, keys: Sequence[str], value: str, out: str, eps: float = 0.0,
    min_value: int | None = None,
) -> DataFrame:
    """value / (total of the group + eps). ``min_value`` drops rows after the total is taken."""
    totals = df.groupBy(*keys).agg(F.sum(value).alias("_total"))
    kept = df if min_value is None else df.filter(F.col(value) >= min_value)
    shared = join_per_key(kept, totals, keys)
    return shared.withColumn(out, F.col(value) / (F.col("_total") + eps)).drop("_total")


def divide_by_count(
    df: DataFrame, keys: Sequence[str], value: str, log10: bool = False, eps: float = 0.0
) -> DataFrame:
    """Damp a value by how many rows share its key."""
    n = F.log10(F.count(F.lit(1))) if log10 else F.count(F.lit(1)).cast("double")
    damped = with_group_stats(df, keys, _n=n)
    return damped.withColumn(value, F.col(value) / (F.col("_n") + eps)).drop("_n")


def divide_by_sum(df: DataFrame, keys: Sequence[str], value: str, eps: float) -> DataFrame:
    """Damp a value by the mass of its key."""
    damped = with_group_stats(df, keys, _s=F.sum(value))
    return damped.withColumn(value, F.col(value) / (F.col("_s") + eps)).drop("_s")


def log_mean_ratio(df: DataFrame, keys: Sequence[str], value: str, eps: float) -> DataFrame:
    """ln(value / mean of the group + eps) + eps."""
    centred = with_group_stats(df, keys, _m=F.avg(value))
    ratio = F.log(F.col(value) / F.col("_m") + eps) + eps
    return centred.withColumn(value, ratio).drop("_m")


def group_entropy(weight: str) -> Column:
    """Entropy of p = w / sum(w), as one aggregate: ln(sum w) - sum(w ln w) / sum(w)."""
    w = F.col(weight)
    return F.log(F.sum(w)) - F.sum(w * F.log(w)) / F.sum(w)


def tf_idf(
    df: DataFrame, family: str, doc: str, term: str, weight: str, n_docs: int | None = None
) -> DataFrame:
    """weight * ln(documents of the family / rows of the term), in every family at once.

    ``n_docs`` is the number of documents of each family where it is known; else it is counted."""
    rows = df.groupBy(family, term).agg(F.count(F.lit(1)).alias("_rows"))
    if n_docs is None:
        rows = rows.join(df.groupBy(family).agg(F.count_distinct(doc).alias("_docs")), family)
    else:
        rows = rows.withColumn("_docs", F.lit(n_docs))
    idf = rows.select(family, term, F.log(F.col("_docs") / F.col("_rows")).alias("_idf"))
    scored = join_per_key(df, idf, [family, term])
    return scored.withColumn(weight, F.col(weight) * F.col("_idf")).drop("_idf")
