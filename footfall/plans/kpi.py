"""Recommender KPIs. One-number totals enter as scalar subqueries, not as joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def _metric(df: DataFrame, label: str, value: Column, as_of: str) -> DataFrame:
    return df.agg(value.alias("value")).select(
        F.lit(label).alias("metric"), "value", F.lit(as_of).alias("dt")
    )


def coverage(recs: DataFrame, eligible: DataFrame, as_of: str) -> DataFrame:
    """Distinct recommended shops / distinct eligible shops."""
    shops = eligible.agg(F.count_distinct("shop_id")).scalar()
    return _metric(recs, "coverage", F.count_distinct("shopid") / shops, as_of)


def popularity(recs: DataFrame) -> DataFrame:
    """Share of devices a shop is recommended to."""
    devices = recs.agg(F.count_distinct("deviceid")).scalar()
    return recs.groupBy("shopid").agg((F.count("deviceid") / devices).alias("p"))


def popularity_entropy(pop: DataFrame, as_of: str) -> DataFrame:
    p = F.col("p")
    return _metric(pop, "entropy", F.sum(-p * F.log(p)), as_of)


def hit_rate(recs: DataFrame, visits: DataFrame, as_of: str) -> DataFrame:
    """Recommendations that were visited / recommendations: a precision."""
    seen = visits.select("deviceid", "shopid").distinct().withColumn("_hit", F.lit(1))
    joined = recs.join(seen, ["deviceid", "shopid"], "left")
    return _metric(joined, "hit_rate", F.count("_hit") / F.count(F.lit(1)), as_of)
