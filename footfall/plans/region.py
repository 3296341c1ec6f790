"""Device to region affinity."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from footfall.functions.text import ZERO_DEVICE
from footfall.operators.groups import group_entropy


def app_events() -> Column:
    """App log rows of a real device that name a shop."""
    return (
        F.col("hp_log_type").between(100, 104)
        & ~F.col("deviceid").rlike(ZERO_DEVICE)
        & F.col("deviceid").isNotNull()
        & F.col("shop_id").isNotNull()
    )


def app_visits(traffic: DataFrame) -> DataFrame:
    return traffic.filter(app_events()).select(
        "deviceid", F.col("user_id").alias("userid"), F.col("shop_id").alias("shopid"),
        F.col("hp_stat_time").alias("dt"), F.lit(1).cast("bigint").alias("n"),
    )


def device_visits(visits: DataFrame) -> DataFrame:
    return visits.select("deviceid", "shopid").distinct()


def region_affinity(visits: DataFrame, shops: DataFrame) -> DataFrame:
    """Visited shops per (device, city, region). A device's rows, one per shop and version at most, lie together from
    here on: what is counted, summed and ranked per device next needs no other shuffle."""
    placed = shops.filter(F.col("region_id") > 0).select(
        F.col("shop_id").alias("shopid"),
        F.col("city_id").alias("cityid"),
        F.col("region_id").alias("regionid"),
    )
    per_device = visits.join(placed, "shopid").select("deviceid", "cityid", "regionid").repartition("deviceid")
    counts = per_device.groupBy("deviceid", "cityid", "regionid")
    return counts.agg(F.count(F.lit(1)).cast("double").alias("score"))


def region_stats(affinity: DataFrame) -> DataFrame:
    """Entropy and number of regions per (device, city), both from one aggregate."""
    return affinity.groupBy("deviceid", "cityid").agg(
        group_entropy("score").alias("entropy"), F.count(F.lit(1)).alias("regions")
    )


def concentration(affinity: DataFrame) -> DataFrame:
    """ln(1 + score) / (entropy + 1), the number of regions kept for the next step. A window holds the regions of one
    city: what ``region_stats`` sums, without a join back."""
    keys = ["deviceid", "cityid"]
    group = Window.partitionBy(*keys)
    w = F.col("score")
    total, weighted = F.sum(w).over(group), F.sum(w * F.log(w)).over(group)
    known = reduce(Column.__and__, [F.col(c).isNotNull() for c in keys])
    stats = affinity.filter(known).withColumns({
        "regions": F.count(F.lit(1)).over(group), "_total": total, "_weighted": weighted,
    })
    entropy = F.log("_total") - F.col("_weighted") / F.col("_total")
    return stats.withColumn("score", F.log(1 + w) / (entropy + 1)).drop("_total", "_weighted")


def breadth(weighted: DataFrame) -> DataFrame:
    score = F.col("score") * F.log(1 + F.col("regions"))
    return weighted.withColumn("score", score).drop("regions")
