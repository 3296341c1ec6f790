"""Cookie to main user."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def page_views(traffic: DataFrame) -> DataFrame:
    """Page views of signed-in users."""
    views = traffic.filter((F.col("hp_log_type") == 0) & (F.col("user_id") > 0))
    return views.select(
        F.col("guid_str").alias("guid"), F.col("user_id").alias("userid"),
        F.col("hp_stat_time").alias("dt"), F.lit(1).cast("bigint").alias("n"),
    )


def pair_counts(views: DataFrame) -> DataFrame:
    return views.groupBy("guid", "userid").agg(F.sum("n").alias("cnt"))
