"""Trending search keywords per city."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from footfall.functions.sampling import kept
from footfall.functions.text import (
    PHOTO_PATH, SEARCH_CITY, SEARCH_DEEPER, SEARCH_PATH, SEARCH_WORD, SHOP_PATH, clean_keyword,
    has_text, url_match, url_number, url_part,
)
from footfall.operators.groups import share_of_total
from footfall.operators.merging import merge_scores
from footfall.operators.ranking import top_k_per_group
from footfall.params import Params


def search_clicks(traffic: DataFrame, p: Params) -> DataFrame:
    """Shop views that came from a search in the same city: signed-in rows and a sample of the others."""
    rows = traffic.filter(
        (F.col("hp_log_type") <= 1)
        & (F.col("city_id") > 0)
        & (F.col("city_id") == url_number("referer", SEARCH_CITY, "int"))
        & url_match("path", SHOP_PATH, PHOTO_PATH)
        & url_match("referer", SEARCH_PATH, SEARCH_DEEPER)
    ).select(
        F.col("guid_str").alias("guid"), F.col("city_id").alias("cityid"),
        F.col("shop_id").alias("shopid"), url_part("referer", SEARCH_WORD).alias("keyword"),
        F.col("hp_stat_time").alias("dt"), "user_id",
    )
    sample = kept(
        p.click_drop, "guid", "cityid", "shopid", "keyword", "dt", salt=f"{p.seed}-clicks"
    )
    return rows.filter((F.col("user_id") > 0) | sample).drop("user_id")


def clean_clicks(clicks: DataFrame, p: Params) -> DataFrame:
    cleaned = clicks.filter(has_text("keyword")).withColumn("keyword", clean_keyword("keyword"))
    kept = cleaned.filter(has_text("keyword") & ~F.col("keyword").isin(*p.blocked))
    return kept.select("guid", "cityid", "shopid", "keyword", "dt").distinct()


def keyword_clicks(clicks: DataFrame, *period: str) -> DataFrame:
    return clicks.select(*period, "cityid", "keyword", "dt", F.when(F.col("guid").isNotNull(), 1).otherwise(0).cast("bigint").alias("n"))


def keyword_counts(clicks: DataFrame, *period: str) -> DataFrame:
    return clicks.groupBy(*period, "cityid", "keyword").agg(F.sum("n").alias("cnt"))


def keyword_share(counts: DataFrame, p: Params, *period: str) -> DataFrame:
    keys = [*period, "cityid"]
    shared = share_of_total(counts, keys, "cnt", "score", 1e-5, p.hot_min_clicks)
    return shared.select(*keys, "keyword", "score")


def rising(trend: DataFrame, p: Params) -> DataFrame:
    kept = trend.filter((F.col("score") > 0) & (F.col("score") < p.hot_max_trend))
    return top_k_per_group(kept, ["cityid"], p.hot_k, "score", ["keyword"])


def finalise(named: DataFrame, p: Params) -> DataFrame:
    short = named.filter((F.col("cityid") > 0) & (F.length("keyword") <= p.max_keyword_len))
    merged = merge_scores(short, ["cityid", "keyword"], "score", "avg")
    return top_k_per_group(merged, ["cityid"], p.hot_final_k, "score", ["keyword"])
