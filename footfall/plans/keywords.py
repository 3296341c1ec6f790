"""Per-user keyword recommendation."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from footfall.functions.sampling import jitter
from footfall.functions.text import (
    PHOTO_PATH, SEARCH_DEEPER, SEARCH_PATH, SEARCH_WORD, SHOP_ID, SHOP_PATH, clean_keyword,
    has_text, readable, url_match, url_number, url_part,
)
from footfall.operators.groups import divide_by_count, divide_by_sum, share_of_total
from footfall.operators.joins import exclude_from_totals, expand, join_per_key, restrict
from footfall.operators.merging import merge_scores
from footfall.operators.pairs import top_pairs
from footfall.operators.ranking import top_k_per_group
from footfall.params import Params
from footfall.plans.tags import path_visits, resolve_users

USER_CITY = ["userid", "cityid"]


def searches(traffic: DataFrame) -> DataFrame:
    return traffic.filter(
        (F.col("hp_log_type") == 0) & url_match("path", SEARCH_PATH, SEARCH_DEEPER)
    ).select(
        F.col("guid_str").alias("guid"), F.col("city_id").alias("cityid"),
        url_part("path", SEARCH_WORD).alias("keyword"), F.col("hp_stat_time").alias("dt"),
        F.lit(1).cast("bigint").alias("n"),
    )


def user_searches(rows: DataFrame, main_user: DataFrame) -> DataFrame:
    return join_per_key(rows, main_user, ["guid"]).select(
        "userid", "cityid", "keyword", F.col("n").alias("cnt"), "dt"
    )


def clean_searches(searches: DataFrame) -> DataFrame:
    cleaned = searches.filter(has_text("keyword")).withColumn("keyword", clean_keyword("keyword"))
    return cleaned.filter(has_text("keyword"))


def search_profile(searches: DataFrame, p: Params) -> DataFrame:
    kept = searches.filter(~F.col("keyword").isin(*p.blocked))
    return kept.groupBy("userid", "cityid", "keyword").agg(
        F.sum("cnt").alias("cnt"), F.max("dt").alias("dt")
    )


def frequent(profile: DataFrame, p: Params) -> DataFrame:
    """Keywords that enough users of the city search for."""
    users = profile.groupBy("cityid", "keyword").agg(F.count("userid").alias("n"))
    return restrict(profile, users.filter(F.col("n") >= p.min_users), ["cityid", "keyword"])


def tf_decay(profile: DataFrame, p: Params) -> DataFrame:
    """Share of the user's searches in the city, faded by age."""
    tf = share_of_total(profile, ["cityid", "userid"], "cnt", "weight", 1e-5)
    age = F.datediff(F.lit(p.as_of).cast("date"), "dt")
    return tf.select(
        "userid", "cityid", "keyword", (F.col("weight") / F.log(3 + age)).alias("weight"), "dt"
    )


def keyword_edges(profile: DataFrame, p: Params) -> DataFrame:
    """Keyword to keyword: the same user and city, another keyword on the same day or within
    ``edge_days`` after it."""
    rows = profile.select("cityid", "userid", "dt", "keyword", F.lit(1.0).alias("w"))
    return top_pairs(
        rows.withColumnRenamed("keyword", "sid1"), rows.withColumnRenamed("keyword", "sid2"),
        part="cityid", group=["userid"], a="sid1", b="sid2",
        score=lambda total, rows: F.log10(rows + 10), k=p.edge_k, day="dt", within=p.edge_days,
    )


def damped_edges(edges: DataFrame, p: Params) -> DataFrame:
    damped = divide_by_sum(edges, ["cityid", "sid2"], "score", 1e-4)
    top = top_k_per_group(damped, ["cityid", "sid1"], p.edge_keep, "score", ["sid2"])
    return top.select("cityid", "sid1", "sid2", "score")


def hop_tasks(profile: DataFrame, p: Params) -> int:
    """Tasks for the hops of these users and cities: what goes into a task is small and what a hop makes of it is
    not, so its size does not tell how many tasks it takes."""
    return 1 + profile.select(*USER_CITY).distinct().count() * p.keyword_k * p.edge_keep // p.hop_rows


def expand_keywords(
    weighted: DataFrame, weight: str, edges: DataFrame, p: Params, salt: str, tasks: int | None = None
) -> DataFrame:
    """One hop to similar keywords; the best k per user and city. With ``tasks`` the users are dealt to so many."""
    weighted = weighted if tasks is None else weighted.repartition(tasks, *USER_CITY)
    source = weighted.select(*USER_CITY, F.col("keyword").alias("sid1"), F.col(weight).alias("_w"))
    hop = expand(
        source, edges, ["cityid", "sid1"], [*USER_CITY, "sid2"], F.col("score") * F.col("_w"),
        "_out",
    ).select(*USER_CITY, F.col("sid2").alias("keyword"), F.col("_out").alias("score"))
    factor = jitter(p.keyword_jitter, "userid", "cityid", "keyword", salt=f"{p.seed}-{salt}")
    hop = hop.withColumn("score", F.col("score") * factor)
    return top_k_per_group(hop, USER_CITY, p.keyword_k, "score", ["keyword"])


def shop_clicks(traffic: DataFrame) -> DataFrame:
    """Clicks from a searched keyword to a shop."""
    rows = traffic.filter(
        (F.col("hp_log_type") == 0)
        & (F.col("city_id") > 0)
        & url_match("path", SHOP_PATH, PHOTO_PATH)
        & url_match("referer", SEARCH_PATH, SEARCH_DEEPER)
    ).select(
        F.col("city_id").alias("cityid"), url_number("path", SHOP_ID).alias("shopid"),
        url_part("referer", SEARCH_WORD).alias("keyword"), F.col("hp_stat_time").alias("dt"),
        F.lit(1).cast("bigint").alias("n"),
    )
    cleaned = rows.filter(has_text("keyword")).withColumn("keyword", clean_keyword("keyword"))
    return cleaned.filter(has_text("keyword"))


def keyword_shop_counts(clicks: DataFrame, shops: DataFrame) -> DataFrame:
    """Clicks per keyword and shop name of a city."""
    clicks = clicks.groupBy("cityid", "shopid", "keyword").agg(F.sum("n").alias("n"))
    names = shops.select(
        F.col("city_id").alias("cityid"), F.col("shop_id").alias("shopid"),
        F.col("shop_name").alias("shopname"),
    )
    joined = clicks.join(names, ["cityid", "shopid"])
    return joined.groupBy("cityid", "keyword", "shopname").agg(F.sum("n").alias("cnt"))


def keyword_shop_share(counts: DataFrame) -> DataFrame:
    shared = share_of_total(counts, ["cityid", "keyword"], "cnt", "score", 1e-3)
    return shared.select("cityid", "keyword", "shopname", "score")


def top_keywords(named: DataFrame, p: Params) -> DataFrame:
    merged = merge_scores(named, [*USER_CITY, "keyword"], "score", "sum", 5)
    return top_k_per_group(merged, USER_CITY, p.keyword_final_k, "score", ["keyword"])


def readable_keywords(recs: DataFrame, p: Params) -> DataFrame:
    return recs.filter(readable("keyword", p.max_keyword_len))


def recent_views(pages: DataFrame, main_user: DataFrame) -> DataFrame:
    """Cookies of a user that viewed a shop."""
    views = resolve_users(path_visits(pages), main_user)
    return views.groupBy("userid", "shopid").agg(F.count("shopid").alias("cnt"))


def short_named(shops: DataFrame, p: Params) -> DataFrame:
    return shops.filter(F.length("shop_name") <= p.max_shop_name_len)


def shop_name_recs(views: DataFrame, edges: DataFrame, shops: DataFrame) -> DataFrame:
    """Names of shops similar to the viewed ones. Edges are cut to named shops before the hop, and
    one aggregate serves both the shop and the name level."""
    names = shops.select(
        F.col("shop_id").alias("sid2"), F.col("shop_name").alias("keyword"),
        F.col("city_id").alias("cityid"),
    )
    named = edges.join(names, "sid2").select(F.col("sid1").alias("shopid"), "cityid", "keyword", "rank")
    return expand(
        views, named, ["shopid"], ["userid", "cityid", "keyword"], F.col("cnt") * F.col("rank"),
        "score",
    )


def damped_names(recs: DataFrame) -> DataFrame:
    return divide_by_count(recs, ["keyword"], "score", eps=1e-6)


def unseen_names(recs: DataFrame, views: DataFrame, shops: DataFrame) -> DataFrame:
    names = shops.select(F.col("shop_id").alias("shopid"), F.col("shop_name").alias("keyword"))
    viewed = views.select("userid", "shopid").join(names, "shopid")
    return exclude_from_totals(recs, viewed, ["userid", "keyword"])


def top_names(recs: DataFrame, p: Params) -> DataFrame:
    short = recs.filter(F.length("keyword") <= p.max_keyword_len)
    return top_k_per_group(short, USER_CITY, p.shop_name_k, "score", ["keyword"])


def final_keywords(recs: DataFrame, names: DataFrame, p: Params) -> DataFrame:
    cols = [*USER_CITY, "keyword", "score"]
    both = recs.select(*cols).unionByName(names.select(*cols))
    return top_k_per_group(both, USER_CITY, p.keyword_final_k, "score", ["keyword"])
