"""User preference tags."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from footfall.functions.text import PHOTO_PATH, SHOP_ID, SHOP_PATH, url_match, url_number
from footfall.operators.groups import share_of_total
from footfall.operators.joins import join_per_key
from footfall.operators.packed import explode_tags, with_tag_type
from footfall.operators.ranking import first_k, rank_key, top_k_per_group

TAG = ["userid", "cityid", "tagtype", "tag", "score"]

# Lower bounds (exclusive) of the price buckets, highest first.
PRICE_BUCKETS = [(200, ">200"), (120, "121-200"), (80, "81-120"), (50, "51-80"), (20, "21-50")]
PRICE_REST = "<=20"


def shop_pages(traffic: DataFrame, page_type: int) -> DataFrame:
    """Views of shop pages by their URLs, photo pages left out."""
    pages = traffic.filter(
        (F.col("hp_log_type") == 0)
        & (F.col("page_id") == page_type)
        & url_match("path", SHOP_PATH, PHOTO_PATH)
    )
    return pages.select(
        F.col("guid_str").alias("guid"), url_number("path", SHOP_ID).alias("shopid"),
        F.col("hp_stat_time").alias("dt"), F.lit(1).cast("bigint").alias("n"),
    )


def path_visits(pages: DataFrame) -> DataFrame:
    """Distinct (guid, shop)."""
    return pages.select("guid", "shopid").distinct()


def resolve_users(visits: DataFrame, main_user: DataFrame) -> DataFrame:
    return join_per_key(visits, main_user, ["guid"]).select("userid", "shopid")


def location_tags(
    visits: DataFrame, shops: DataFrame, level: str, k: int, per: list[str], log_scale: bool
) -> DataFrame:
    """How often a user visits each region or district; the best k per group."""
    place = shops.filter(F.col(f"{level}_id") > 0).select(
        F.col("shop_id").alias("shopid"),
        F.col("city_id").alias("cityid"),
        F.col(f"{level}_id").alias("_id"),
        F.col(f"{level}_name").alias("tag"),
    )
    n = F.count(F.lit(1))
    score = F.log2(1 + n) if log_scale else n.cast("double")
    counts = visits.join(place, "shopid").groupBy("userid", "cityid", "_id", "tag")
    tags = counts.agg(score.alias("score")).withColumn("tagtype", F.lit(level))
    ties = [c for c in ("cityid", "tag", "_id") if c not in per]
    return top_k_per_group(tags, per, k, "score", ties).select(*TAG)


def shop_attributes(shops: DataFrame, category: int) -> DataFrame:
    chosen = shops.filter((F.col("cat0_id") == category) & (F.col("shop_tags") != ""))
    return chosen.select(
        F.col("city_id").alias("cityid"), F.col("shop_id").alias("shopid"),
        F.col("shop_tags").alias("tags"), F.col("avg_price").alias("avgprice"),
    ).distinct()


def shop_tags(attributes: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """One row per shop and tag, typed by the vocabulary."""
    packed = attributes.filter((F.col("tags") != "") & F.col("tags").isNotNull())
    distinct = packed.select("cityid", "shopid", "tags").distinct()
    exploded = explode_tags(distinct, "tags", ["cityid", "shopid"], "score")
    return with_tag_type(exploded, vocabulary).select(
        "cityid", "shopid", "tagtype", "tag", "score"
    )


def term_frequency(tags: DataFrame) -> DataFrame:
    """Weight of a tag in its shop, within each tag type."""
    shared = share_of_total(tags, ["tagtype", "shopid"], "score", "_tf", eps=1e-7)
    return shared.select("cityid", "shopid", "tagtype", "tag", F.col("_tf").alias("score"))


def user_tags(tags: DataFrame, visits: DataFrame) -> DataFrame:
    joined = visits.join(tags, "shopid").groupBy("userid", "cityid", "tagtype", "tag")
    return joined.agg(F.sum("score").alias("score")).select(*TAG)


def price_bucket(price: str) -> Column:
    bucket = F
    for bound, label in PRICE_BUCKETS:
        bucket = bucket.when(F.col(price) > bound, label)
    return bucket.otherwise(PRICE_REST)


def price_tags(attributes: DataFrame, visits: DataFrame, k: int) -> DataFrame:
    """Visits per price bucket; k per user, lowest city first."""
    priced = attributes.filter(F.col("avgprice").isNotNull()).select(
        "cityid", "shopid", price_bucket("avgprice").alias("tag")
    )
    counts = visits.join(priced, "shopid").groupBy("userid", "cityid", "tag").agg(
        F.count(F.lit(1)).cast("double").alias("score")
    )
    order = [F.col("cityid"), rank_key("score").desc(), F.col("tag")]
    top = first_k(counts, ["userid"], k, order)
    return top.withColumn("tagtype", F.lit("price")).select(*TAG)


def sliced_distinct_visits(traffic: DataFrame, bounds: tuple[str, ...]) -> DataFrame:
    """Distinct (user, shop) per date slice, in one scan. Slices are open below and closed above, the
    last one has no upper bound; a pair seen in several slices counts once in each."""
    day = F.col("hp_stat_time")
    slice_no = F.lit(0)
    for bound in bounds:
        slice_no = slice_no + (day > F.lit(bound).cast("date")).cast("int")
    rows = traffic.filter(
        (F.col("hp_log_type") < 104)
        & F.col("shop_id").isNotNull()
        & (F.col("user_id") > 0)
        & (day > F.lit(bounds[0]).cast("date"))
    )
    return rows.select(
        F.col("user_id").alias("userid"), F.col("shop_id").alias("shopid"), slice_no.alias("_s")
    ).distinct().drop("_s")
