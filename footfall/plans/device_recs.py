"""Daily device to shop recommendation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from footfall import schemas
from footfall.functions.sampling import jitter, kept
from footfall.operators.groups import divide_by_count, share_of_total
from footfall.operators.joins import exclude, expand, join_per_key, restrict
from footfall.operators.merging import merge_scores
from footfall.operators.ranking import first_k, top_k_per_group
from footfall.params import Params
from footfall.plans.region import app_visits

DEVICE_CITY = ["deviceid", "cityid"]
REC = ["deviceid", "cityid", "shopid"]
REGION_SHOP = ["cityid", "regionid", "shopid"]


def decayed_visits(visits: DataFrame, p: Params) -> DataFrame:
    """Repeated visits, the most recent ones per device, faded by their age to a whole number. The visits are
    counts, or the log they are counted in."""
    if "hp_log_type" in visits.columns:
        visits = app_visits(visits)
    counts = (
        visits.groupBy("deviceid", "userid", "shopid")
        .agg(F.sum("n").alias("cnt"), F.max("dt").alias("dt"))
        .filter(F.col("cnt") > p.min_visits)
    )
    order = [F.col("dt").desc(), F.col("cnt").desc(), F.col("userid"), F.col("shopid")]
    recent = first_k(counts, ["deviceid"], p.recent_visits, order)
    age = F.datediff(F.lit(p.as_of).cast("date"), "dt")
    return schemas.conform(
        recent.withColumn("cnt", F.col("cnt") / F.log(3 + age)), schemas.VISITS
    )


def active_visits(visits: DataFrame, *period: str) -> DataFrame:
    return visits.select(*period, "deviceid", "userid", "shopid").distinct()


def edges_to(edges: DataFrame, targets: DataFrame) -> DataFrame:
    """Edges into the given shops, with the target's city."""
    city = targets.select(F.col("shop_id").alias("sid2"), F.col("city_id").alias("cityid"))
    return edges.filter(F.col("sid2").isNotNull()).join(city, "sid2").select(
        F.col("sid1").alias("shopid"), "sid2", "cityid", F.col("rank").alias("edge")
    )


def expand_items(
    scored: DataFrame, weight: Column, row_key: list[str], edges: DataFrame, k: int, p: Params,
    salt: str,
) -> DataFrame:
    """One hop from (device, shop) to similar shops; the best k per device and city."""
    rows = scored.select(*row_key, weight.alias("_w"))
    hop = expand(
        rows, edges, ["shopid"], ["deviceid", "cityid", "sid2"], F.col("_w") * F.col("edge"),
        "rank", kept(p.hop_drop, *row_key, "sid2", salt=f"{p.seed}-{salt}-row"),
    ).withColumnRenamed("sid2", "shopid")
    factor = jitter(p.hop_jitter, *REC, salt=f"{p.seed}-{salt}")
    hop = hop.withColumn("rank", F.col("rank") * factor)
    return top_k_per_group(hop.select(*REC, "rank"), DEVICE_CITY, k, "rank", ["shopid"])


def damped_by_popularity(recs: DataFrame) -> DataFrame:
    return divide_by_count(recs, ["shopid"], "rank", log10=True, eps=1e-6).select(*REC, "rank")


def expand_dislikes(feedback: DataFrame, edges: DataFrame, p: Params) -> DataFrame:
    """Neighbours of disliked shops, the newest per device."""
    disliked = feedback.filter(F.col("score") < 0).select(
        "deviceid", "cityid", F.col("shopid").alias("sid1"), F.col("updatetime").alias("dt")
    )
    near = disliked.join(edges.select("sid1", F.col("sid2").alias("shopid")), "sid1")
    near = near.filter(
        kept(p.dislike_drop, "deviceid", "sid1", "shopid", "dt", salt=f"{p.seed}-dislike")
    )
    order = [F.col("dt").desc(), F.col("cityid"), F.col("shopid"), F.col("sid1")]
    return first_k(near, ["deviceid"], p.dislike_k, order).select(*REC, "dt")


def exclusions(near: DataFrame, feedback: DataFrame, p: Params) -> DataFrame:
    low = feedback.filter(F.col("score") < p.feedback_max)
    return near.unionByName(low.select(*REC, F.col("updatetime").alias("dt")))


def with_promo_boost(recs: DataFrame, promo: DataFrame) -> DataFrame:
    strength = promo.select(F.col("shop_id").alias("shopid"), F.col("score").alias("_s"))
    boost = recs.join(strength, "shopid").withColumn("rank", F.col("rank") * F.log("_s"))
    return recs.unionByName(boost.select(*REC, "rank"))


def wanted_of_users(active: DataFrame, recs: DataFrame) -> DataFrame:
    """(user, city, shop) of the recommendations of a user's devices."""
    devices = active.select("userid", "deviceid").distinct()
    return recs.select(*REC).join(devices, "deviceid").select("userid", "cityid", "shopid")


def user_recs_to_device(active: DataFrame, user_recs: DataFrame) -> DataFrame:
    devices = active.select("userid", "deviceid").distinct()
    return devices.join(user_recs, "userid").select(*REC, "score")


def with_agreement_boost(recs: DataFrame, other: DataFrame, weight: float) -> DataFrame:
    both = recs.join(other.select(*REC, F.col("score").alias("_s")), REC)
    boost = both.withColumn("rank", F.lit(weight) * (F.col("_s") + 1) * F.col("rank"))
    return recs.unionByName(boost.select(*REC, "rank"))


def unseen(recs: DataFrame, visits: DataFrame) -> DataFrame:
    return exclude(recs, visits, ["deviceid", "shopid"])


def seen_negated(recs: DataFrame, visits: DataFrame) -> DataFrame:
    seen = restrict(recs, visits, ["deviceid", "shopid"])
    return seen.withColumn("rank", -F.col("rank"))


def mark_seen(recs: DataFrame, visits: DataFrame) -> DataFrame:
    """``unseen`` and ``seen_negated`` together, in one join."""
    keys = ["deviceid", "shopid"]
    seen = visits.select(*keys).distinct().withColumn("_seen", F.lit(True))
    sign = F.when(F.col("_seen"), -F.col("rank")).otherwise(F.col("rank"))
    return recs.join(seen, keys, "left").select(*REC, sign.alias("rank"))


def region_hot_shops(active: DataFrame, shops: DataFrame, *period: str) -> DataFrame:
    """Active devices per eligible shop, per period if there are several."""
    devices = active.select(*period, "deviceid", "shopid").distinct()
    per_shop = devices.groupBy(*period, "shopid").agg(F.count(F.lit(1)).alias("cnt"))
    placed = shops.select(
        F.col("shop_id").alias("shopid"),
        F.col("city_id").alias("cityid"),
        F.col("region_id").alias("regionid"),
    )
    return per_shop.join(placed, "shopid").select(*period, *REGION_SHOP, "cnt")


def region_tf(hot: DataFrame, p: Params, salt: str | Column, *period: str) -> DataFrame:
    """ln(c) * c / (region total), counts above a floor only; the total is over all counts."""
    shared = share_of_total(
        hot, [*period, "cityid", "regionid"], "cnt", "_tf", min_value=p.hot_min_count + 1
    )
    factor = jitter(p.region_jitter, *REGION_SHOP, salt=salt)
    score = F.log("cnt") * F.col("_tf") * factor
    return shared.select(*period, *REGION_SHOP, score.alias("score"))


def region_recs(
    devices: DataFrame, affinity: DataFrame, trend: DataFrame, p: Params
) -> DataFrame:
    """Trending shops of the regions a device likes."""
    liked = restrict(affinity, devices, DEVICE_CITY)
    rising = trend.filter(F.col("score") > 0).select(
        "cityid", "regionid", "shopid", F.col("score").alias("_t")
    )
    joined = join_per_key(liked, rising, ["cityid", "regionid"])
    scored = joined.select(
        *REC, "regionid", (F.col("_t") * F.log2(2 + F.col("score"))).alias("score")
    )
    top = top_k_per_group(scored, DEVICE_CITY, p.region_rec_k, "score", ["shopid", "regionid"])
    return top.select(*REC, "score")


def carry_over(state: DataFrame, recs: DataFrame, p: Params) -> DataFrame:
    """Earlier recommendations of the devices and cities of today."""
    todays = restrict(state, recs, DEVICE_CITY)
    return todays.filter(kept(p.carry_drop, *REC, salt=f"{p.seed}-carry")).select(*REC, "rank")


def backfill(
    recs: DataFrame, carried: DataFrame, regional: DataFrame, p: Params
) -> DataFrame:
    """Today's rows, carried rows, and regional rows at the average rank of their device and city."""
    mean = recs.groupBy(*DEVICE_CITY).agg(F.avg("rank").alias("_m"))
    rank = F.col("_m") * jitter(p.backfill_jitter, *REC, salt=f"{p.seed}-backfill")
    filled = regional.join(mean, DEVICE_CITY).select(*REC, rank.alias("rank"))
    return carried.unionByName(recs).unionByName(filled)


def category_cap(recs: DataFrame, shops: DataFrame, p: Params) -> DataFrame:
    categories = shops.select(F.col("shop_id").alias("shopid"), F.col("cat1_id").alias("cat1id"))
    placed = recs.join(categories, "shopid").select(*REC, "rank", "cat1id")
    return top_k_per_group(
        placed, [*DEVICE_CITY, "cat1id"], p.category_cap, "rank", ["shopid"]
    )


def merge_min(rows: DataFrame) -> DataFrame:
    """Rows of a device and city, which today's, carried and regional rows bound, lie together from here on: the cap per
    category and the last top-k need no other shuffle."""
    return merge_scores(rows.repartition(*DEVICE_CITY), REC, "rank", "min", 3)
