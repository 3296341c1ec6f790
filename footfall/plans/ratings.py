"""User to user collaborative filtering on ratings."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from footfall.functions.sampling import kept
from footfall.operators.groups import divide_by_count, log_mean_ratio
from footfall.operators.pairs import best_pairs
from footfall.operators.ranking import top_k_per_group
from footfall.params import Params
from footfall.sources.storage import materialise

USER_CITY = ["userid", "cityid"]
CENTRE_EPS = 0.001


def ratings(reviews: DataFrame, p: Params) -> DataFrame:
    current = reviews.filter(
        (F.col("hp_valid_end_dt") == p.current_version) & (F.col("star") >= p.min_rating)
    )
    return current.select("userid", "cityid", "shopid", F.col("star").alias("score"))


def normalised(rated: DataFrame) -> DataFrame:
    return divide_by_count(rated, USER_CITY, "score")


def centred(rated: DataFrame) -> DataFrame:
    return log_mean_ratio(rated, USER_CITY, "score", CENTRE_EPS)


def members(rated: DataFrame, p: Params) -> DataFrame:
    """One row per user, city and shop: the sum ``w`` and number ``c`` of the scores, and the sum ``good`` of those
    above the floor. Frames that have these columns are returned as they are."""
    if "good" in rated.columns:
        return rated
    score = F.col("score")
    return rated.groupBy("userid", "cityid", "shopid").agg(*_sums(score, p))


def _sums(score: Column, p: Params) -> list[Column]:
    good = F.sum(F.when(score > p.rating_floor, score))
    return [F.sum(score).alias("w"), F.count(F.lit(1)).alias("c"), good.alias("good")]


def centred_members(rated: DataFrame, p: Params, users: DataFrame | None = None) -> DataFrame:
    """``members`` of the centred ratings. ``users`` get a mark, ``mine``; if they name cities as well, their rows there
    get another, ``asked``.

    A user's ratings are shuffled once: means, marks and sums are made where they lie together, one after the other in
    the order of the sort. The users to mark are rows without a score among them."""
    kind = {f.name: f.dataType for f in rated.schema}
    rows = rated.filter(F.col("userid").isNotNull() & F.col("cityid").isNotNull()).select(*USER_CITY, "shopid", "score")
    by_user, by_city = Window.partitionBy("userid"), Window.partitionBy(*USER_CITY)
    marks = {}
    if users is not None:
        named = [c for c in USER_CITY if c in users.columns]
        own = users.select(*named).dropna().distinct()
        empty = [F.lit(None).cast(kind[c]).alias(c) for c in ("cityid", "shopid", "score") if c not in named]
        rows = rows.withColumn("_own", F.lit(False)).unionByName(own.select(*named, *empty, F.lit(True).alias("_own")))
        marks = {"mine": F.max("_own").over(by_user)}
        marks |= {"asked": F.max("_own").over(by_city)} if "cityid" in named else {}
    placed = rows.repartition("userid").withColumns({"_m": F.avg("score").over(by_city), **marks})
    placed = placed if users is None else placed.filter(~F.col("_own"))
    score = F.log(F.col("score") / F.col("_m") + CENTRE_EPS) + CENTRE_EPS
    return placed.groupBy(*USER_CITY, "shopid", *marks).agg(*_sums(score, p))


def user_similarity(
    rated: DataFrame, p: Params, cut: Callable[[DataFrame, str], DataFrame] = materialise,
    users: DataFrame | None = None,
) -> DataFrame:
    """sum(s1 * s2) * ln(co-rated rows) per pair of users of a city; the best k per user, for all
    users, the given or the marked ones, in the cities they are asked in. Of an item that very many rate only pairs that can be among them are made.
    Takes ratings or their ``members``."""
    rows = members(rated, p)
    marked = [F.col(c).alias("mine") for c in ("asked", "mine") if c in rows.columns][:1]
    rows = rows.select("cityid", F.col("shopid").alias("item"), F.col("userid").alias("sid2"), "w", "c", *marked)
    only = None if users is None else users.select(F.col("userid").alias("sid1"))
    return best_pairs(
        None, rows, part="cityid", group=["item"], a="sid1", b="sid2", growth=F.log, k=p.similar_k, cut=cut,
        crowd=p.crowded_item, only=only,
    )


def recommend(
    similar: DataFrame, rated: DataFrame, p: Params, wanted: DataFrame | None = None
) -> DataFrame:
    """What similar users rate well, without what the user has rated; of the rows that makes only ``wanted``
    (userid, cityid, shopid), if given: they join the user's rows and are picked after the ranking.

    Rows of a user lie together from one shuffle on: what the user has rated, a row without a city, is told apart,
    summed and ranked there. Takes ratings or their ``members``. A user's rows are bounded by what ``similar_k`` others rate in each city."""
    rated = members(rated, p)
    liked = rated.filter(F.col("good").isNotNull()).select(
        "cityid", "shopid", F.col("userid").alias("sid2"), F.col("good").alias("_r")
    )
    rows = similar.join(liked, ["cityid", "sid2"]).filter(
        kept(p.cf_drop, "sid1", "sid2", "cityid", "shopid", salt=f"{p.seed}-cf")
    )
    found = rows.select(
        F.col("sid1").alias("userid"), "cityid", "shopid", (F.col("score") * F.col("_r")).alias("score")
    )
    own = rated.filter("mine") if "mine" in rated.columns else rated
    known = own.filter(F.col("shopid").isNotNull()).select(
        "userid", F.lit(None).cast(found.schema["cityid"].dataType).alias("cityid"), "shopid",
        F.lit(None).cast("double").alias("score"),
    )
    sums = [F.sum("score").alias("score")]
    if wanted is None:
        per_user = found.unionByName(known)
    else:
        kind = {"found": 1, "known": 0, "wanted": 2}
        found, known = (df.withColumn("_kind", F.lit(kind[n]).cast("tinyint")) for n, df in (("found", found), ("known", known)))
        asked = wanted.filter(F.col("cityid").isNotNull()).select(
            "userid", "cityid", "shopid", F.lit(None).cast("double").alias("score"),
            F.lit(kind["wanted"]).cast("tinyint").alias("_kind"),
        )
        per_user = found.unionByName(known).unionByName(asked)
        sums.append(F.bit_or("_kind").alias("_kind"))
    scored = per_user.repartition("userid").groupBy("userid", "shopid", "cityid").agg(*sums)
    seen = F.max(F.col("cityid").isNull()).over(Window.partitionBy("userid", "shopid"))
    new = scored.withColumn("_seen", seen).filter(~F.col("_seen")).drop("_seen")
    new = new if wanted is None else new.filter(F.col("_kind").bitwiseAND(1) == 1)
    best = top_k_per_group(new, USER_CITY, p.cf_k, "score", ["shopid"])
    best = best if wanted is None else best.filter(F.col("_kind").bitwiseAND(2) == 2)
    return best.select("userid", "cityid", "shopid", "score")
