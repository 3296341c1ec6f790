"""Operators on rows small enough to work out by hand."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from footfall import schemas
from footfall.functions.sampling import hash_uniform
from footfall.functions.text import clean_keyword, readable, url_number
from footfall.operators import groups, joins, merging, packed, ranking
from footfall.params import Params
from footfall.plans import device_recs, kpi, ratings, region, tags, trending


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_top_k_ties_by_key(spark):
    df = spark.createDataFrame(
        [("a", 3, 1.0), ("a", 1, 1.0 + 1e-12), ("a", 2, 2.0), ("b", 9, 0.0)], "g string, id int, s double"
    )
    assert rows(ranking.top_k_per_group(df, ["g"], 2, "s", ["id"]), "g", "id") == [
        ("a", 1), ("a", 2), ("b", 9),
    ]


def test_top_k_prunes_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("g"), "id", F.rand(1).alias("s"))
    plan = ranking.top_k_per_group(df, ["g"], 2, "s", ["id"])._jdf.queryExecution().toString()
    assert "row_number(), 2, Partial" in plan


def test_argmax_smallest_value_on_ties(spark):
    df = spark.createDataFrame(
        [("g1", 5, 2), ("g1", 3, 2), ("g1", 9, 1), ("g2", 7, 1)], "guid string, userid long, cnt long"
    )
    assert rows(ranking.argmax_per_group(df, "guid", "userid", "cnt"), "guid", "userid") == [
        ("g1", 3), ("g2", 7),
    ]


def test_entropy(spark):
    df = spark.createDataFrame(
        [("d", 1, 1, 1.0), ("d", 1, 2, 1.0), ("d", 2, 3, 4.0)],
        "deviceid string, cityid int, regionid int, score double",
    )
    got = {r.cityid: (r.entropy, r.regions) for r in region.region_stats(df).collect()}
    assert got[1] == (pytest.approx(math.log(2)), 2)
    assert got[2] == (pytest.approx(0.0), 1)


def test_share_total_is_over_all_rows(spark):
    df = spark.createDataFrame([(1, "a", 6), (1, "b", 4), (2, "c", 5)], "city int, w string, n long")
    shared = groups.share_of_total(df, ["city"], "n", "s", 0.0, min_value=5)
    assert rows(shared, "w", "s") == [("a", 0.6), ("c", 1.0)]


def test_damping(spark):
    df = spark.createDataFrame([("x", 2.0), ("x", 4.0), ("y", 3.0)], "k string, s double")
    by_count = groups.divide_by_count(df, ["k"], "s", log10=True, eps=1e-6)
    got = dict(by_count.filter("k = 'y'").select("k", "s").collect())
    assert got["y"] == pytest.approx(3e6)  # log10(1) = 0
    by_sum = groups.divide_by_sum(df, ["k"], "s", eps=0.0)
    assert rows(by_sum, "k", "s") == [("x", 2 / 6), ("x", 4 / 6), ("y", 1.0)]


def test_normalising_does_not_change_the_centred_rating(spark):
    df = spark.createDataFrame(
        [(1, 1, 10, 20.0), (1, 1, 11, 40.0), (2, 1, 10, 30.0)],
        "userid long, cityid int, shopid long, score double",
    )
    direct = rows(ratings.centred(df), "userid", "shopid", "score")
    through = rows(ratings.centred(ratings.normalised(df)), "userid", "shopid", "score")
    assert [r[:2] for r in direct] == [r[:2] for r in through]
    assert [r[2] for r in direct] == pytest.approx([r[2] for r in through])
    assert direct[0][2] == pytest.approx(math.log(20 / 30 + 0.001) + 0.001)


def test_one_shared_shop_scores_zero(spark):
    df = spark.createDataFrame(
        [(1, 1, 10, 0.5), (2, 1, 10, 0.7), (3, 1, 11, 0.5), (2, 1, 11, 0.2), (3, 1, 12, 2.0),
         (2, 1, 12, 0.5)],
        "userid long, cityid int, shopid long, score double",
    )
    got = {(r.sid1, r.sid2): r.score for r in ratings.user_similarity(df, Params()).collect()}
    assert got[1, 2] == got[2, 1] == 0.0
    assert got[2, 3] == got[3, 2] == pytest.approx((0.1 + 1.0) * math.log(2))
    only = ratings.user_similarity(df, Params(), users=df.filter("userid = 3"))
    assert {(r.sid1, r.sid2) for r in only.collect()} == {(3, 2)}


def test_delta_has_new_and_changed_rows_only(spark):
    new = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "guid string, userid long")
    old = spark.createDataFrame([("a", 1), ("b", 9), ("d", 4)], "guid string, userid long")
    assert rows(joins.snapshot_delta(new, old, "guid", "userid"), "guid", "userid") == [
        ("b", 2), ("c", 3),
    ]


def test_exclude_and_restrict(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id int, v string")
    keys = spark.createDataFrame([(1,), (1,), (3,), (None,)], "id int")
    assert rows(joins.exclude(df, keys, ["id"]), "id") == [(2,)]
    assert rows(joins.restrict(df, keys, ["id"]), "id") == [(1,), (3,)]


def test_replace_groups_is_idempotent(spark):
    state = spark.createDataFrame([("d1", 1, 5, 0.1), ("d2", 1, 6, 0.2)], schemas.DEVICE_RECS)
    new = spark.createDataFrame([("d1", 1, 7, 0.9)], schemas.DEVICE_RECS)
    once = joins.replace_groups(state, new, ["deviceid", "cityid"])
    twice = joins.replace_groups(once, new, ["deviceid", "cityid"])
    expected = [("d1", 1, 7, 0.9), ("d2", 1, 6, 0.2)]
    assert rows(once, "*") == rows(twice, "*") == expected


def test_trend_and_canonical_name(spark):
    new = spark.createDataFrame([(1, "a", 0.5), (1, "b", 0.3)], "cityid int, keyword string, score double")
    old = spark.createDataFrame([(1, "a", 0.2), (1, "c", 0.3)], "cityid int, keyword string, score double")
    trend = joins.trend_delta(new, old, ["cityid", "keyword"], "score")
    assert rows(trend, "keyword", "score") == [("a", 0.3), ("b", 0.3)]
    names = spark.createDataFrame([(1, "a", "Shop")], "cityid int, keyword string, shopname string")
    named = joins.canonicalise(trend, names, ["cityid", "keyword"], "keyword", "shopname")
    assert rows(named, "keyword") == [("Shop",), ("b",)]


def test_expand_sums_over_sources(spark):
    scored = spark.createDataFrame([("d", 1, 2.0), ("d", 2, 1.0)], "d string, s long, w double")
    edges = spark.createDataFrame([(1, 9, 0.5), (2, 9, 3.0), (2, 8, 1.0)], "s long, t long, e double")
    hop = joins.expand(scored, edges, ["s"], ["d", "t"], F.col("w") * F.col("e"), "out")
    assert rows(hop, "t", "out") == [(8, 1.0), (9, 4.0)]


def test_state_counts_and_decay(spark):
    state = spark.createDataFrame([("g", 1, 2)], schemas.PAIR_COUNTS)
    batch = spark.createDataFrame([("g", 1, 3), ("g", 2, 1)], schemas.PAIR_COUNTS)
    total = merging.compact_counts(state, batch, ["guid", "userid"], "cnt", 1)
    assert rows(total, "guid", "userid", "cnt") == [("g", 1, 5)]
    recs = spark.createDataFrame([("d", 1, 1, 0.05), ("d", 1, 2, 1.0)], schemas.DEVICE_RECS)
    assert rows(merging.decay_state(recs, "rank", 0.7, 0.05), "shopid", "rank") == [(2, 0.7)]


def test_merge_min_lets_a_seen_row_win(spark):
    df = spark.createDataFrame([("d", 1, 1, 0.51239), ("d", 1, 1, -0.2)], schemas.DEVICE_RECS)
    assert rows(device_recs.merge_min(df), "rank") == [(-0.2,)]


def test_category_cap_keeps_the_best(spark):
    recs = spark.createDataFrame(
        [("d", 1, s, float(s)) for s in range(8)], schemas.DEVICE_RECS
    )
    shops = spark.createDataFrame([(s, 1 if s < 7 else 2) for s in range(8)], "shop_id long, cat1_id int")
    capped = device_recs.category_cap(recs, shops, Params())
    assert rows(capped, "shopid") == [(s,) for s in range(2, 8)]


def test_seen_rows_are_negated_once(spark):
    recs = spark.createDataFrame([("d", 1, 1, 2.0), ("d", 1, 2, 3.0)], schemas.DEVICE_RECS)
    visits = spark.createDataFrame([("d", 5, 1, 3), ("d", 6, 1, 3)], schemas.VISITS)
    both = device_recs.mark_seen(recs, visits)
    apart = device_recs.unseen(recs, visits).unionByName(device_recs.seen_negated(recs, visits))
    assert rows(both, "shopid", "rank") == rows(apart, "shopid", "rank") == [(1, -2.0), (2, 3.0)]


def test_visit_decay_truncates(spark):
    day = "2001-08-01"
    log = spark.createDataFrame(
        [("7", 7, 1, 100, day)] * 4 + [("7", 7, 2, 104, day)] * 2 + [("0", 1, 1, 100, day)] * 9
        + [(None, 1, 1, 100, day)] * 9 + [("8", 7, 3, 99, day)] * 9,
        "deviceid string, user_id long, shop_id long, hp_log_type int, day string",
    ).withColumn("hp_stat_time", F.col("day").cast("date"))
    got = rows(device_recs.decayed_visits(log, Params()), "deviceid", "shopid", "cnt")
    assert got == [("7", 1, int(4 / math.log(4)))]


@pytest.mark.parametrize("price, label", [
    (20, "<=20"), (21, "21-50"), (50, "21-50"), (51, "51-80"), (80, "51-80"), (81, "81-120"),
    (120, "81-120"), (121, "121-200"), (200, "121-200"), (201, ">200"), (-3, "<=20"),
])
def test_price_buckets(spark, price, label):
    df = spark.createDataFrame([(price,)], "p int")
    assert df.select(tags.price_bucket("p")).first()[0] == label


def test_slices_count_a_pair_once_each(spark):
    days = ["2001-01-01", "2001-01-02", "2001-02-01", "2001-02-02", "2001-05-02", "2001-07-09"]
    log = spark.createDataFrame(
        [(1, 5, 0, d) for d in days] + [(0, 5, 0, days[1]), (2, 5, 104, days[1])],
        "user_id long, shop_id long, hp_log_type int, day string",
    ).withColumn("hp_stat_time", F.col("day").cast("date"))
    got = tags.sliced_distinct_visits(log, Params().slice_bounds)
    assert rows(got, "userid", "shopid") == [(1, 5)] * 3


def test_tf_idf(spark):
    df = spark.createDataFrame(
        [("c", 1, "x", 1.0), ("c", 1, "y", 1.0), ("c", 2, "x", 1.0), ("a", 3, "x", 1.0)],
        "tagtype string, shopid long, tag string, score double",
    )
    got = rows(groups.tf_idf(df, "tagtype", "shopid", "tag", "score"), "shopid", "tag", "score")
    assert got == [(1, "x", 0.0), (1, "y", pytest.approx(math.log(2))), (2, "x", 0.0), (3, "x", 0.0)]


def test_packed_tags(spark):
    df = spark.createDataFrame([(1, "a:3, b:x,c,:4"), (2, None)], "id int, p string")
    assert rows(packed.explode_tags(df, "p", ["id"], "n"), "id", "tag", "n") == [
        (1, "a", 3.0), (1, "b", None), (1, "c", None),
    ]


def test_text_expressions(spark):
    df = spark.createDataFrame(
        [("Hot%20Pot ", "/Shop/42/photos"), ("%zz", "/search"), ("", None)], "k string, u string"
    )
    got = df.select(clean_keyword("k"), url_number("u", r"^/shop/([0-9]+)")).collect()
    assert [tuple(r) for r in got] == [("hot pot", 42), (None, None), ("", None)]
    words = spark.createDataFrame([("短い語",), ("a long ascii keyword",), ("とても長い検索の言葉",)], "k string")
    assert rows(words.filter(readable("k", 9)), "k") == [("a long ascii keyword",), ("短い語",)]


def test_clicks_need_a_matching_city(spark):
    cols = (
        "guid_str string, user_id long, city_id int, shop_id long, hp_log_type int, "
        "hp_stat_time string, path string, referer string"
    )
    ref = "/search/keyword/{}/0_tea"
    log = spark.createDataFrame([
        ("g1", 1, 3, 5, 0, "2001-01-01", "/shop/5", ref.format(3)),
        ("g2", 1, 3, 5, 0, "2001-01-01", "/shop/5", ref.format(4)),
        ("g3", 1, 3, 5, 0, "2001-01-01", "/shop/5/photos", ref.format(3)),
        ("g4", 1, 3, 5, 0, "2001-01-01", "/shop/5", ref.format(3) + "/p2"),
        ("g5", 1, 3, 5, 0, "2001-01-01", "/shop/5", ""),
        ("g6", 1, 0, 5, 0, "2001-01-01", "/shop/5", ref.format(0)),
        ("g7", 1, 3, 5, 2, "2001-01-01", "/shop/5", ref.format(3)),
    ], cols)
    assert rows(trending.search_clicks(log, Params()), "guid", "keyword") == [("g1", "tea")]


def test_kpis(spark):
    recs = spark.createDataFrame(
        [("d1", 1, 1, 0.1), ("d1", 1, 2, 0.1), ("d2", 1, 1, 0.1), ("d3", 1, 1, 0.1)],
        schemas.DEVICE_RECS,
    )
    shops = spark.createDataFrame([(1,), (2,), (3,), (4,)], "shop_id long")
    visits = spark.createDataFrame([("d1", 1), ("d1", 1), ("d9", 1)], "deviceid string, shopid long")
    assert rows(kpi.coverage(recs, shops, "x"), "value") == [(0.5,)]
    pop = kpi.popularity(recs)
    assert rows(pop, "shopid", "p") == [(1, 1.0), (2, pytest.approx(1 / 3))]
    assert kpi.popularity_entropy(pop, "x").first().value == pytest.approx(math.log(3) / 3)
    assert rows(kpi.hit_rate(recs, visits, "x"), "value") == [(0.25,)]


def test_hash_uniform_does_not_depend_on_partitioning(spark):
    df = spark.range(2000).select(F.col("id").alias("a"), (F.col("id") * 7).cast("string").alias("b"))
    u = hash_uniform("a", "b", salt="s")
    one = rows(df.repartition(1).select(u.alias("u")), "u")
    many = rows(df.repartition(13).select(u.alias("u")), "u")
    assert one == many
    assert 0.47 < sum(v for (v,) in one) / 2000 < 0.53
    assert all(0 <= v < 1 for (v,) in one)
    other = rows(df.select(hash_uniform("a", "b", salt="t").alias("u")), "u")
    assert one != other


def test_hop_without_jitter(spark):
    visits = spark.createDataFrame([("d", 5, 1, 9), ("d", 5, 2, 99)], schemas.VISITS)
    edges = spark.createDataFrame(
        [(1, 3, 0.5), (2, 3, 1.0), (2, 4, 0.1), (2, 9, 5.0)], "sid1 long, sid2 long, rank double"
    )
    shops = spark.createDataFrame([(3, 7), (4, 8)], "shop_id long, city_id int")
    hop = device_recs.expand_items(
        visits, F.log10(1 + F.col("cnt")), ["deviceid", "userid", "shopid"],
        device_recs.edges_to(edges, shops), 5, Params(hop_drop=0, hop_jitter=1.0), "x",
    )
    assert rows(hop, "cityid", "shopid", "rank") == [
        (7, 3, pytest.approx(0.5 * 1 + 1.0 * 2)), (8, 4, pytest.approx(0.2)),
    ]


def test_dislikes_and_boosts(spark):
    feedback = spark.createDataFrame(
        [("d", 1, 1, -5.0, "2024-01-02"), ("d", 1, 2, 3.0, "2024-01-01"), ("d", 1, 3, 60.0, "2024-01-01")],
        "deviceid string, cityid int, shopid long, score double, updatetime string",
    )
    edges = spark.createDataFrame([(1, 7, 0.5), (2, 8, 0.5)], "sid1 long, sid2 long, rank double")
    p = Params(dislike_drop=0)
    near = device_recs.expand_dislikes(feedback, edges, p)
    assert rows(near, "shopid", "dt") == [(7, "2024-01-02")]
    assert rows(device_recs.exclusions(near, feedback, p), "shopid") == [(1,), (2,), (7,)]
    recs = spark.createDataFrame([("d", 1, 1, 2.0)], schemas.DEVICE_RECS)
    promo = spark.createDataFrame([(1, math.e), (2, 5.0)], "shop_id long, score double")
    boosted = device_recs.with_promo_boost(recs, promo)
    other = spark.createDataFrame([("d", 1, 1, 0.5)], "deviceid string, cityid int, shopid long, score double")
    agreed = device_recs.with_agreement_boost(boosted, other, 5.0)
    assert rows(agreed, "rank") == [(2.0,), (2.0,), (15.0,), (15.0,)]


def test_excluded_totals_stay_above_the_aggregate(spark):
    df = spark.createDataFrame([(1, "a", 1.0), (1, "a", 2.0), (2, "b", 5.0)], "u int, k string, s double")
    total = df.groupBy("u", "k").agg(F.sum("s").alias("s"))
    gone = spark.createDataFrame([(2, "b"), (2, "b"), (3, "a")], "u int, k string")
    kept = joins.exclude_from_totals(total, gone, ["u", "k"])
    assert rows(kept, "u", "k", "s") == [(1, "a", 3.0)]
    assert "LeftAnti" not in kept._jdf.queryExecution().toString()
