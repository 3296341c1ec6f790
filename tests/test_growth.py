"""What keeps tasks and shuffles small on larger tables."""

from __future__ import annotations

import math
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from footfall import session
from footfall.job import Job
from footfall.operators import joins
from footfall.operators.pairs import best_pairs
from footfall.params import Params
from footfall.plans import device_recs, keywords, ratings, region
from footfall.sources.storage import materialise
from footfall.sources.warehouse import Warehouse

SF_DIR = "/root/testdata/sf0.001"


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def rated(spark):
    """Some rate an item twice or in two cities; scores on both sides of the floor; nulls."""
    rng = random.Random(3)
    rows = [(rng.randrange(25), rng.randrange(3), rng.randrange(12), rng.choice([-0.5, 0.05, 0.2, 0.9])) for _ in range(500)]
    rows += [(None, 1, 2, 0.5), (1, None, 2, 0.5), (1, 1, None, 0.5), (2, 1, None, 0.5)]
    return spark.createDataFrame(rows, "userid long, cityid int, shopid long, score double"), rows


def test_recommendations_are_shuffled_once(spark):
    p = Params(cf_drop=0, similar_k=4, cf_k=6)
    frame, rows = rated(spark)
    similar = [(c, a, b, float((a * 7 + b) % 5)) for c in range(3) for a in range(25) for b in range(25) if a != b and (a + b) % 6 == 0]
    similar_df = spark.createDataFrame(similar, "cityid int, sid1 long, sid2 long, score double")
    df = ratings.recommend(similar_df, materialise(ratings.members(frame, p), "members"), p)
    got = {(r.userid, r.cityid, r.shopid): r.score for r in df.collect()}
    liked, known, total = defaultdict(float), {(u, s) for u, _, s, _ in rows if s is not None}, defaultdict(float)
    for u, c, s, score in rows:
        if score > p.rating_floor:
            liked[c, u, s] += score
    for c, a, b, score in similar:
        for (city, user, s), r in liked.items():
            if city == c and user == b and (a, s) not in known:
                total[a, c, s] += score * r
    best = defaultdict(list)
    for (a, c, s), x in total.items():
        best[a, c].append((-math.floor(x * 1e6 + 0.5), s is not None, s or 0, s, x))
    want = {(a, c, s): x for (a, c), found in best.items() for *_, s, x in sorted(found)[:p.cf_k]}
    assert got == {k: pytest.approx(x) for k, x in want.items()}
    exchanges = [line for line in plan_of(df).split("== Initial Plan ==")[0].split("\n") if "Exchange hashpartitioning(userid" in line]
    assert sum("REPARTITION_BY_COL" in line for line in exchanges) == 1
    assert not any("shopid" in line.split("hashpartitioning")[1].split(")")[0] for line in exchanges)


@pytest.mark.parametrize("users", [None, [3, 4, 99]])
def test_ratings_and_their_sums_give_the_same_pairs(spark, users):
    frame, _ = rated(spark)
    only = None if users is None else spark.createDataFrame([(u,) for u in users * 2], "userid long")
    p = Params()
    by_rows, by_sums = (
        {(r.cityid, r.sid1, r.sid2): r.score for r in ratings.user_similarity(x, p, users=only).collect()}
        for x in (frame, ratings.members(frame, p))
    )
    w = defaultdict(list)
    for u, c, s, x in frame.collect():
        if None not in (u, c, s):
            w[c, s].append((u, x))
    total, n = defaultdict(float), defaultdict(int)
    for (c, _), found in w.items():
        for a, x in found:
            for b, y in found:
                if a != b and (users is None or a in users):
                    total[c, a, b] += x * y
                    n[c, a, b] += 1
    assert by_rows == by_sums == {k: pytest.approx(t * math.log(n[k]), abs=1e-9) for k, t in total.items()}


def test_sums_of_centred_ratings_need_no_other_shuffle(spark):
    frame, _ = rated(spark)
    frame = frame.withColumn("score", F.abs("score"))
    p = Params()
    summed = ratings.centred_members(frame, p)
    def key(r):
        return str((r.userid, r.cityid, r.shopid))

    plain = {key(r): (r.w, r.c, r.good) for r in ratings.members(ratings.centred(frame), p).collect()}
    got = {key(r): (r.w, r.c, r.good) for r in summed.collect()}
    assert got.keys() == plain.keys()
    for k, (w, c, good) in plain.items():
        assert got[k] == (pytest.approx(w), c, good if good is None else pytest.approx(good))
    assert "shopid" not in " ".join(x.split(")")[0] for x in plan_of(summed).split("Exchange hashpartitioning(")[1:])


def test_keyword_hops_are_dealt_to_tasks_by_their_size(spark):
    profile = spark.createDataFrame([(u, u % 5, f"k{u % 7}", 1.0) for u in range(400)], "userid long, cityid int, keyword string, weight double")
    edges = spark.createDataFrame([(c, f"k{a}", f"k{b}", 0.5) for c in range(5) for a in range(7) for b in range(7) if a != b], "cityid int, sid1 string, sid2 string, score double")
    p = Params(hop_rows=50_000)
    tasks = keywords.hop_tasks(profile, p)
    assert tasks == 1 + 400 * p.keyword_k * p.edge_keep // 50_000 and keywords.hop_tasks(profile, Params()) == 1
    dealt, plain = (keywords.expand_keywords(profile, "weight", edges, p, "x", t) for t in (tasks, None))
    assert dealt.rdd.getNumPartitions() == tasks
    assert sorted(dealt.collect()) == sorted(plain.collect()) and dealt.count() == 400 * 6


def test_partitions_before_coalescing_follow_the_input(spark, tmp_path):
    before = spark.conf.get(session.INITIAL, None), spark.conf.get(session.ADVISED)
    (tmp_path / "lineitem.parquet").write_bytes(b"x" * (50 * session.INPUT_PER_PARTITION))
    try:
        session.tune(spark, str(tmp_path))
        assert int(spark.conf.get(session.INITIAL)) == 50
        session.tune(spark, SF_DIR)
        assert spark.conf.get(session.INITIAL) == spark.conf.get("spark.sql.shuffle.partitions")
        spark.conf.set(session.ADVISED, "100k")  # smaller than ours: stays
        session.tune(spark)
        assert spark.conf.get(session.ADVISED) == "100k"
    finally:
        spark.conf.unset(session.INITIAL)
        if before[0] is not None:
            spark.conf.set(session.INITIAL, before[0])
        spark.conf.set(session.ADVISED, before[1])


def test_the_cities_of_shops_are_read_from_a_table_of_their_size(spark):
    made = []
    warehouse = Warehouse(spark, SF_DIR, "2001-08-02", lambda df, name: made.append(name) or df)
    for log in (warehouse.traffic("city_id"), warehouse.reviews(), warehouse.feedback()):
        assert log.columns
    assert made == ["shop-city"]


def test_decayed_state_is_derived_once(spark):
    with Job(spark, SF_DIR) as job:
        assert "lineitem.parquet" not in plan_of(job.state_replace_groups)


def test_a_chain_joins_the_log_to_its_orders_once(spark):
    made = []

    class Noting(Job):
        def _cut(self, df, name):
            made.append((name, plan_of(df)))
            return super()._cut(df, name)

    with Noting(spark, SF_DIR) as job:
        job.rec_category_cap  # noqa: B018
    names = [name for name, _ in made]
    assert names.count("log") == 1 and not {"rated", "app-visits", "affinity"} & set(names)
    assert [name for name, plan in made if "orders.parquet" in plan] == ["log"]


def test_views_of_the_stored_log_are_those_of_the_tables(spark):
    def rows(warehouse):
        views = (
            warehouse.traffic("deviceid", "shop_id", "hp_stat_time", since="1997-01-01"),
            warehouse.traffic("path", periods=("1998-01-01", "1994-01-01")),
            warehouse.reviews(), warehouse.accumulated_recs("1998-01-01"),
        )
        return [sorted(map(str, view.collect())) for view in views]

    plain, stored = Warehouse(spark, SF_DIR, "2001-08-02"), Warehouse(spark, SF_DIR, "2001-08-02")
    stored.store_log()
    assert rows(plain) == rows(stored)


def test_lines_below_the_floor_do_not_change_strong_rows(spark):
    warehouse = Warehouse(spark, SF_DIR, "2001-08-02")
    whole = warehouse.accumulated_recs("1998-01-01").filter("rank > 0.05")
    strong = warehouse.accumulated_recs("1998-01-01", above=0.05)
    assert sorted(map(str, strong.collect())) == sorted(map(str, whole.collect())) != []


@pytest.mark.parametrize("cf_k", [3, 500])
def test_wanted_rows_are_picked_after_the_ranking(spark, cf_k):
    p = Params(cf_drop=0, similar_k=4, cf_k=cf_k)
    frame, _ = rated(spark)
    similar = spark.createDataFrame(
        [(c, a, b, float((a * 7 + b) % 5)) for c in range(3) for a in range(25) for b in range(25) if a != b and (a + b) % 6 == 0],
        "cityid int, sid1 long, sid2 long, score double",
    )
    summed = materialise(ratings.members(frame, p), "members")
    asked = [(u, c, s) for u in range(30) for c in range(3) for s in range(12) if (u + c + s) % 2] * 2 + [(1, None, 2), (None, 1, 2), (1, 1, None)]
    wanted = spark.createDataFrame(asked, "userid long, cityid int, shopid long")
    whole = {tuple(r)[:3]: r.score for r in ratings.recommend(similar, summed, p).collect()}
    got = {tuple(r)[:3]: r.score for r in ratings.recommend(similar, summed, p, wanted).collect()}
    assert got == {k: pytest.approx(v) for k, v in whole.items() if k in set(asked)} and 0 < len(got) < len(whole)


def test_marked_users_are_those_given(spark):
    frame, _ = rated(spark)
    frame = frame.withColumn("score", F.abs("score") + 1)
    users = spark.createDataFrame([(3,), (4,), (4,), (99,), (None,)], "userid long")
    p = Params(cf_drop=0)
    plain, marked = ratings.centred_members(frame, p), materialise(ratings.centred_members(frame, p, users), "marked")
    assert sorted(map(str, marked.drop("mine").collect())) == sorted(map(str, plain.select(marked.drop("mine").columns).collect()))
    a, b = ratings.user_similarity(plain, p, users=users), ratings.user_similarity(marked, p)
    as_rows = [{(r.cityid, r.sid1, r.sid2): pytest.approx(r.score) for r in x.collect()} for x in (a, b)]
    assert as_rows[0] == as_rows[1] and {k[1] for k in as_rows[0]} == {3, 4}
    x, y = (ratings.recommend(s, m, p).collect() for s, m in ((a, plain), (b, marked)))
    assert sorted((r.userid, r.cityid, str(r.shopid), round(r.score, 6)) for r in x) == sorted((r.userid, r.cityid, str(r.shopid), round(r.score, 6)) for r in y)


@pytest.mark.parametrize("many", [0, 6, 10_000])
def test_pairs_are_dealt_out_once(spark, many):
    frame, _ = rated(spark)
    rows = ratings.members(frame, Params()).select("cityid", F.col("shopid").alias("item"), F.col("userid").alias("sid2"), "w", "c")
    df = best_pairs(None, rows, part="cityid", group=["item"], a="sid1", b="sid2", growth=F.log, k=4, cut=materialise, many=many)
    total, n, best = defaultdict(float), defaultdict(int), defaultdict(list)
    found = [r for r in rows.collect() if None not in (r.cityid, r.item, r.sid2)]
    for x in found:
        for y in found:
            if (x.cityid, x.item) == (y.cityid, y.item) and x.sid2 != y.sid2:
                total[x.cityid, x.sid2, y.sid2] += x.w * y.w
                n[x.cityid, x.sid2, y.sid2] += x.c * y.c
    for (c, a, b), t in total.items():
        best[c, a].append((-math.floor(t * math.log(n[c, a, b]) * 1e6 + 0.5), b, t * math.log(n[c, a, b])))
    want = {(c, a, b): s for (c, a), x in best.items() for _, b, s in sorted(x)[:4]}
    assert {(r.cityid, r.sid1, r.sid2): r.score for r in df.collect()} == {k: pytest.approx(v, abs=1e-9) for k, v in want.items()}
    shuffles = [line.split("hashpartitioning(")[1] for line in plan_of(df).split("\n") if "Exchange hashpartitioning(" in line]
    by_pair = [line for line in shuffles if ", b#" in line]
    assert by_pair if many < 10_000 else not by_pair


def test_regions_of_a_device_need_no_other_shuffle(spark):
    rows = [("d1", 1, 1, 2.0), ("d1", 1, 2, 3.0), ("d1", 2, 1, 1.0), ("d2", None, 1, 1.0), (None, 1, 1, 1.0)]
    frame = spark.createDataFrame(rows, "deviceid string, cityid int, regionid int, score double").repartition("deviceid")
    df = region.breadth(region.concentration(frame))
    entropy = -(0.4 * math.log(0.4) + 0.6 * math.log(0.6))
    want = {("d1", 1, 1): math.log(3) / (entropy + 1) * math.log(3), ("d1", 1, 2): math.log(4) / (entropy + 1) * math.log(3), ("d1", 2, 1): math.log(2) ** 2}
    assert {(r.deviceid, r.cityid, r.regionid): r.score for r in df.collect()} == {k: pytest.approx(v) for k, v in want.items()}
    assert plan_of(df).split("== Initial Plan ==")[0].count("Exchange hashpartitioning(") == 1


def test_the_cap_per_category_needs_no_other_shuffle(spark):
    recs = spark.createDataFrame([("d1", 1, s, 1.0 / (s + 1)) for s in range(30)] * 2, "deviceid string, cityid int, shopid long, rank double")
    shops = spark.createDataFrame([(s, s % 3) for s in range(30)], "shop_id long, cat1_id int")
    df = device_recs.category_cap(device_recs.merge_min(recs), F.broadcast(shops), Params(category_cap=2))
    assert sorted(r.shopid for r in df.collect()) == [0, 1, 2, 3, 4, 5]
    assert plan_of(df).split("== Initial Plan ==")[0].count("Exchange hashpartitioning(") == 1


def test_the_key_that_makes_spark_shuffle_is_small(spark):
    keys = spark.range(100).select(joins.extra_key(["id"]).alias("h"))
    assert {r.h for r in keys.collect()} == {0, 1} and keys.schema["h"].dataType.simpleString() == "tinyint"


def test_users_are_compared_in_the_cities_they_are_asked_in(spark):
    frame, _ = rated(spark)
    frame = frame.withColumn("score", F.abs("score") + 1)
    asked = [(3, 0), (3, 2), (4, 1), (4, 1), (99, 1), (None, 1), (5, None)]
    users = spark.createDataFrame(asked, "userid long, cityid int")
    p = Params(cf_drop=0)
    plain, marked = ratings.centred_members(frame, p), materialise(ratings.centred_members(frame, p, users), "asked")
    assert sorted(map(str, marked.drop("mine", "asked").collect())) == sorted(map(str, plain.collect()))
    assert {(r.userid, r.cityid) for r in marked.filter("asked").collect()} == {(3, 0), (3, 2), (4, 1)}
    assert {r.userid for r in marked.filter("mine").collect()} == {3, 4}
    whole = {(r.cityid, r.sid1, r.sid2): r.score for r in ratings.user_similarity(plain, p).collect()}
    similar = ratings.user_similarity(marked, p)
    got = {(r.cityid, r.sid1, r.sid2): r.score for r in similar.collect()}
    assert got == {k: pytest.approx(v) for k, v in whole.items() if (k[1], k[0]) in asked} and got
    wanted = spark.createDataFrame([(u, c, s) for u, c in {(3, 0), (3, 2), (4, 1)} for s in range(12)], "userid long, cityid int, shopid long")
    all_recs = {tuple(r)[:3]: r.score for r in ratings.recommend(ratings.user_similarity(plain, p), plain, p).collect()}
    recs = {tuple(r)[:3]: r.score for r in ratings.recommend(similar, marked, p, wanted).collect()}
    assert recs == {k: pytest.approx(v) for k, v in all_recs.items() if k[:2] in asked and k[2] is not None}


def test_ratings_of_a_user_are_shuffled_once(spark):
    frame, _ = rated(spark)
    users = spark.createDataFrame([(3, 0)], "userid long, cityid int")
    for df in (ratings.centred_members(frame, Params()), ratings.centred_members(frame, Params(), F.broadcast(users))):
        shuffles = [line for line in plan_of(df).split("\n") if "Exchange hashpartitioning(userid" in line and "cityid" not in line]
        others = [line for line in plan_of(df).split("\n") if "Exchange hashpartitioning(userid" in line and "shopid" in line]
        assert len(shuffles) == 1 and not others


def test_only_active_devices_are_shuffled(spark):
    with Job(spark, SF_DIR) as job:
        def rows(df):
            return sorted(str([round(x, 9) if isinstance(x, float) else x for x in r]) for r in df.collect())

        def semi_join_first(df):
            lines = plan_of(df).split("== Initial Plan ==")[0].split("\n")
            totals = [i for i, line in enumerate(lines) if "HashAggregate(keys=[deviceid" in line and "userid" in line]
            return min(i for i, line in enumerate(lines) if "LeftSemi" in line) > max(totals)

        all_visits = joins.restrict(job.visits_decayed_topk, job._active, ["deviceid"])
        assert rows(job.visits_of_active) == rows(all_visits) != []
        assert semi_join_first(job.visits_of_active)
        carried, of_all = job.state_carry_over, device_recs.carry_over(job._decayed, job._top200, job.p)
        assert rows(carried) == rows(of_all) != []
        by_region = device_recs.region_recs(job._top200, job.device_region_breadth, job.region_trend, job.p)
        assert rows(job.rec_by_region) == rows(by_region) != []


def test_lines_of_other_devices_do_not_reach_the_state(spark):
    warehouse = Warehouse(spark, SF_DIR, "2001-08-02")
    whole = warehouse.accumulated_recs("1998-01-01", above=0.05)
    devices = whole.select("deviceid").distinct().orderBy("deviceid").limit(9)
    some = warehouse.accumulated_recs("1998-01-01", above=0.05, devices=materialise(devices, "devices"))
    assert sorted(map(str, some.collect())) == sorted(map(str, joins.restrict(whole, devices, ["deviceid"]).collect())) != []
    assert some.count() < whole.count()
