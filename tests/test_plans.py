"""What the physical plans must look like."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from footfall.job import Job
from footfall.operators import groups, joins

SF_DIR = "/root/testdata/sf0.01"


def executed(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def skew_settings(spark):
    changed = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "32",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100k",
    }
    before = {k: spark.conf.get(k) for k in changed}
    for k, v in changed.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.fixture()
def hot_rows(spark, tmp_path):
    hot = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 5000).alias("k")
    path = str(tmp_path / "hot")
    spark.range(600000).select(hot, F.xxhash64("id").alias("v")).write.parquet(path)
    return spark.read.parquet(path)


def test_hot_keys_are_split(skew_settings, hot_rows):
    counted = groups.with_group_stats(hot_rows, ["k"], n=F.count(F.lit(1)))
    assert "skew=true" in executed(counted.agg(F.max(F.col("v") + F.col("n"))))
    keys = hot_rows.filter("k % 5 = 2")
    kept = joins.restrict(hot_rows, keys, ["k"])
    assert "skew=true" in executed(kept.agg(F.max("v")))
    left = joins.exclude(hot_rows, keys.filter("k > 7"), ["k"])
    assert "skew=true" in executed(left.agg(F.max("v"), F.max("k")))


def test_date_window_and_columns_reach_the_scan(spark):
    plan = Job(spark, SF_DIR).visits_active._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(o_orderdate,2001-05-01" in plan
    assert "p_name" not in plan and "l_quantity" not in plan


@pytest.mark.parametrize("step, k", [
    ("rec_hop1", 500), ("rec_top200", 200), ("tag_region", 10), ("tag_price_bucket", 20),
    ("keyword_trend_top25", 25), ("visits_decayed_topk", 30),
])
def test_top_k_is_cut_before_the_shuffle(spark, step, k):
    plan = getattr(Job(spark, SF_DIR), step)._jdf.queryExecution().executedPlan().toString()
    assert f"row_number(), {k}, Partial" in plan


@pytest.mark.parametrize("step", [
    "identity_delta", "device_region_breadth", "region_trend", "kpi_popularity", "tag_union",
    "keyword_trend", "shopname_rec_top5", "dish_mentions", "state_carry_over",
])
def test_no_cross_join_and_no_python(spark, step):
    plan = getattr(Job(spark, SF_DIR), step)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "Python" not in plan and "MapInPandas" not in plan


def scans(df, table: str) -> int:
    return df._jdf.queryExecution().executedPlan().toString().count(f"/{table}.parquet")


@pytest.mark.parametrize("step, table, most", [
    ("ratings_normalised", "lineitem", 0), ("ratings_centred", "lineitem", 0),
    ("visits_of_active", "lineitem", 1), ("rec_hop1", "lineitem", 0), ("rec_exclude_disliked", "lineitem", 0),
    ("region_trend", "lineitem", 0), ("keyword_trend", "lineitem", 0), ("tag_union", "lineitem", 0),
    ("keyword_hot_top15", "lineitem", 0), ("rec_top50", "lineitem", 1),
])
def test_the_log_is_read_once(spark, step, table, most):
    """0: what the step reads of the log was written once, by one job before it."""
    with Job(spark, SF_DIR) as job:
        assert scans(getattr(job, step), table) <= most


@pytest.mark.parametrize("step", ["dish_mentions", "reviews_of_tagged_shops"])
def test_texts_are_shuffled_once(spark, step):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = getattr(Job(spark, SF_DIR), step)._jdf.queryExecution().executedPlan()
        lines = plan.toString().split("\n")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    depth = [line.find("Exchange") for line in lines]
    carriers = 0
    for k, at in enumerate(depth):  # an exchange carries what the node below it puts out
        if at >= 0 and "reviewbody" in " ".join(lines[k + 1:k + 2]):
            carriers += 1
    assert carriers == 1


def test_a_job_leaves_the_session_settings_alone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        Job(spark, SF_DIR)
        assert spark.conf.get("spark.sql.session.timeZone") == "Asia/Tokyo"
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
