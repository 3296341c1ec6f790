"""The pair operator against brute force, also for very uneven groups, and its plan."""

from __future__ import annotations

import math
import random
from collections import defaultdict
from datetime import date, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from footfall.operators import pairs as pairs_module
from footfall.operators.pairs import best_pairs, top_pairs
from footfall.sources.storage import materialise
from test_plans import executed, skew_settings  # noqa: F401

K = 3


def skewed_rows():
    """Items 0 and 1 are rated by everybody, user 7 rates everything, some rate an item twice."""
    rows = []
    for city in (1, 2):
        for user in range(60):
            for item in (0, 1, 2 + user % 5, 10 + user % 11):
                rows.append((city, item, user, ((user * 7 + item * 3 + city) % 13 - 5) / 4.0))
        for item in range(2, 60):
            rows.append((city, item, 7, (item % 5 - 1) / 2.0))
        rows += [(city, 0, 3, 0.75), (city, 4, 3, -0.25)]
    return rows


def brute(rows):
    by_group = defaultdict(list)
    for city, item, user, w in rows:
        by_group[city, item].append((user, w))
    total, n = defaultdict(float), defaultdict(int)
    for (city, _), members in by_group.items():
        for a, wa in members:
            for b, wb in members:
                if a != b:
                    total[city, a, b] += wa * wb
                    n[city, a, b] += 1
    per_a = defaultdict(list)
    for (city, a, b), t in total.items():
        score = t * math.log(n[city, a, b])
        per_a[city, a].append((-math.floor(score * 1e6 + 0.5), b, round(score, 6)))
    return {
        (city, a, b): s for (city, a), best in per_a.items() for _, b, s in sorted(best)[:K]
    }


def similar(df, group="item"):
    return top_pairs(
        df.withColumnRenamed("u", "sid1"), df.withColumnRenamed("u", "sid2"),
        part="cityid", group=[group], a="sid1", b="sid2",
        score=lambda total, n: total * F.log(n), k=K,
    )


def test_against_brute_force(spark):
    rows = skewed_rows()
    got = similar(spark.createDataFrame(rows, "cityid int, item long, u long, w double")).collect()
    result = {(r.cityid, r.sid1, r.sid2): round(r.score, 6) for r in got}
    assert len(result) == len(got)
    assert result == brute(rows)


def bounded(df, crowd, depth=4, k=K):
    return best_pairs(
        df.withColumnRenamed("u", "sid1"), df.withColumnRenamed("u", "sid2"), part="cityid", group=["item"],
        a="sid1", b="sid2", growth=F.log, k=k, cut=materialise, crowd=crowd, depth=depth,
    )


def random_rows(rng, weight):
    """Two crowded items per city, light ones, members of one row only, some rows twice."""
    rows = []
    for city in (1, 2):
        for user in range(70):
            for item in [i for i in (0, 1) if rng.random() < 0.8] + rng.sample(range(2, 40), rng.randrange(0, 3)):
                rows += [(city, item, user, weight(rng))] * (2 if rng.random() < 0.03 else 1)
    return rows


@pytest.mark.parametrize("crowd, depth, kind", [
    (20, 1, "signed"), (20, 1, "few values"), (20, 4, "zero"), (5, 2, "same"), (5, 2, "negative"), (1, 1, "signed"),
])
def test_bounds_lose_nothing(spark, kind, crowd, depth):
    weight = {
        "signed": lambda r: r.gauss(0, 1), "few values": lambda r: r.choice([-0.5, 0.25, 0.75]), "zero": lambda r: 0.0,
        "same": lambda r: 0.5, "negative": lambda r: -r.random(),
    }[kind]
    rows = random_rows(random.Random(crowd + depth), weight)
    got = bounded(spark.createDataFrame(rows, "cityid int, item long, u long, w double"), crowd, depth).collect()
    result = {(r.cityid, r.sid1, r.sid2): round(r.score, 6) + 0.0 for r in got}
    assert len(result) == len(got) and result == {p: s + 0.0 for p, s in brute(rows).items()}


def test_few_pairs_of_crowded_items_are_made(spark, monkeypatch):
    """Two items that nearly everybody rates: under a tenth of their pair rows are made, for the result of
    all pairs."""
    n, rng = 2000, np.random.default_rng(5)
    weights = np.where(rng.random((n, 2)) < 0.9, rng.normal(size=(n, 2)), 0)
    rows = [(1, item, user, float(weights[user, item])) for user in range(n) for item in (0, 1) if weights[user, item]]
    made, plain = [], pairs_module._totals

    def totals(joined, pair):
        made.append(joined.count())
        return plain(joined, pair)

    monkeypatch.setattr(pairs_module, "_totals", totals)
    got = {(r.sid1, r.sid2): r.score for r in bounded(spark.createDataFrame(rows, "cityid int, item long, u long, w double"), 100).collect()}
    rated = (weights != 0).astype(int)
    assert sum(made) < (rated.sum(0) * (rated.sum(0) - 1)).sum() / 10
    shared = rated @ rated.T
    scores = np.where(shared > 0, (weights @ weights.T) * np.log(np.maximum(shared, 1)), -np.inf)
    np.fill_diagonal(scores, -np.inf)
    for user in np.flatnonzero(rated.any(1)):
        keys = np.floor(scores[user] * 1e6 + 0.5)
        best = sorted(np.flatnonzero(scores[user] > -np.inf), key=lambda v: (-keys[v], v))[:K]
        assert [got.get((user, v)) for v in best] == pytest.approx([scores[user][v] for v in best], abs=1e-6)
    assert len(got) == K * rated.any(1).sum()


def test_text_members_and_two_group_columns(spark):
    left = [("c", u, d, f"k{(u * d) % 9}", 1.0) for u in range(12) for d in range(6)]
    df = spark.createDataFrame(left, "part string, u long, d long, k string, w double")

    def pairs(frame):
        out = top_pairs(
            frame.withColumnRenamed("k", "x"), frame.withColumnRenamed("k", "y"),
            part="part", group=["u", "d"], a="x", b="y",
            score=lambda total, n: F.log10(n + 10), k=100,
        )
        return {(r.x, r.y): round(r.score, 9) for r in out.collect()}

    assert pairs(df) == {}  # one keyword per (user, day): no pair at all
    n = defaultdict(int)
    for _, u1, d1, k1, _ in left:
        for _, u2, d2, k2, _ in left:
            if u1 == u2 and d1 % 2 == d2 % 2 and k1 != k2:
                n[k1, k2] += 1
    assert pairs(df.withColumn("d", df.d % 2)) == {p: round(math.log10(c + 10), 9) for p, c in n.items()}


@pytest.mark.parametrize("within", [0, 1, 7, 30])
def test_days_within_an_interval(spark, within):
    rng = random.Random(within)
    rows = [("c", rng.randrange(4), date(2001, 1, 1) + timedelta(rng.randrange(-60, 60)), f"k{rng.randrange(8)}", 1.0) for _ in range(150)]
    df = spark.createDataFrame(rows, "part string, u long, dt date, k string, w double")
    copies = df.withColumnRenamed("k", "x"), df.withColumnRenamed("k", "y")
    out = top_pairs(*copies, part="part", group=["u"], a="x", b="y", score=lambda total, n: 1.0 * n, k=100, day="dt", within=within)
    n = defaultdict(int)
    for _, u1, d1, k1, _ in rows:
        for _, u2, d2, k2, _ in rows:
            if u1 == u2 and k1 != k2 and 0 <= (d2 - d1).days <= within:
                n[k1, k2] += 1
    assert {(r.x, r.y): int(r.score) for r in out.collect()} == n
    if within:  # two copies of a row at every width
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("explode(array(") == 1 and "explode(sequence" not in plan


def test_an_item_with_a_third_of_all_rows_is_split(spark, skew_settings, tmp_path):  # noqa: F811
    """Text item keys and unsorted weights, so that the hot partition stands out in bytes."""
    hot = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("i"), (F.col("id") % 4000).cast("string")))
    rows = spark.range(6000).select(F.lit(1).alias("cityid"), hot.alias("item"), F.col("id").alias("u"), F.rand(1).alias("w"))
    rows.write.parquet(str(tmp_path / "r"))
    spark.conf.set("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "10k")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "10k")
    plan = executed(similar(spark.read.parquet(str(tmp_path / "r"))))
    assert "skew=true" in plan and "Python" not in plan
