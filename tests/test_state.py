"""Days that are committed whole, and counts per day."""

from __future__ import annotations

import os
from collections import Counter
from datetime import date

import pytest
from pyspark.sql import functions as F

from footfall import schemas
from footfall.job import SCHEMAS
from footfall.sources import state
from footfall.sources.state import DailyCounts, StateStore, shifted

SCHEMA = schemas.KEYWORD_SCORES
COUNTS = schemas._schema(k=schemas._str, n=schemas._long, dt=schemas.T.DateType())


def rows(spark, schema, mark):
    """One row with ``mark`` in the last column that can hold it."""
    kinds = {"string": str(mark), "bigint": mark, "int": mark, "double": float(mark)}
    return spark.createDataFrame([tuple(kinds[f.dataType.simpleString()] for f in schema)], schema)


def tables(spark, mark, broken=None):
    def table(k, schema):
        def make():
            if k == broken:
                raise RuntimeError("executor lost")
            return rows(spark, schema, mark)
        return make

    return {name: table(k, schema) for k, (name, schema) in enumerate(SCHEMAS.items())}


@pytest.mark.parametrize("broken", range(len(SCHEMAS) + 1))
def test_a_run_that_dies_at_any_table_is_read_by_nobody(spark, tmp_path, monkeypatch, broken):
    store = StateStore(spark, str(tmp_path), SCHEMAS)
    store.publish("2001-01-01", tables(spark, 1))
    if broken == len(SCHEMAS):  # all tables are there, the entry is not

        def path(self, table, day, plain=StateStore.path):
            if table == state.DAYS and day.dt == "2001-01-02":
                raise RuntimeError("driver lost")
            return plain(self, table, day)

        monkeypatch.setattr(StateStore, "path", path)
    with pytest.raises(RuntimeError):
        store.publish("2001-01-02", tables(spark, 2, broken))
    monkeypatch.undo()
    later = StateStore(spark, str(tmp_path), SCHEMAS)
    assert [d.dt for d in later.days()] == ["2001-01-01"]
    before = later.before("2001-01-03")
    for name, schema in SCHEMAS.items():
        assert before.read(name).collect() == rows(spark, schema, 1).collect()
        assert {r.dt for r in later.history(name).collect()} == {"2001-01-01"}
    later.publish("2001-01-02", tables(spark, 3))  # the day again
    assert later.before("2001-01-03").read("main-user").first() == rows(spark, schemas.MAIN_USER, 3).first()


def test_an_entry_without_the_end_marker_does_not_count(spark, tmp_path):
    store = StateStore(spark, str(tmp_path), {"t": SCHEMA})
    store.publish("2001-01-01", {"t": lambda: rows(spark, SCHEMA, 1)})
    os.makedirs(tmp_path / "_days" / "dt=2001-01-02" / "run=9" / "_temporary")
    assert store.before("2001-01-03").dt == "2001-01-01"
    assert store.before("2001-01-01") is None


def test_the_last_run_of_a_day_counts_and_open_readers_go_on(spark, tmp_path):
    store = StateStore(spark, str(tmp_path), {"t": SCHEMA})
    first = store.publish("2001-01-01", {"t": lambda: rows(spark, SCHEMA, 1)})
    reader = first.read("t")
    # a day may read the run of the same day that it replaces
    store.publish("2001-01-01", {"t": lambda: first.read("t").withColumn("cityid", F.lit(2))})
    assert reader.first().cityid == 1
    assert [r.cityid for r in store.history("t").collect()] == [2]


def test_nothing_stored(spark, tmp_path):
    store = StateStore(spark, str(tmp_path / "none"), {"t": SCHEMA})
    assert store.days() == [] and store.before("2001-01-01") is None
    assert store.history("t").isEmpty() and store.history("t").columns == [*SCHEMA.names, "dt"]


def many_days(spark, root, n):
    days = [shifted("2001-01-01", k) for k in range(n)]
    data = spark.createDataFrame([(1, "tea", float(k), d, "r") for k, d in enumerate(days)], "cityid int, keyword string, score double, dt string, run string")
    data.write.partitionBy("dt", "run").parquet(f"{root}/t")
    for d in days:
        os.makedirs(f"{root}/_days/dt={d}/run=r")
        open(f"{root}/_days/dt={d}/run=r/_SUCCESS", "w").close()
    return StateStore(spark, root, {"t": SCHEMA})


def test_the_history_is_one_scan_at_any_number_of_days(spark, tmp_path):
    plans = []
    for n in (3, 400):
        store = many_days(spark, str(tmp_path / str(n)), n)
        history = store.history("t")
        assert history.count() == n
        plan = history._jdf.queryExecution().optimizedPlan()
        plans.append(len(plan.toString().split("\n")))
    assert plans[0] == plans[1]
    one = history.filter(F.col("dt") == "2001-03-01")
    assert one.count() == 1
    assert "PartitionFilters: [isnotnull(dt" in one._jdf.queryExecution().executedPlan().toString()


def test_expired_days_are_gone(spark, tmp_path):
    store = many_days(spark, str(tmp_path), 5)
    store.expire("2001-01-04")
    assert [d.dt for d in store.days()] == ["2001-01-04", "2001-01-05"]
    assert sorted(os.listdir(tmp_path / "t"))[:1] != ["dt=2001-01-01"] and store.history("t").count() == 2


def test_missing_days_against_brute_force(spark, tmp_path):
    counts, covered = DailyCounts(spark, str(tmp_path)), set()
    for k, (a, b) in enumerate([(5, 8), (12, 12), (7, 10), (20, 22)]):
        os.makedirs(tmp_path / "x" / "_covered", exist_ok=True)
        open(tmp_path / "x" / "_covered" / f"{shifted('2001-01-01', a)}_{shifted('2001-01-01', b)}", "w").close()
        covered |= set(range(a, b + 1))
        for first in range(0, 25, 2):
            for last in range(first - 1, 25):
                gaps = counts.missing("x", shifted("2001-01-01", first), shifted("2001-01-01", last))
                days = [d for g in gaps for d in range(date.fromisoformat(g[0]).toordinal(), date.fromisoformat(g[1]).toordinal() + 1)]
                start = date(2001, 1, 1).toordinal()
                assert [d - start for d in days] == [d for d in range(first, last + 1) if d not in covered]


def test_counts_of_days_add_up_and_unfinished_writes_do_not_stay(spark, tmp_path, monkeypatch):
    events = [("a", 1, date(2001, 1, d)) for d in (1, 1, 2, 4)] + [("b", 1, date(2001, 1, 2)), ("b", 1, None)]
    frame = spark.createDataFrame(events, COUNTS)
    per_day = frame.groupBy("k", "dt").agg(F.sum("n").alias("n"))
    counts = DailyCounts(spark, str(tmp_path))
    with monkeypatch.context() as m:
        m.setattr(state, "hadoop_path", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):  # after the data, before the mark
            counts.write("x", per_day.withColumn("n", F.lit(99).cast("bigint")), "2001-01-01", "2001-01-02")
    assert counts.missing("x", "2001-01-01", "2001-01-02") == [("2001-01-01", "2001-01-02")]
    counts.write("x", per_day.filter("dt <= '2001-01-02'"), "2001-01-01", "2001-01-02")
    counts.write("x", per_day.filter("dt > '2001-01-02'"), "2001-01-03", "2001-01-04")
    assert counts.missing("x", "2001-01-01", "2001-01-05") == [("2001-01-05", "2001-01-05")]

    def window(first, last):
        return Counter({r.k: r.n for r in counts.read("x", COUNTS, first, last).groupBy("k").agg(F.sum("n").alias("n")).collect()})

    assert window("2001-01-01", "2001-01-04") == {"a": 4, "b": 1}
    assert window("2001-01-02", "2001-01-03") == {"a": 1, "b": 1}
    plan = counts.read("x", COUNTS, "2001-01-02", "2001-01-03")._jdf.queryExecution().executedPlan().toString()
    assert "dt" in plan.split("PartitionFilters: [")[1].split("]")[0]
