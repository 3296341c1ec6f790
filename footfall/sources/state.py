"""What a daily job leaves for the next: state tables, committed a day at a time, and counts of closed days."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from footfall.schemas import conform
from footfall.session import hadoop_path

DAYS = "_days"
COVERED = "_covered"
_DATED = (T.StructField("dt", T.StringType()), T.StructField("run", T.StringType()))


def shifted(day: str, days: int) -> str:
    return (date.fromisoformat(day) + timedelta(days)).isoformat()


def _names(spark: SparkSession, path: str, prefix: str = "") -> list[str]:
    """Names in a folder that start with the prefix, without it; none if there is no folder."""
    at, fs = hadoop_path(spark, path)
    if not fs.exists(at):
        return []
    names = (s.getPath().getName() for s in fs.listStatus(at))
    return sorted(n.removeprefix(prefix) for n in names if n.startswith(prefix))


@dataclass(frozen=True)
class Day:
    """A committed day: the tables of one run that ended."""

    store: StateStore
    dt: str
    run: str

    def read(self, table: str) -> DataFrame:
        return self.store.spark.read.schema(self.store.schemas[table]).parquet(self.store.path(table, self))


class StateStore:
    """Tables under ``root/<table>/dt=<day>/run=<run>``, and ``root/_days/dt=<day>/run=<run>`` for each run
    that ended.

    Every run of a day writes folders of its own; the entry in ``_days`` comes last and has Spark's end
    marker. Readers start from the entries, so they see all tables of a run or none: a run that dies
    half-way, at whatever table, leaves the days before as they were. Of several runs of a day the last
    counts. Nothing that a reader may have open is overwritten."""

    def __init__(self, spark: SparkSession, root: str, schemas: Mapping[str, T.StructType]):
        self.spark, self.root, self.schemas = spark, root.rstrip("/"), schemas

    def path(self, table: str, day: Day) -> str:
        return f"{self.root}/{table}/dt={day.dt}/run={day.run}"

    def publish(self, dt: str, tables: Mapping[str, Callable[[], DataFrame]]) -> Day:
        """Write the tables one after the other, each computed when its turn comes, then the entry."""
        day = Day(self, dt, f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}")
        for name, table in tables.items():
            conform(table(), self.schemas[name]).write.mode("error").parquet(self.path(name, day))
        entry = self.spark.createDataFrame([(name,) for name in tables], "table string").coalesce(1)
        entry.write.mode("error").parquet(self.path(DAYS, day))
        return day

    def days(self) -> list[Day]:
        """Committed days in order, each with its last run."""
        found = []
        for dt in _names(self.spark, f"{self.root}/{DAYS}", "dt="):
            at = f"{self.root}/{DAYS}/dt={dt}"
            ended = [r for r in _names(self.spark, at, "run=") if _names(self.spark, f"{at}/run={r}", "_SUCCESS")]
            found += [Day(self, dt, r) for r in ended[-1:]]
        return found

    def before(self, dt: str) -> Day | None:
        """The latest committed day before dt."""
        return max((d for d in self.days() if d.dt < dt), key=lambda d: d.dt, default=None)

    def history(self, table: str) -> DataFrame:
        """The rows of all committed days, with their date as ``dt``.

        One scan of one partitioned folder, joined to a small list of runs: the plan does not grow with the
        days, and a filter on dt lists only its folders."""
        schema = T.StructType([*self.schemas[table], *_DATED])
        days = [(d.dt, d.run) for d in self.days()]
        runs = self.spark.createDataFrame(days, T.StructType([*_DATED]))
        at, fs = hadoop_path(self.spark, f"{self.root}/{table}")
        if not fs.exists(at):
            return self.spark.createDataFrame([], schema).drop("run")
        return self.spark.read.schema(schema).parquet(f"{self.root}/{table}").join(runs, ["dt", "run"], "left_semi").drop("run")

    def expire(self, before: str) -> None:
        """Delete all days before the given one: their entries first, so that no reader finds half a day."""
        for name in (DAYS, *self.schemas):
            for dt in _names(self.spark, f"{self.root}/{name}", "dt="):
                if dt < before:
                    at, fs = hadoop_path(self.spark, f"{self.root}/{name}/dt={dt}")
                    fs.delete(at, True)


class DailyCounts:
    """Counts per day and key under ``root/<name>/dt=<day>``; a window adds up days, and a day that was
    counted is not read from the log again.

    A range of days is written whole (days without rows have no folder), then marked as covered. What an
    unfinished write left is overwritten by the next one. A day is closed once it is counted: events that
    arrive later for it are not seen."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def covered(self, name: str) -> list[tuple[str, str]]:
        """Ranges (first, last) of counted days."""
        return [tuple(n.split("_")) for n in _names(self.spark, f"{self.root}/{name}/{COVERED}")]

    def missing(self, name: str, first: str, last: str) -> list[tuple[str, str]]:
        """The parts of [first, last] that are not covered."""
        gaps = []
        for a, b in sorted(self.covered(name)):
            if first > last:
                break
            if a > first:
                gaps.append((first, min(last, shifted(a, -1))))
            first = max(first, shifted(b, 1))
        return gaps + ([(first, last)] if first <= last else [])

    def write(self, name: str, counts: DataFrame, first: str, last: str) -> None:
        """Counts of all days from first to last."""
        rows = counts.hint("rebalance", "dt").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        rows.partitionBy("dt").parquet(f"{self.root}/{name}")
        at, fs = hadoop_path(self.spark, f"{self.root}/{name}/{COVERED}/{first}_{last}")
        fs.create(at, True).close()

    def read(self, name: str, schema: T.StructType, first: str, last: str) -> DataFrame:
        """Rows of the days from first to last; only their folders are read."""
        rows = self.spark.read.schema(schema).parquet(f"{self.root}/{name}")
        return rows.filter(F.col("dt").between(F.lit(first).cast("date"), F.lit(last).cast("date")))


def by_range(missing: Iterable[tuple[str, tuple[str, str]]]) -> dict[tuple[str, str], list[str]]:
    """Names by the range of days that they lack, so that the log is read once per range."""
    found: dict[tuple[str, str], list[str]] = {}
    for name, days in missing:
        found.setdefault(days, []).append(name)
    return found
