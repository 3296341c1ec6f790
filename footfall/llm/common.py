"""Small helpers of the corpus operators."""

from __future__ import annotations

import sys
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: ASCII white space, as in the word pattern [^\x20\x09-\x0D]+.
SPACES = " \t\n\x0b\f\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def ship_by_value(module: str) -> None:
    """Send this module's functions to the executors as code, so they need no copy of the package."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


@contextmanager
def arrow_batches(spark: SparkSession, rows: int) -> Iterator[None]:
    """Jobs run inside send Python workers at most so many rows at a time: whole texts are large, and a batch
    is held several times over, in the JVM's native memory and in the worker."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def sliced(batch: pa.RecordBatch, rows: int) -> Iterator[pa.RecordBatch]:
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def let(value: Column, body) -> Column:
    """``body(value)`` with the value evaluated once, also where the body uses it inside lambdas."""
    return F.transform(F.array(value), body)[0]


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, UPPER.lower())


def words(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+``; null gives an empty array."""
    parts = F.split(F.coalesce(text, F.lit("")), SPACE_RUN)
    return F.filter(parts, lambda w: w != "")


def window_hashes(w: Column, width: int) -> Column:
    """Hashes of all runs of ``width`` elements; no elements if the array is shorter.

    Elements are hashed once. Hashes of two runs in a row make that of the joined run, so a width takes
    about as many passes over numbers as it has binary digits."""

    def joined(first: Column, second: Column, apart: int) -> Column:
        n = F.size(second) - apart
        both = F.zip_with(F.slice(first, 1, n), F.slice(second, apart + 1, n), lambda a, b: F.xxhash64(a, b))
        return F.when(n > 0, both).otherwise(F.array().cast("array<bigint>"))

    def runs(hashes: Column, single: Column, size: int, digits: str) -> Column:
        if not digits:
            return hashes
        hashes = let(hashes, lambda h: joined(h, h, size))
        if digits[0] == "1":
            hashes = let(hashes, lambda h: joined(h, single, 2 * size))
        return runs(hashes, single, 2 * size + int(digits[0]), digits[1:])

    return let(F.transform(w, lambda x: F.xxhash64(x)), lambda single: runs(single, single, 1, f"{width:b}"[1:]))


def key128(value: Column) -> list[Column]:
    """Two independent 64-bit hashes: 10^11 different values have no collision to speak of."""
    return [F.xxhash64(value).alias("h1"), F.xxhash64(F.lit(1), value).alias("h2")]
