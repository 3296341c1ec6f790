"""Stored tables and delimited text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from footfall.session import new_path


def save_clustered(df: DataFrame, path: str, keys: Sequence[str], order: Sequence) -> None:
    """Rows of a key lie together and sorted; a key too large for one file is spread over several."""
    clustered = df.hint("rebalance", *keys).sortWithinPartitions(*order)
    clustered.write.mode("overwrite").parquet(path)


def materialise(df: DataFrame, name: str, folder: str | None = None) -> DataFrame:
    """Write a step to the shared folder and go on from there.

    Used where a step feeds several others: it is computed once, and a lost executor costs no
    recomputation of what came before it."""
    spark = df.sparkSession
    path = new_path(spark, name, folder)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def export_text(df: DataFrame, path: str, sep: str = "\t", by: Sequence[str] = ()) -> None:
    """Delimited text files; a folder per value of the columns in ``by``, which the files leave out."""
    df.write.mode("overwrite").partitionBy(*by).csv(path, sep=sep)


def import_text(
    spark: SparkSession, paths: str | Sequence[str], schema: T.StructType, sep: str = "\t"
) -> DataFrame:
    return spark.read.schema(schema).csv(paths if isinstance(paths, str) else list(paths), sep=sep)


def serving_extract(df: DataFrame, as_of: str) -> DataFrame:
    return df.withColumn("update_time", F.lit(as_of).cast("timestamp_ntz"))
