"""Exclusion, restriction, neighbour expansion and comparison against an older state."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def extra_key(keys: Sequence[str]) -> Column:
    """A bit of a hash of the keys: only a join key more, whose bytes are shuffled with every row."""
    return F.pmod(F.xxhash64(*keys), F.lit(2)).cast("tinyint")


def join_per_key(
    df: DataFrame, per_key: DataFrame, keys: Sequence[str], how: str = "inner"
) -> DataFrame:
    """Join detail rows, of which one key may hold a large part, to an aggregate on the keys.

    Spark splits skewed partitions of a join at run time only if both inputs come straight from a
    shuffle. An aggregate on the join keys does not: the join reuses its partitioning. Joining on a bit
    of a hash of the keys as well makes Spark shuffle the aggregate again, after it has shrunk to one row
    per key, and the large side can be split."""
    h = extra_key(keys)
    joined = df.withColumn("_h", h).join(per_key.withColumn("_h", h), [*keys, "_h"], how)
    return joined.drop("_h")


def restrict(df: DataFrame, keys_df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key is in keys_df; duplicates on the right do not multiply rows.

    The keys are made distinct before they are shuffled, here and in ``exclude``."""
    return join_per_key(df, keys_df.select(*keys).distinct(), keys, "left_semi")


def exclude(df: DataFrame, keys_df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key is not in keys_df."""
    return join_per_key(df, keys_df.select(*keys).distinct(), keys, "left_anti")


def exclude_from_totals(df: DataFrame, keys_df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``exclude`` for the rows of an aggregate.

    Spark plans an anti join on grouping columns below the aggregate, where it shuffles every input
    row; as an outer join it stays above and shuffles the totals."""
    gone = keys_df.select(*keys).distinct().withColumn("_gone", F.lit(True))
    return join_per_key(df, gone, keys, "left").filter(F.col("_gone").isNull()).drop("_gone")


def expand(
    df: DataFrame, edges: DataFrame, on: Sequence[str], keys: Sequence[str], score: Column, out: str,
    keep: Column | None = None,
) -> DataFrame:
    """One hop over an edge table: join on the source, sum the score per key and target.

    The join rows are combined map-side before they are shuffled by target."""
    hop = df.join(edges, list(on))
    if keep is not None:
        hop = hop.filter(keep)
    return hop.groupBy(*keys).agg(F.sum(score).alias(out))


def trend_delta(new: DataFrame, old: DataFrame, keys: Sequence[str], score: str) -> DataFrame:
    """new - old, or new where there is no old row."""
    before = old.select(*keys, F.col(score).alias("_old"))
    moved = F.when(F.col("_old").isNull(), F.col(score)).otherwise(F.col(score) - F.col("_old"))
    return new.join(before, list(keys), "left").withColumn(score, moved).drop("_old")


def in_periods(df: DataFrame, day: str, since: str, before: str) -> DataFrame:
    """Rows of the current period (on or after ``since``, period 1) and of an earlier one (before
    ``before``, period 0), from one scan; a row may be in both."""
    now = F.when(F.col(day) >= F.lit(since).cast("date"), 1)
    then = F.when(F.col(day) < F.lit(before).cast("date"), 0)
    both = df.withColumn("period", F.explode(F.array(now, then)))
    return both.filter(F.col("period").isNotNull())


def period_delta(scored: DataFrame, keys: Sequence[str], score: str) -> DataFrame:
    """``trend_delta`` of period 1 against period 0 of one table, as one aggregate."""
    new = F.max(F.when(F.col("period") == 1, F.col(score)))
    old = F.max(F.when(F.col("period") == 0, F.col(score)))
    moved = scored.groupBy(*keys).agg((new - F.coalesce(old, F.lit(0.0))).alias(score))
    return moved.filter(F.col(score).isNotNull())


def canonicalise(
    df: DataFrame, names: DataFrame, keys: Sequence[str], word: str, name: str
) -> DataFrame:
    """Replace a word by the name it stands for, where there is one."""
    pairs = names.select(*keys, F.col(name).alias("_name"))
    joined = join_per_key(df, pairs, keys, "left")
    return joined.withColumn(word, F.coalesce("_name", word)).drop("_name")


def snapshot_delta(new: DataFrame, old: DataFrame, key: str, value: str) -> DataFrame:
    """Rows of new that are not in old or have another value there."""
    before = old.select(key, F.col(value).alias("_old"))
    changed = F.col("_old").isNull() | (F.col("_old") != F.col(value))
    return new.join(before, key, "left").filter(changed).select(key, value)


def replace_groups(state: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keep state groups that new does not have, add all of new."""
    return exclude(state, new, keys).unionByName(new)
