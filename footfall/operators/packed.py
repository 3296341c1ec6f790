"""Packed tag fields: ``tag:score,tag:score`` in one string."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def explode_tags(
    df: DataFrame, packed: str, keep: Sequence[str], score: str,
    item_sep: str = ",", part_sep: str = ":",
) -> DataFrame:
    """One row (keep..., tag, score) per packed pair."""
    items = df.select(*keep, F.explode(F.split(packed, item_sep)).alias("_item"))
    parts = items.select(*keep, F.split("_item", part_sep).alias("_p"))
    return parts.select(
        *keep,
        F.trim(F.get("_p", F.lit(0))).alias("tag"),
        F.get("_p", F.lit(1)).try_cast("double").alias(score),
    ).filter(F.col("tag") != "")


def with_tag_type(tags: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """Type each tag by a (tag, tagtype) vocabulary; tags outside it are dropped."""
    return tags.join(vocabulary.select("tag", "tagtype"), "tag")
