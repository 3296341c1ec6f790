"""Shop eligibility."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from footfall.params import Params


def eligible(shops: DataFrame, p: Params) -> DataFrame:
    """Current, well-rated shops of the listed powers."""
    return shops.filter(
        (F.col("hp_valid_end_dt") == p.current_version)
        & (F.col("star") >= p.min_star)
        & F.col("power").isin(*p.powers)
    )


def searchable(shops: DataFrame, p: Params) -> DataFrame:
    """Current, well-rated shops above a power."""
    return shops.filter(
        (F.col("hp_valid_end_dt") == p.current_version)
        & (F.col("star") >= p.min_star)
        & (F.col("power") > p.min_power)
    )
