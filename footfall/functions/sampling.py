"""Reproducible random numbers: a pure function of the row's identifying columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def hash_uniform(*cols: str | Column, salt: str | Column) -> Column:
    """A number in [0, 1) that is the same on every run, engine and partitioning."""
    salt = F.lit(salt) if isinstance(salt, str) else salt
    digest = F.md5(F.concat_ws("|", *[_text(c) for c in cols], salt))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") / F.lit(4294967296.0)


def jitter(low: float, *cols: str | Column, salt: str | Column) -> Column:
    """A factor in [low, 1); 1 if low is 1."""
    if low == 1.0:
        return F.lit(1.0)
    return F.lit(low) + F.lit(1.0 - low) * hash_uniform(*cols, salt=salt)


def kept(drop: float, *cols: str | Column, salt: str | Column) -> Column:
    """Whether a sample that drops this share of the rows keeps the row."""
    return hash_uniform(*cols, salt=salt) > drop if drop > 0 else F.lit(True)


def _text(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")
