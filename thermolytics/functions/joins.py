"""Joins whose keys may be null."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def same_keys(a: DataFrame, b: DataFrame, keys, how: str = "inner") -> DataFrame:
    """Join on ``keys`` with null equal to null; only ``a``'s keys stay."""
    r = b.select(*[F.col(c).alias(f"_r_{c}") if c in keys else F.col(c) for c in b.columns])
    out = a.join(r, [F.col(c).eqNullSafe(F.col(f"_r_{c}")) for c in keys], how)
    return out.drop(*[f"_r_{c}" for c in keys])
