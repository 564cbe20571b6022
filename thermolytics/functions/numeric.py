"""Numeric column guards."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def round6(x) -> Column:
    """Round to 6 decimals; adding 0.0 turns -0.0 into 0.0 for stable comparisons."""
    return F.round(_c(x), 6) + F.lit(0.0)


def gt_not_nan(x, threshold) -> Column:
    """Strict ``x > threshold`` that is false for NaN (Spark orders NaN above all numbers)."""
    c = _c(x)
    return (c > F.lit(threshold)) & ~F.isnan(c)


def safe_ratio(num, den) -> Column:
    """num / den, 0 when the denominator is 0 or null."""
    return F.coalesce(F.try_divide(_c(num), _c(den)), F.lit(0.0))
