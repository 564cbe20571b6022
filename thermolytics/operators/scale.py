"""Per-feature standard scaling with population statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.params import attach_row


def require_features(df: DataFrame, cols, exc=ValueError, msg: str | None = None) -> None:
    if not cols:
        raise ValueError("Hyperparameter 'feature_columns' must be provided")
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise exc(msg or f"Missing feature columns: {missing}")


def fit_scaler(df: DataFrame, cols) -> DataFrame:
    """One-row parameter table: ``<c>_mean`` and ``<c>_std`` per feature.

    Nulls count as 0 (filled before the fit). ``std`` is the population
    standard deviation; a zero std is stored as 1 so scaling leaves the
    centred value. A single aggregate: partial sums per task, one tiny
    shuffle, independent of data size.
    """
    require_features(df, cols)
    x = {c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in cols}
    aggs = []
    for c in cols:
        aggs.append(F.avg(x[c]).alias(f"{c}_mean"))
        sd = F.stddev_pop(x[c])
        aggs.append(F.when((sd.isNull()) | (sd == 0), F.lit(1.0)).otherwise(sd).alias(f"{c}_std"))
    return df.agg(*aggs)


def apply_scaler(df: DataFrame, params: DataFrame, cols, prefix: str = "z_") -> DataFrame:
    """Adds ``z_<c> = (coalesce(c,0) - mean) / std`` using a fitted one-row table.

    The parameter table has exactly one row, so it is broadcast to every task.
    """
    p = params.select(*[f"{c}_mean" for c in cols], *[f"{c}_std" for c in cols])
    j = attach_row(df, p)
    out = j.select(*df.columns, *[((F.coalesce(F.col(c).cast("double"), F.lit(0.0)) - F.col(f"{c}_mean"))
                                    / F.col(f"{c}_std")).alias(f"{prefix}{c}") for c in cols])
    return out


def scaler_long(params: DataFrame, cols) -> DataFrame:
    """The one-row parameter table as rows (feature, mean, std)."""
    pairs = ", ".join(f"'{c}', `{c}_mean`, `{c}_std`" for c in cols)
    return params.selectExpr(f"stack({len(cols)}, {pairs}) AS (feature, mean, std)")
