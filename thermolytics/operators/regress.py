"""Energy ~ heating-degree-days regression."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.params import attach_row


def fit_hdd_regression(df: DataFrame, y: str = "daily_energy_kwh", x: str = "hdd") -> DataFrame:
    """One-row table (slope, intercept, n) of ordinary least squares with intercept.

    Nulls are filled with 0 before the fit (rows are not skipped). A constant
    ``x`` has no slope: slope 0 and intercept mean(y), the minimum-norm answer.
    """
    yy = F.coalesce(F.col(y).cast("double"), F.lit(0.0))
    xx = F.coalesce(F.col(x).cast("double"), F.lit(0.0))
    s = df.agg(F.regr_slope(yy, xx).alias("_b"), F.regr_intercept(yy, xx).alias("_a"),
               F.avg(yy).alias("_my"), F.count(F.lit(1)).alias("n"))
    return s.select(F.coalesce("_b", F.lit(0.0)).alias("slope"),
                    F.when(F.col("_b").isNull(), F.col("_my")).otherwise(F.col("_a")).alias("intercept"),
                    "n")


def regression_residual(df: DataFrame, model: DataFrame, y: str = "daily_energy_kwh", x: str = "hdd",
                        out: str = "residual") -> DataFrame:
    """``y - (intercept + slope * x)`` with nulls as 0; the model row is broadcast."""
    m = model.select(F.col("slope").alias("_slope"), F.col("intercept").alias("_icpt"))
    yy = F.coalesce(F.col(y).cast("double"), F.lit(0.0))
    xx = F.coalesce(F.col(x).cast("double"), F.lit(0.0))
    return attach_row(df, m).withColumn(out, yy - (F.col("_icpt") + F.col("_slope") * xx)).drop("_slope", "_icpt")
