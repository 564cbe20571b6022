"""Evaluation reports as JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def write_report(df: DataFrame, path: str) -> None:
    """One JSON object per report row; a report is one row, so one file."""
    df.coalesce(1).write.mode("overwrite").json(path)


def read_report(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """Reports; pass the report schema to keep columns that were null (JSON omits them)."""
    r = spark.read
    return (r.schema(schema) if schema is not None else r).json(path)
