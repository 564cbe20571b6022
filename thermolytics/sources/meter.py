"""Raw readings, processed meter table and weather table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..functions.dates import date_range_predicate
from ..schemas import METER, PARTITION_COLUMNS, RAW


def read_raw_meter(spark: SparkSession, paths, schema=RAW) -> DataFrame:
    """JSON readings under one or more prefixes, searched recursively.

    The schema is fixed, so no inference pass over the input is made and
    extra fields are ignored. Lines that are not JSON give all-null rows,
    which the cleaning step drops.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    return (spark.read.schema(schema)
            .option("recursiveFileLookup", "true")
            .option("mode", "PERMISSIVE")
            .json(paths))


def read_meter(spark: SparkSession, path: str, start=None, end=None) -> DataFrame:
    """Processed meter Parquet, optionally restricted to whole days [start, end].

    The range is stated on ``event_ts`` (row-group pushdown) and on the
    year/month/day partition columns (directory pruning).
    """
    df = spark.read.schema(METER).parquet(path)
    if start is not None:
        df = df.where(date_range_predicate("event_ts", start, end or start, df.columns))
    return df


def write_meter(df: DataFrame, path: str, table: str | None = None) -> None:
    """Append Snappy Parquet partitioned by year/month/day.

    Rows are rebalanced by day: adaptive execution sizes the writing tasks by bytes, so small
    days give one file each and a day that holds a large share of the readings is split over
    as many writers as its size asks for. With ``table`` the data is also registered in the
    session catalog (new partitions are discovered by the append).
    """
    w = (df.hint("rebalance", *PARTITION_COLUMNS)
         .write.mode("append").partitionBy(*PARTITION_COLUMNS).option("compression", "snappy"))
    if table:
        w.option("path", path).saveAsTable(table)
    else:
        w.parquet(path)


def read_weather(spark: SparkSession, path: str) -> DataFrame:
    """Weather Parquet as stored (date text column + hdd + avg_temp_c)."""
    return spark.read.parquet(path)
