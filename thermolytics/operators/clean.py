"""Raw reading cleaning: required-column gate, timestamp parse, partition
columns, null-key drop, fixed projection."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import TIMESTAMP_FORMAT, parse_timestamp
from ..schemas import METER_COLUMNS, RAW_COLUMNS

NUMERIC_RAW = ["energy_kwh", "room_temp_c", "setpoint_temp_c", "hot_water_litres"]


def require_columns(df, cols) -> DataFrame:
    """Fail at plan time when ``df`` lacks any of ``cols`` (listed in ``cols`` order)."""
    if not isinstance(df, DataFrame):
        raise TypeError("clean_meter takes a Spark DataFrame")
    present = set(df.columns)
    missing = [c for c in cols if c not in present]
    if missing:
        raise ValueError(f"Input DataFrame missing required columns: {missing}")
    return df


def clean_meter(df: DataFrame, timestamp_format: str = TIMESTAMP_FORMAT) -> DataFrame:
    """Raw readings -> processed meter rows (METER schema, partitions last).

    Extra input columns are dropped; a timestamp that does not match the
    format becomes null and the row is dropped together with rows lacking
    a meter id. Numeric text that does not parse becomes null.
    """
    require_columns(df, RAW_COLUMNS)
    event_ts = parse_timestamp(F.col("timestamp_str").cast("string"), timestamp_format)
    cols = [event_ts.alias("event_ts"),
            *[F.col(c).cast("string").alias(c) for c in ("meter_id", "apartment_id", "building_id")],
            *[F.col(c).try_cast("double").alias(c) for c in NUMERIC_RAW]]
    out = df.select(*cols).where(F.col("event_ts").isNotNull() & F.col("meter_id").isNotNull())
    return out.select(
        *METER_COLUMNS[:-3],
        F.year("event_ts").alias("year"),
        F.month("event_ts").alias("month"),
        F.dayofmonth("event_ts").alias("day"),
    )


def rejected_readings(df: DataFrame, timestamp_format: str = TIMESTAMP_FORMAT) -> DataFrame:
    """The rows ``clean_meter`` drops, with the reason (for audit tables)."""
    require_columns(df, RAW_COLUMNS)
    ts = parse_timestamp(F.col("timestamp_str").cast("string"), timestamp_format)
    reason = (F.when(F.col("timestamp_str").isNull(), F.lit("null timestamp"))
              .when(ts.isNull(), F.lit("unparsable timestamp"))
              .when(F.col("meter_id").isNull(), F.lit("null meter_id")))
    return df.select(*RAW_COLUMNS, reason.alias("reason")).where(F.col("reason").isNotNull())
