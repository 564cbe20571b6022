"""Meter-domain views over the driver's ``events`` table.

No meter data ships with the test tables, so readings, raw text rows,
weather and labels are derived from ``events`` by fixed rules. The same
rules appear as SQL in ``SQL_VIEWS`` for the DuckDB oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def _k() -> F.Column:
    return F.get_json_object("props", "$.k").cast("int")


def meter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Processed meter rows (METER schema without partition columns)."""
    e = events(spark, sf_dir)
    uid = F.col("user_id")
    return e.select(
        F.col("ts").alias("event_ts"),
        F.concat(F.lit("m"), uid.cast("string")).alias("meter_id"),
        F.concat(F.lit("apt"), uid.cast("string")).alias("apartment_id"),
        F.concat(F.lit("bldg"), (uid % 7).cast("string")).alias("building_id"),
        F.col("value").alias("energy_kwh"),
        (F.lit(18.0) + (_k() % 80) / 10.0).cast("double").alias("room_temp_c"),
        (F.lit(20.0) + (uid % 5) * 0.5).cast("double").alias("setpoint_temp_c"),
        (F.col("value") * 2).alias("hot_water_litres"),
    )


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw text rows (RAW schema + one extra column).

    Rows with k = 0 carry a timestamp in a foreign format and rows with
    k = 1 lack a meter id; cleaning must drop both.
    """
    k, uid = _k(), F.col("user_id")
    ts_text = F.when(k == 0, F.date_format("ts", "MM/dd/yyyy HH:mm:ss")) \
               .otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    return events(spark, sf_dir).select(
        ts_text.alias("timestamp_str"),
        F.when(k == 1, F.lit(None).cast("string")).otherwise(F.concat(F.lit("m"), uid.cast("string"))).alias("meter_id"),
        F.concat(F.lit("apt"), uid.cast("string")).alias("apartment_id"),
        F.concat(F.lit("bldg"), (uid % 7).cast("string")).alias("building_id"),
        F.col("value").alias("energy_kwh"),
        (F.lit(18.0) + (k % 80) / 10.0).cast("double").alias("room_temp_c"),
        (F.lit(20.0) + (uid % 5) * 0.5).cast("double").alias("setpoint_temp_c"),
        (F.col("value") * 2).alias("hot_water_litres"),
        F.col("event_type").alias("extra_raw_col"),
    )


def weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per event day, except days 10, 20, 30 (missing weather)."""
    d = events(spark, sf_dir).select(F.to_date("ts").alias("d")).distinct()
    day = F.dayofmonth("d")
    hdd = ((day * 7) % 13 + F.lit(0.5)).cast("double")
    return d.where(day % 10 != 0).select(
        F.date_format("d", "yyyy-MM-dd").alias("date_col_name"),
        hdd.alias("hdd"),
        (F.lit(18.0) - hdd).alias("avg_temp_c"),
    )


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """is_anomaly = 1 for each apartment-day that has an 'error' event."""
    e = events(spark, sf_dir).where(F.col("event_type") == "error")
    return e.select(
        F.concat(F.lit("apt"), F.col("user_id").cast("string")).alias("apartment_record_id"),
        F.to_date("ts").alias("event_date"),
    ).distinct().withColumn("is_anomaly", F.lit(1))


# The same views for DuckDB (CTE bodies). Keep in step with the functions above.
SQL_VIEWS = {
    "meter": """
      SELECT ts AS event_ts, 'm' || CAST(user_id AS VARCHAR) AS meter_id,
             'apt' || CAST(user_id AS VARCHAR) AS apartment_id,
             'bldg' || CAST(user_id % 7 AS VARCHAR) AS building_id,
             value AS energy_kwh,
             CAST(18.0 + (CAST(json_extract_string(props, '$.k') AS INTEGER) % 80) / 10.0 AS DOUBLE) AS room_temp_c,
             CAST(20.0 + (user_id % 5) * 0.5 AS DOUBLE) AS setpoint_temp_c,
             value * 2 AS hot_water_litres
      FROM events""",
    "raw": """
      SELECT CASE WHEN CAST(json_extract_string(props, '$.k') AS INTEGER) = 0
                  THEN strftime(ts, '%m/%d/%Y %H:%M:%S') ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS timestamp_str,
             CASE WHEN CAST(json_extract_string(props, '$.k') AS INTEGER) = 1 THEN NULL
                  ELSE 'm' || CAST(user_id AS VARCHAR) END AS meter_id,
             'apt' || CAST(user_id AS VARCHAR) AS apartment_id,
             'bldg' || CAST(user_id % 7 AS VARCHAR) AS building_id,
             value AS energy_kwh,
             CAST(18.0 + (CAST(json_extract_string(props, '$.k') AS INTEGER) % 80) / 10.0 AS DOUBLE) AS room_temp_c,
             CAST(20.0 + (user_id % 5) * 0.5 AS DOUBLE) AS setpoint_temp_c,
             value * 2 AS hot_water_litres,
             event_type AS extra_raw_col
      FROM events""",
    "weather": """
      SELECT strftime(d, '%Y-%m-%d') AS date_col_name,
             CAST((dayofmonth(d) * 7) % 13 + 0.5 AS DOUBLE) AS hdd,
             18.0 - CAST((dayofmonth(d) * 7) % 13 + 0.5 AS DOUBLE) AS avg_temp_c
      FROM (SELECT DISTINCT CAST(ts AS DATE) AS d FROM events) t
      WHERE dayofmonth(d) % 10 <> 0""",
    "labels": """
      SELECT DISTINCT 'apt' || CAST(user_id AS VARCHAR) AS apartment_record_id,
             CAST(ts AS DATE) AS event_date, 1 AS is_anomaly
      FROM events WHERE event_type = 'error'""",
}


SQL_VIEWS["labels_v"] = SQL_VIEWS["labels"]


def with_views(sql: str, *names: str, extra=()) -> str:
    """Prefix ``sql`` with CTEs for the named views, then ``extra`` (name, body) pairs."""
    parts = [f"{n} AS ({SQL_VIEWS[n]})" for n in names] + [f"{n} AS ({b})" for n, b in extra]
    return ("WITH " + ",\n".join(parts) + "\n" + sql) if parts else sql
