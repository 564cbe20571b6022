"""Mergeable state of the daily roll-up: what late readings of a day can be added to.

A state row holds, per (building, apartment, day) or also per meter, the sum and count of the temperature gap and the
smallest and largest value of each counter. States of any parts of a day's readings merge into that of all of
them, whatever the order, and ``finish`` turns a state into the row that ``daily_consumption`` gives.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .daily import KEYS
from .windows import SERIES_KEYS
from ..functions.joins import same_keys

SUMS = ("gap_sum", "gap_n")
LEAST = ("energy_min", "water_min")
MOST = ("energy_max", "water_max")
SCHEMA = ("building_id string, apartment_id string, event_date date, meter_id string, gap_sum double, gap_n long, "
          "energy_min double, energy_max double, water_min double, water_max double")


def daily_state(meter: DataFrame) -> DataFrame:
    """State rows (SCHEMA) of readings, per meter. Partial aggregates, as in the roll-up itself."""
    gap = F.col("room_temp_c") - F.col("setpoint_temp_c")
    return meter.withColumn("event_date", F.to_date("event_ts")).groupBy(*KEYS, "meter_id").agg(
        F.sum(gap).alias("gap_sum"), F.count(gap).alias("gap_n"),
        F.min("energy_kwh").alias("energy_min"), F.max("energy_kwh").alias("energy_max"),
        F.min("hot_water_litres").alias("water_min"), F.max("hot_water_litres").alias("water_max"))


def merge_state(states: DataFrame, keys=(*KEYS, "meter_id")) -> DataFrame:
    """One state row per ``keys`` from any number of them."""
    return states.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in SUMS], *[F.min(c).alias(c) for c in LEAST],
                                     *[F.max(c).alias(c) for c in MOST])


def finish(states: DataFrame, per_meter: bool = False) -> DataFrame:
    """States -> rows as ``daily_consumption(..., per_meter)`` gives them."""
    energy, water = F.col("energy_max") - F.col("energy_min"), F.col("water_max") - F.col("water_min")
    if per_meter:
        by_meter = merge_state(states).select(*KEYS, *SUMS, energy.alias("_e"), water.alias("_w"))
        return by_meter.groupBy(*KEYS).agg((F.sum("gap_sum") / F.sum("gap_n")).alias("avg_temp_diff"),
                                           F.sum("_e").alias("daily_energy_kwh"), F.sum("_w").alias("daily_water_l"))
    return merge_state(states, KEYS).select(*KEYS, F.when(F.col("gap_n") > 0, F.col("gap_sum") / F.col("gap_n")).alias("avg_temp_diff"),
                                            energy.alias("daily_energy_kwh"), water.alias("daily_water_l"))


def windows_touched(daily: DataFrame, changed: DataFrame, lookback_days: int = 7, calendar: bool = False) -> DataFrame:
    """``daily`` with ``touched``: whether the lag or rolling frame of the row holds a day of ``changed`` (KEYS)."""
    marked = same_keys(daily, changed.select(*KEYS).distinct().withColumn("_changed", F.lit(1)), KEYS, "left")
    w = Window.partitionBy(*SERIES_KEYS)
    if calendar:
        frame = w.orderBy(F.unix_date("event_date")).rangeBetween(-(lookback_days - 1), 0)
    else:
        frame = w.orderBy("event_date").rowsBetween(-(lookback_days - 1), 0)
    return marked.withColumn("touched", F.max("_changed").over(frame).isNotNull()).drop("_changed")
