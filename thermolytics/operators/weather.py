"""Daily weather join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import WEATHER_COLUMNS

# A date-keyed weather table restricted to a date range has at most one row
# per day of the range; up to this many rows it is broadcast unconditionally.
MAX_BROADCAST_DAYS = 100_000


def prepare_weather(weather: DataFrame, date_col: str = "date_col_name", fmt: str = "yyyy-MM-dd",
                    keys=("event_date",), extra_key_cols=None) -> DataFrame:
    """Weather rows -> one row per join key with ``hdd`` and ``avg_temp_c``.

    The date text is parsed into ``event_date`` (unparsable -> dropped).
    Several rows for one key (e.g. per-building weather joined on date only)
    are averaged so the join can never multiply daily rows.
    ``extra_key_cols`` maps join-key names to weather columns, e.g.
    ``{"building_id": "building_id_weather"}``.
    """
    extra = dict(extra_key_cols or {})
    w = weather.select(
        F.to_date(F.try_to_timestamp(F.col(date_col).cast("string"), F.lit(fmt))).alias("event_date"),
        *[F.col(src).alias(k) for k, src in extra.items()],
        *[F.col(c).cast("double").alias(c) for c in WEATHER_COLUMNS],
    ).where(F.col("event_date").isNotNull())
    return w.groupBy(*keys).agg(*[F.avg(c).alias(c) for c in WEATHER_COLUMNS])


def join_weather(daily: DataFrame, weather: DataFrame, keys=("event_date",), days_in_range: int | None = None) -> DataFrame:
    """LEFT join of daily rows with prepared weather; days without weather keep null features.

    When weather is keyed by date only and restricted to a known range of
    ``days_in_range`` days, its size is bounded by that count and it is
    broadcast. Otherwise (e.g. keyed by building as well) the size grows with
    the data, so the strategy is left to AQE, which broadcasts only when the
    measured size is under ``spark.sql.autoBroadcastJoinThreshold``.
    """
    keys = list(keys)
    right = weather.select(*keys, *WEATHER_COLUMNS)
    if keys == ["event_date"] and days_in_range is not None and days_in_range <= MAX_BROADCAST_DAYS:
        right = F.broadcast(right)
    return daily.join(right, on=keys, how="left")
