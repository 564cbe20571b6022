"""Daily feature jobs for training (date range) and scoring (one date).

Both call ``daily_features``, so training and serving compute features with
the same code; they differ only in the range read and the final trim.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import date_range_predicate, validate_date
from ..operators.daily import daily_consumption
from ..operators.weather import join_weather, prepare_weather
from ..operators.windows import add_lag_rolling
from ..schemas import FEATURE_COLUMNS, INFER_COLUMNS

DAILY_FEATURE_COLUMNS = ["building_id", "apartment_id", "event_date", "avg_temp_diff",
                         "daily_energy_kwh", "daily_water_l", "hdd", "avg_temp_c",
                         "energy_lag_1d", "energy_roll_avg_7d", "temp_diff_lag_1d"]


def daily_features(meter: DataFrame, weather: DataFrame, *, weather_date_col: str = "date_col_name",
                   weather_keys=("event_date",), weather_key_cols=None, days_in_range: int | None = None,
                   lookback_days: int = 7, calendar: bool = False, per_meter: bool = False) -> DataFrame:
    """Meter readings + weather -> daily rows with lag and rolling features.

    Plan: partial+final aggregation by (building, apartment, day), broadcast
    weather join, one shuffle by (building, apartment) for the window.
    """
    daily = daily_consumption(meter, per_meter=per_meter)
    w = prepare_weather(weather, weather_date_col, keys=weather_keys, extra_key_cols=weather_key_cols)
    joined = join_weather(daily, w, keys=weather_keys, days_in_range=days_in_range)
    return add_lag_rolling(joined, lookback_days=lookback_days, calendar=calendar).select(*DAILY_FEATURE_COLUMNS)


def _restrict_weather(weather: DataFrame, date_col: str, lo: dt.date, hi: dt.date) -> DataFrame:
    d = F.to_date(F.try_to_timestamp(F.col(date_col).cast("string"), F.lit("yyyy-MM-dd")))
    return weather.where(d.between(F.lit(lo), F.lit(hi)))


def training_features(meter: DataFrame, weather: DataFrame, start, end, *, warmup: bool = True,
                      lookback_days: int = 7, calendar: bool = False, event_time: Column | None = None,
                      weather_date_col: str = "date_col_name", **kw) -> DataFrame:
    """Feature rows (FEATURE schema) for the whole days [start, end].

    With ``warmup`` the ``lookback_days`` days before ``start`` are read as
    history for lags and rolling means and then trimmed away, so the first
    days of the range see the same history as serving does.
    ``warmup=False`` reads only the range. ``event_time`` defaults to the
    processing time; tests pass a literal.
    """
    s, e = validate_date(start), validate_date(end)
    lo = s - dt.timedelta(days=lookback_days) if warmup else s
    m = meter.where(date_range_predicate("event_ts", lo, e, meter.columns))
    w = _restrict_weather(weather, weather_date_col, lo, e)
    f = daily_features(m, w, weather_date_col=weather_date_col, days_in_range=(e - lo).days + 1,
                       lookback_days=lookback_days, calendar=calendar, **kw)
    if warmup:
        f = f.where(F.col("event_date").between(F.lit(s), F.lit(e)))
    et = event_time if event_time is not None else F.current_timestamp()
    out = f.select(
        F.col("apartment_id").alias("apartment_record_id"),
        et.cast(T.TimestampType()).alias("event_time"),
        *FEATURE_COLUMNS[2:],
    )
    return out.dropna(subset=["apartment_record_id", "event_time"])


def inference_features(meter: DataFrame, weather: DataFrame, date, *, lookback_days: int = 7,
                       calendar: bool = False, fill_value: float | None = 0.0,
                       weather_date_col: str = "date_col_name", columns=INFER_COLUMNS, **kw) -> DataFrame:
    """Scoring rows (INFER columns) for one day, with ``lookback_days`` of history.

    Nulls in numeric columns (no lag yet, no weather) become ``fill_value``;
    ``fill_value=None`` keeps them. Columns of ``columns`` that do not exist
    are skipped. No rows on the date -> an empty frame with the same schema.
    """
    d = validate_date(date)
    lo = d - dt.timedelta(days=lookback_days)
    m = meter.where(date_range_predicate("event_ts", lo, d, meter.columns))
    w = _restrict_weather(weather, weather_date_col, lo, d)
    f = daily_features(m, w, weather_date_col=weather_date_col, days_in_range=(d - lo).days + 1,
                       lookback_days=lookback_days, calendar=calendar, **kw)
    f = f.where(F.col("event_date") == F.lit(d))
    out = f.select(*[c for c in columns if c in f.columns])
    if fill_value is not None:
        numeric = [fld.name for fld in out.schema.fields if isinstance(fld.dataType, T.NumericType)]
        out = out.fillna(fill_value, subset=numeric)
    return out
