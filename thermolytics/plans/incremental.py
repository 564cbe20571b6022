"""Feature maintenance for readings that arrive in batches, late ones included.

The daily state is a versioned table with one part per day: a batch adds a delta to the days it has readings
of. Then only the series (apartments) of the batch are looked at, and of these only the rows are computed anew
whose lag or rolling frame holds a changed day. They are appended to the feature log, where the newest row
of a key wins. The result equals features computed from all readings.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.joins import same_keys
from ..operators.daily_state import SCHEMA, daily_state, finish, merge_state, windows_touched
from ..operators.weather import join_weather, prepare_weather
from ..operators.windows import SERIES_KEYS, add_lag_rolling
from ..schemas import FEATURE_COLUMNS
from ..session import materialize, scratch
from ..sources import feature_log, versioned


def add_readings(spark: SparkSession, meter: DataFrame, state_path: str, batch: str) -> versioned.Version:
    """Add a batch's readings to the daily state. Written again, the batch replaces its deltas; days into whose merged state
    it has gone already keep that."""
    written = versioned.write_data(daily_state(meter), state_path, F.col("event_date").cast("string"), [batch])

    def added(base: versioned.Version):
        merged = {e.part for e in base.entries if batch in e.tags and len(e.tags) > 1}
        return [e for e in base.entries if e.tags != (batch,)] + [e for e in written if e.part not in merged]

    return versioned.transact(spark, state_path, added)


def compact_state(spark: SparkSession, state_path: str) -> int:
    """Merge the deltas of each day that has several into one state; returns the number of days."""
    days: list[str] = []

    def merged(base: versioned.Version):
        many = {d: es for d, es in base.parts().items() if len(es) > 1}
        days[:] = many
        if not many:
            return None
        rows = merge_state(versioned.read(spark, state_path, SCHEMA, many, base))
        new = versioned.write_data(rows, state_path, F.col("event_date").cast("string"))
        tags = {d: tuple(sorted({t for e in es for t in e.tags})) for d, es in many.items()}
        return [e for e in base.entries if e.part not in many] + [versioned.Entry(e.part, e.folder, tags[e.part]) for e in new]

    versioned.transact(spark, state_path, merged)
    return len(days)


def changed_features(spark: SparkSession, state_path: str, changed: DataFrame, weather: DataFrame, *, lookback_days: int = 7,
                     calendar: bool = False, per_meter: bool = False, weather_date_col: str = "date_col_name",
                     weather_keys=("event_date",)) -> DataFrame:
    """Daily feature rows whose value may have changed with the days ``changed`` (KEYS, staged).

    Reads the state of the series in ``changed`` only; with calendar frames also of the days round theirs only (with
    row frames the rows before a day may lie any time back).
    """
    days = None
    if calendar:
        first, last = changed.agg(F.min("event_date"), F.max("event_date")).first()
        if first is None:
            days = []
        else:
            span = dt.timedelta(days=lookback_days - 1)
            days = [(first - span + dt.timedelta(i)).isoformat() for i in range((last - first + 2 * span).days + 1)]
    state = versioned.read(spark, state_path, SCHEMA, days)
    mine = same_keys(state, changed.select(*SERIES_KEYS).distinct(), SERIES_KEYS, "left_semi")
    daily = windows_touched(finish(mine, per_meter), changed, lookback_days, calendar)
    joined = join_weather(daily, prepare_weather(weather, weather_date_col, keys=weather_keys), keys=weather_keys)
    return add_lag_rolling(joined, lookback_days=lookback_days, calendar=calendar).where("touched").drop("touched")


def update_features(spark: SparkSession, meter: DataFrame, weather: DataFrame, state_path: str, features_path: str, batch: str,
                    event_time: Column | None = None, **kw) -> None:
    """Take in a batch of cleaned readings, late or not: daily state first, then the feature rows that it changes."""
    with scratch(spark):
        changed = materialize(meter.select("building_id", "apartment_id", F.to_date("event_ts").alias("event_date")).distinct(),
                              "late-days")
        add_readings(spark, meter, state_path, batch)
        rows = changed_features(spark, state_path, changed, weather, **kw)
        when = F.current_timestamp() if event_time is None else event_time
        rows = rows.select(F.col("apartment_id").alias("apartment_record_id"), when.cast(T.TimestampType()).alias("event_time"),
                           *FEATURE_COLUMNS[2:])
        feature_log.append_features(spark, rows, features_path, batch)
