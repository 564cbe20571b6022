"""Date and timestamp column helpers."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"


def validate_date(value: str | dt.date) -> dt.date:
    """Parse ``yyyy-MM-dd`` on the driver so a bad literal fails before any job."""
    if isinstance(value, dt.datetime):
        return value.date()
    if isinstance(value, dt.date):
        return value
    try:
        return dt.datetime.strptime(value, "%Y-%m-%d").date()
    except (TypeError, ValueError) as exc:
        raise ValueError(f"Invalid date {value!r}, expected yyyy-MM-dd") from exc


def parse_timestamp(col: str | Column, fmt: str = TIMESTAMP_FORMAT) -> Column:
    """Text to timestamp; text that does not match ``fmt`` gives null (never an error)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.try_to_timestamp(c, F.lit(fmt))


def date_range_predicate(ts_col: str, start, end, columns=None) -> Column:
    """Rows whose timestamp falls on a day in [start, end], both days whole.

    Half-open on the timestamp (``ts >= start AND ts < end + 1 day``) so the
    last day is complete at any sub-second precision. When the table carries
    year/month/day partition columns the same range is also stated on them,
    which lets the scan prune directories (a range on ``ts`` alone does not).
    """
    s, e = validate_date(start), validate_date(end)
    if e < s:
        raise ValueError(f"end {e} is before start {s}")
    pred = (F.col(ts_col) >= F.lit(s)) & (F.col(ts_col) < F.lit(e + dt.timedelta(days=1)))
    if columns is not None and {"year", "month", "day"} <= set(columns):
        part_day = F.make_date(F.col("year"), F.col("month"), F.col("day"))
        pred = pred & part_day.between(F.lit(s), F.lit(e))
    return pred
