"""Alert table keyed by AlertID, a versioned table (``versioned``) with one part per EventDate.

An upsert or delete reads the folders of the dates it touches, writes their new rows to a folder of
its own and publishes both in one step: a reader sees it whole or not at all, also when the writer
dies on the way, and of two writers at a time the second merges again into what the first left.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import versioned
from ..operators.alerts import merge_alerts
from ..schemas import ALERT_COLUMNS, ALERT_DECIMAL
from ..session import materialize, release

STORE_SCHEMA = ("AlertID string, ApartmentID string, BuildingID string, AnomalyScore decimal(38,18), "
                "Threshold decimal(38,18), AlertTimestamp string, Status string, S3SourceFile string, "
                "EventDate string")
NO_DATE = "none"


def part_of(date="EventDate"):
    """Part of a date. Empty and null dates have one of their own: as a folder's value they would read back as null."""
    return F.when(F.coalesce(date, F.lit("")) == "", F.lit(NO_DATE)).otherwise(F.concat(F.lit("d"), date))


def to_store(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(c).cast(ALERT_DECIMAL).alias(c) if c in ("AnomalyScore", "Threshold") else F.col(c)
                       for c in ALERT_COLUMNS])


def read_alerts(spark: SparkSession, path: str, date: str | None = None) -> DataFrame:
    """All alerts of the store, or those of one EventDate (opens that date's folder only)."""
    part = None if date is None else [NO_DATE if date == "" else f"d{date}"]
    df = versioned.read(spark, path, STORE_SCHEMA, part)
    if date is not None:
        df = df.where(F.coalesce("EventDate", F.lit("")) == date)
    return df.select(*ALERT_COLUMNS)


def _touched(df: DataFrame) -> list[str]:
    """Parts of the rows: one value per date."""
    return [r[0] for r in df.select(part_of().alias("p")).distinct().collect()]


def upsert_alerts(spark: SparkSession, new: DataFrame, path: str, attempts: int = 10) -> int:
    """Merge ``new`` into the store; returns the number of touched dates."""
    new = materialize(to_store(new), "alerts-new")      # evaluated once
    touched = _touched(new)

    def merged(base: versioned.Version):
        if not touched:
            return None
        existing = versioned.read(spark, path, STORE_SCHEMA, touched, base).select(*ALERT_COLUMNS)
        written = versioned.write_data(merge_alerts(existing, new), path, part_of())
        return [e for e in base.entries if e.part not in set(touched)] + written

    versioned.transact(spark, path, merged, attempts)
    release(new)
    return len(touched)


def alerts_for_date(df: DataFrame, date: str) -> DataFrame:
    """All alerts of one EventDate in a frame (``read_alerts`` with a date prunes the store)."""
    return df.where(F.col("EventDate") == F.lit(date))


def delete_alerts(df: DataFrame, keys: DataFrame) -> DataFrame:
    """Alerts whose AlertID is not listed in ``keys`` (anti join)."""
    return df.join(keys.select("AlertID").distinct(), "AlertID", "left_anti")


def delete_from_store(spark: SparkSession, path: str, keys: DataFrame, attempts: int = 10) -> None:
    """Remove listed alerts from the store, rewriting only their dates' folders."""
    keys = materialize(keys.select("AlertID").distinct(), "alerts-keys")

    def without(base: versioned.Version):
        touched = _touched(versioned.read(spark, path, STORE_SCHEMA, version=base).join(keys, "AlertID", "left_semi"))
        if not touched:
            return None
        rows = versioned.read(spark, path, STORE_SCHEMA, touched, base).select(*ALERT_COLUMNS)
        # A date whose last alert goes has no folder in the new version.
        written = versioned.write_data(delete_alerts(rows, keys), path, part_of())
        return [e for e in base.entries if e.part not in set(touched)] + written

    versioned.transact(spark, path, without, attempts)
    release(keys)
