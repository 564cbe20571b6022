"""Meter table of replayable batches, a versioned table (``versioned``) with one part per day.

Each batch of readings has an id. Writing a batch again replaces what it wrote before, whatever days
that was and whether or not it has been compacted since, so a job that is run twice leaves one copy. Small
folders of a day are merged by ``compact``; rows keep their batch id (column ``batch``).
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import versioned
from ..functions.dates import date_range_predicate, validate_date
from ..schemas import METER_COLUMNS

SCHEMA = ("event_ts timestamp, meter_id string, apartment_id string, building_id string, energy_kwh double, room_temp_c double, "
          "setpoint_temp_c double, hot_water_litres double, year int, month int, day int, batch string")


def _day():
    return F.format_string("%04d-%02d-%02d", "year", "month", "day")


def write_batch(spark: SparkSession, df: DataFrame, path: str, batch: str) -> versioned.Version:
    """Write the cleaned readings ``df`` as the rows of ``batch``, in place of any that it has."""
    rows = df.select(*METER_COLUMNS, F.lit(batch).alias("batch"))
    written: list[versioned.Entry] = []

    def replaced(base: versioned.Version):
        if not written:         # once, also when another writer makes this one begin again
            written.extend(versioned.write_data(rows, path, _day(), [batch]))
        entries = [e for e in base.entries if batch not in e.tags] + written
        # Folders that hold other batches as well are written anew without this one's rows.
        for e in [e for e in base.entries if batch in e.tags and len(e.tags) > 1]:
            others = spark.read.schema(SCHEMA).parquet(f"{path.rstrip('/')}/{e.folder}").where(F.col("batch") != batch)
            entries += versioned.write_data(others, path, F.lit(e.part), [t for t in e.tags if t != batch])
        return entries

    return versioned.transact(spark, path, replaced)


def compact(spark: SparkSession, path: str, days: Iterable[str] | None = None, folders: int = 2) -> int:
    """Merge the folders of each day (of ``days``) that has at least ``folders`` of them; returns the number of days."""
    wanted = None if days is None else set(days)
    merged: list[str] = []

    def one_folder_each(base: versioned.Version):
        many = {d: es for d, es in base.parts().items() if len(es) >= folders and (wanted is None or d in wanted)}
        merged[:] = many
        if not many:
            return None
        rows = versioned.read(spark, path, SCHEMA, many, base)
        new = versioned.write_data(rows, path, _day())
        tags = {d: tuple(sorted({t for e in es for t in e.tags})) for d, es in many.items()}
        return [e for e in base.entries if e.part not in many] + [versioned.Entry(e.part, e.folder, tags[e.part]) for e in new]

    versioned.transact(spark, path, one_folder_each)
    return len(merged)


def read_batches(spark: SparkSession, path: str, start=None, end=None) -> DataFrame:
    """The readings (METER columns), optionally of whole days [start, end]: only those days' folders are opened."""
    days = None
    if start is not None:
        first, last = validate_date(start), validate_date(end or start)
        days = [(first + timedelta(i)).isoformat() for i in range((last - first).days + 1)]
    df = versioned.read(spark, path, SCHEMA, days).select(*METER_COLUMNS)
    return df if start is None else df.where(date_range_predicate("event_ts", start, end or start, df.columns))


def batches(spark: SparkSession, path: str) -> list[str]:
    """Ids of the batches that the table holds rows of."""
    return sorted({t for e in versioned.current(spark, path).entries for t in e.tags})
