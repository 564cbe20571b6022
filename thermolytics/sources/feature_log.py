"""Feature store with incremental newest rows, a versioned table (``versioned``) with one part per event_date.

A run's feature rows are appended as a delta. ``compact`` merges the deltas of the dates that have any into one
base folder per date, which holds the newest row of each key. Reading the newest rows scans the base folders
as they are, and aggregates only the dates that have deltas: as a key names its date, no row of another
date can replace it. So a training run reads the whole history without aggregating or shuffling it.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import versioned
from ..operators.dedup import latest_features
from ..schemas import FEATURE, FEATURE_COLUMNS
from ..session import materialize, release

SCHEMA = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in FEATURE)
BASE = "base"
NO_DATE = "none"


def _date():
    return F.coalesce(F.col("event_date").cast("string"), F.lit(NO_DATE))


def append_features(spark: SparkSession, df: DataFrame, path: str, run: str, reject_path: str | None = None) -> versioned.Version:
    """Add the feature rows of one run. Written again, a run replaces its delta, or, where that has been compacted, is
    merged once more, which changes nothing.

    Rows without a record id or event time cannot be keyed; they go to ``reject_path`` (when given), one folder per run.
    """
    if run == BASE:
        raise ValueError(f"a run cannot be named {BASE!r}")
    ok = F.col("apartment_record_id").isNotNull() & F.col("event_time").isNotNull()
    tagged = df.select(*FEATURE_COLUMNS).withColumn("_ok", ok)
    if reject_path:
        tagged = materialize(tagged, "features")
    written = versioned.write_data(tagged.where("_ok").drop("_ok"), path, _date(), [run])
    out = versioned.transact(spark, path, lambda base: [e for e in base.entries if e.tags != (run,)] + written)
    if reject_path:
        tagged.where("NOT _ok").drop("_ok").write.mode("overwrite").parquet(f"{reject_path.rstrip('/')}/run={run}")
        release(tagged)
    return out


def _settled(entries: list[versioned.Entry]) -> bool:
    return len(entries) == 1 and entries[0].tags == (BASE,)


def latest(spark: SparkSession, path: str, dates: Iterable[str] | None = None, version: versioned.Version | None = None) -> DataFrame:
    """Newest row per (apartment, building, day), of all dates or of some (texts yyyy-MM-dd)."""
    version = version or versioned.current(spark, path)
    wanted = None if dates is None else {str(d) for d in dates}
    parts = {d: es for d, es in version.parts().items() if wanted is None or d in wanted}
    done = [d for d, es in parts.items() if _settled(es)]
    open_ = [d for d in parts if d not in set(done)]
    if not open_:
        return versioned.read(spark, path, SCHEMA, done, version)
    newest = latest_features(versioned.read(spark, path, SCHEMA, open_, version))
    return versioned.read(spark, path, SCHEMA, done, version).unionByName(newest) if done else newest


def compact(spark: SparkSession, path: str, dates: Iterable[str] | None = None) -> int:
    """Merge the deltas of the dates (of ``dates``) that have any into their base; returns the number of dates. Only these
    dates are read."""
    wanted = None if dates is None else {str(d) for d in dates}
    touched: list[str] = []

    def merged(base: versioned.Version):
        touched[:] = [d for d, es in base.parts().items() if not _settled(es) and (wanted is None or d in wanted)]
        if not touched:
            return None
        new = versioned.write_data(latest(spark, path, touched, base), path, _date(), [BASE])
        return [e for e in base.entries if e.part not in set(touched)] + new

    versioned.transact(spark, path, merged)
    return len(touched)
