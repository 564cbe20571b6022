"""Latest-row selection: newest feature row per key, newest approved model per group."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FEATURE_KEYS = ("apartment_record_id", "building_id", "event_date")


def latest_per_key(df: DataFrame, keys, order_cols) -> DataFrame:
    """Keep, per ``keys``, the row that is greatest under ``order_cols`` (column
    names, compared in order, greatest first; nulls lose).

    Written as ``max(struct(order..., rest...))`` per key: an aggregate with a
    map-side partial step, so a key holding a large share of the rows is
    reduced inside each task before the shuffle (a row_number window would
    sort all of that key's rows in one task).
    """
    keys, order_cols = list(keys), list(order_cols)
    rest = [c for c in df.columns if c not in keys and c not in order_cols]
    packed = F.struct(*[F.col(c) for c in order_cols], *[F.col(c) for c in rest])
    m = df.groupBy(*keys).agg(F.max(packed).alias("_best"))
    return m.select(*[F.col(c) if c in keys else F.col(f"_best.{c}").alias(c) for c in df.columns])


def latest_features(features: DataFrame, keys=FEATURE_KEYS) -> DataFrame:
    """Feature store view: newest ``event_time`` per (apartment, building, day)."""
    return latest_per_key(features, keys, ["event_time"])


def latest_approved(registry: DataFrame, group_col: str = "group_name", status_col: str = "status",
                    time_col: str = "creation_time", id_col: str = "package_id",
                    approved: str = "Approved") -> DataFrame:
    """Per model group, the newest package whose status is ``approved``.

    Groups without an approved package are absent; ``require_one`` turns
    that into an error for a single-group lookup.
    """
    a = registry.where(F.col(status_col) == F.lit(approved))
    return latest_per_key(a, [group_col], [time_col, id_col])


def require_one(df: DataFrame, what: str) -> DataFrame:
    """Fail when ``df`` is empty (one cheap ``limit(1)`` job)."""
    if df.isEmpty():
        raise ValueError(f"Nothing approved yet in model group {what}")
    return df
