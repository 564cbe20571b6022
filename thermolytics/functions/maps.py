"""String maps: a row or a map of values under a key prefix, as model metadata is kept."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def text_map(columns: dict[str, Column]) -> Column:
    """map<string,string> of the columns that are not null."""
    pairs = [p for k, c in columns.items() for p in (F.lit(k), c.cast("string"))]
    return F.map_filter(F.create_map(*pairs), lambda k, v: v.isNotNull())


def prefixed(m: Column, prefix: str) -> Column:
    """The map with ``prefix`` before each key."""
    return F.transform_keys(m, lambda k, v: F.concat(F.lit(prefix), k))


def model_properties(params: Column, metrics: Column, **fixed: str) -> Column:
    """One map of a model's lineage: fixed entries, ``Hyperparameter_*`` and ``Evaluation_*``."""
    own = F.create_map(*[F.lit(x) for kv in fixed.items() for x in kv]) if fixed else None
    parts = [prefixed(params, "Hyperparameter_"), prefixed(metrics, "Evaluation_")]
    return F.map_concat(*([own] if own is not None else []), *parts)
