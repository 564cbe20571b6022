"""Optional labels."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.utils import AnalysisException

from ..schemas import LABEL

log = logging.getLogger(__name__)


def read_labels(spark: SparkSession, path: str | None) -> DataFrame | None:
    """Label table, or None when no path is given or it cannot be read
    (evaluation then goes on without label metrics)."""
    if not path:
        return None
    try:
        df = spark.read.parquet(path)
        return df.select(*[df[f.name].cast(f.dataType).alias(f.name) for f in LABEL.fields])
    except AnalysisException as exc:
        log.warning("Could not load labels from %s: %s; proceeding without them", path, exc)
        return None
