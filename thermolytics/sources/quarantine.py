"""Per-file fault isolation: files that cannot be read are set aside with a reason and tried again later.

The quarantine is a versioned table (``versioned``) with one row per file:
(source_file, reason, tries, first_tried, last_tried, status), status being ``open`` or ``recovered``.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import versioned
from ..operators.dedup import latest_per_key
from ..session import materialize

SCHEMA = ("source_file string, reason string, tries long, first_tried string, last_tried string, status string")
OPEN, RECOVERED = "open", "recovered"
#: Error conditions of Spark's readers that concern one file.
FAULT = re.compile(r"PATH_NOT_FOUND|FAILED_READ_FILE\.?\w*|CANNOT_LOAD_\w+|MALFORMED_\w+")
CAUSE = re.compile(r"Caused by: ([\w.$]+(?:Exception|Error))(?:: ([^\n]{0,200}))?")


def fault_of(error: Exception) -> str | None:
    """Why a file could not be read, or None if the error is of another kind."""
    text = str(error)
    kind = FAULT.search(text)
    if not kind:
        return None
    cause = CAUSE.findall(text)
    return f"{kind[0]}: {cause[-1][0].rsplit('.', 1)[-1]} {cause[-1][1]}".strip() if cause else kind[0]


def read_apart(files: Sequence[str], read: Callable[[list[str]], DataFrame], name: str = "files") -> tuple[list[DataFrame], dict[str, str]]:
    """(staged frames, {file: reason}): ``read`` of all ``files`` that can be read whole, and why the others cannot.

    All files are read and staged in one job. Only if that fails on a file are they halved, so ``b`` bad
    files among ``n`` cost some ``b * log2(n)`` jobs more. A file with a good beginning and a bad end gives
    nothing. Errors that no file is to blame for are raised.
    """
    if not files:
        return [], {}
    try:
        return [materialize(read(list(files)), name)], {}
    except Exception as error:
        reason = fault_of(error)
        if reason is None:
            raise
        if len(files) == 1:
            return [], {files[0]: reason}
    half = len(files) // 2
    good, bad = read_apart(files[:half], read, name)
    more, worse = read_apart(files[half:], read, name)
    return good + more, bad | worse


def entries(spark: SparkSession, path: str, status: str | None = None) -> DataFrame:
    """The quarantine's rows, or those of one status."""
    df = versioned.read(spark, path, SCHEMA)
    return df if status is None else df.where(F.col("status") == status)


def record(spark: SparkSession, path: str, bad: dict[str, str], recovered: Sequence[str], when: str) -> None:
    """Note one attempt at some files: ``bad`` ones with their reason, and formerly bad ones that were read now.

    The same attempt (``when``) noted twice counts once. In the driver: the files of one attempt.
    """
    if not bad and not recovered:
        return
    rows = [(f, r, OPEN) for f, r in bad.items()] + [(f, None, RECOVERED) for f in recovered]
    new = spark.createDataFrame([(f, r, 1, when, when, s) for f, r, s in rows], SCHEMA)

    def noted(base: versioned.Version):
        old = versioned.read(spark, path, SCHEMA, version=base)
        seen = old.select("source_file", F.col("reason").alias("_reason"), "tries", "first_tried", F.col("last_tried").alias("_last"))
        again = new.drop("tries", "first_tried").join(seen, "source_file", "left")
        fresh = F.coalesce(F.col("_last") != F.col("last_tried"), F.lit(True)).cast("long")
        again = again.select("source_file", F.coalesce("reason", "_reason").alias("reason"),
                             (F.coalesce("tries", F.lit(0)) + fresh).alias("tries"),
                             F.coalesce("first_tried", "last_tried").alias("first_tried"), "last_tried", "status")
        merged = latest_per_key(old.withColumn("_n", F.lit(0)).unionByName(again.withColumn("_n", F.lit(1))), ["source_file"], ["_n"])
        return versioned.write_data(merged.drop("_n"), path, F.lit("files"))

    versioned.transact(spark, path, noted)
