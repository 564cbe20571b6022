"""Score files: headerless CSV or JSON Lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import SCORE_COLUMNS

CSV_SUFFIXES = ("csv", "out")
JSON_SUFFIXES = ("json", "jsonl")


def write_scores(df: DataFrame, path: str, accept: str = "text/csv") -> None:
    cols = df.select(*SCORE_COLUMNS)
    if accept == "text/csv":
        cols.write.mode("overwrite").option("header", "false").csv(path)
    elif accept == "application/jsonlines":
        cols.write.mode("overwrite").json(path)
    else:
        raise ValueError(f"Unsupported accept type: {accept}")


SCORE_DDL = ("apartment_id string, building_id string, event_date string, "
             "anomaly_score_combined string, _corrupt_record string")


def parse_score_lines(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """CSV text lines -> the four text fields + ``_corrupt_record``.

    ``from_csv`` sees the whole line, so quoting is honoured and a line with
    fewer or more than four fields is flagged in ``_corrupt_record`` (a blank
    line counts as malformed too). Parsing each line whole avoids the CSV
    reader's column pruning, which can hide malformed lines.
    """
    v = F.col(value_col)
    parsed = F.from_csv(v, SCORE_DDL, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"})
    blank = F.trim(v) == ""
    return lines.select(
        *[parsed[c].alias(c) for c in ("apartment_id", "building_id", "event_date", "anomaly_score_combined")],
        F.when(blank, v).otherwise(parsed["_corrupt_record"]).alias("_corrupt_record"),
        *[c for c in lines.columns if c != value_col])


def _suffix_glob(suffixes) -> str:
    return "*.{" + ",".join(suffixes) + "}"


def unread_files(spark: SparkSession, path: str, read: DataFrame, suffixes=CSV_SUFFIXES) -> DataFrame:
    """(source_file, bytes) of the non-empty files under ``path`` from which ``read`` has no row.

    Lists the files without opening them. After a read with ``skip_unreadable`` these are the ones
    that were skipped.
    """
    files = (spark.read.format("binaryFile").option("pathGlobFilter", _suffix_glob(suffixes))
             .option("recursiveFileLookup", "true").load(path).where("length > 0")
             .select(F.col("path").alias("source_file"), F.col("length").alias("bytes")))
    return files.join(read.select("source_file").distinct(), "source_file", "left_anti")


def read_scores(spark: SparkSession, path: str, suffixes=CSV_SUFFIXES, skip_unreadable: bool = False) -> DataFrame:
    """Score text rows from every file under ``path`` whose name ends in one of
    ``suffixes`` (so ``.csv.out`` matches too). All fields stay text; a line
    without exactly four fields has ``_corrupt_record`` set. ``source_file``
    is the file the row came from. A file that cannot be read fails the job, unless
    ``skip_unreadable`` isolates the fault: then report what was skipped with ``unread_files``.
    """
    lines = (spark.read.option("pathGlobFilter", _suffix_glob(suffixes)).option("recursiveFileLookup", "true")
             .option("ignoreCorruptFiles", str(skip_unreadable).lower()).text(path)
             .select("value", F.col("_metadata.file_path").alias("source_file")))
    return parse_score_lines(lines)


def read_scores_jsonl(spark: SparkSession, path: str) -> DataFrame:
    """JSON Lines scores in the same text shape as ``read_scores``."""
    df = (spark.read.schema("apartment_id string, building_id string, event_date string, "
                            "anomaly_score_combined string, _corrupt_record string")
          .option("mode", "PERMISSIVE").option("pathGlobFilter", "*.{json,jsonl}")
          .option("recursiveFileLookup", "true").json(path))
    return df.select("*", F.col("_metadata.file_path").alias("source_file"))
