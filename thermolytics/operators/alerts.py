"""Score rows -> de-duplicated alerts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import gt_not_nan
from .dedup import latest_per_key

DEFAULT_THRESHOLD = 5.0


def parse_scores(text: DataFrame, source_col: str = "source_file") -> tuple[DataFrame, DataFrame]:
    """Split score text rows into (parsed, rejected).

    Input columns: apartment_id, building_id, event_date, anomaly_score_combined
    (all text), ``_corrupt_record`` (set by the CSV reader when a line does
    not have exactly four fields) and ``source_col``.
    A row is rejected when it is malformed, its score does not parse as a
    number, or the score is NaN or infinite (no decimal form). A row whose score is
    empty was not scored (its group is not in the fitted model) and has a reason of its
    own. Rejects keep their text and a reason.
    """
    score = F.col("anomaly_score_combined").try_cast("double")
    malformed = F.col("_corrupt_record").isNotNull()
    reason = (F.when(malformed, F.lit("field count"))
              .when(F.trim(F.coalesce("anomaly_score_combined", F.lit(""))) == "", F.lit("no score"))
              .when(score.isNull(), F.lit("unparsable score"))
              .when(F.isnan(score) | (F.abs(score) == F.lit(float("inf"))), F.lit("non-finite score")))
    tagged = text.withColumn("_reason", reason)
    good = tagged.where(F.col("_reason").isNull()).select(
        F.coalesce(F.col("apartment_id"), F.lit("")).alias("apartment_id"),
        F.coalesce(F.col("building_id"), F.lit("")).alias("building_id"),
        F.coalesce(F.col("event_date"), F.lit("")).alias("event_date"),
        score.alias("anomaly_score_combined"),
        F.col(source_col).alias("source_file"))
    bad = tagged.where(F.col("_reason").isNotNull()).select(
        "apartment_id", "building_id", "event_date", "anomaly_score_combined", "_corrupt_record",
        F.col(source_col).alias("source_file"), F.col("_reason").alias("reason"))
    return good, bad


def make_alerts(scores: DataFrame, threshold: float = DEFAULT_THRESHOLD, alert_time=None,
                status: str = "Unseen") -> DataFrame:
    """Alert rows for ``score > threshold`` (strict; NaN never alerts).

    AlertID = apartment#date. ``alert_time`` (ISO text) defaults to the
    processing time in UTC. Scores stay double here; the store casts them
    to decimal.
    """
    ts = (F.lit(alert_time) if alert_time is not None
          else F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))
    hit = scores.where(gt_not_nan("anomaly_score_combined", threshold))
    return hit.select(
        F.concat_ws("#", "apartment_id", "event_date").alias("AlertID"),
        F.col("apartment_id").alias("ApartmentID"),
        F.col("event_date").alias("EventDate"),
        F.col("building_id").alias("BuildingID"),
        F.col("anomaly_score_combined").alias("AnomalyScore"),
        F.lit(float(threshold)).alias("Threshold"),
        ts.alias("AlertTimestamp"),
        F.lit(status).alias("Status"),
        F.col("source_file").alias("S3SourceFile"),
    )


def dedupe_alerts(alerts: DataFrame) -> DataFrame:
    """One alert per AlertID within a run: highest score, then source file, wins."""
    return latest_per_key(alerts, ["AlertID"], ["AnomalyScore", "S3SourceFile"])


def merge_alerts(existing: DataFrame, new: DataFrame) -> DataFrame:
    """Put-by-key: for each AlertID the newest AlertTimestamp wins; on a tie the new row."""
    cols = existing.columns
    u = existing.select(*cols, F.lit(0).alias("_src")).unionByName(new.select(*cols, F.lit(1).alias("_src")))
    return latest_per_key(u, ["AlertID"], ["AlertTimestamp", "_src"]).drop("_src")


def alert_counts(parsed: DataFrame, rejected: DataFrame, threshold: float = DEFAULT_THRESHOLD) -> DataFrame:
    """Per source file: rows, rejected rows and alerts (before de-duplication)."""
    p = parsed.groupBy("source_file").agg(
        F.count(F.lit(1)).alias("rows_parsed"),
        F.count_if(gt_not_nan("anomaly_score_combined", threshold)).alias("alerts_generated"))
    r = rejected.groupBy("source_file").agg(F.count(F.lit(1)).alias("rows_rejected"))
    j = p.join(r, "source_file", "full")
    return j.select("source_file",
                    F.coalesce("rows_parsed", F.lit(0)).alias("rows_parsed"),
                    F.coalesce("rows_rejected", F.lit(0)).alias("rows_rejected"),
                    F.coalesce("alerts_generated", F.lit(0)).alias("alerts_generated"))
