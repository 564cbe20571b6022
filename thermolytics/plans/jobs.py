"""End-to-end jobs: ingest, train, evaluate, score, alert.

Each job reads its inputs, composes operators and writes its outputs; the
intermediate Parquet tables are the restart points of a workflow.
"""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.alerts import DEFAULT_THRESHOLD, alert_counts, dedupe_alerts, make_alerts, parse_scores
from ..operators.clean import clean_meter
from ..operators.dedup import latest_features
from ..operators.evaluate import evaluate
from ..operators.strategy import fit, save_model, score
from ..schemas import MODEL_FEATURES, SCORE_COLUMNS
from ..session import scratch
from ..sources.alerts_store import upsert_alerts
from ..sources.features import read_features, write_features
from ..sources.meter import read_meter, read_raw_meter, read_weather, write_meter
from ..sources.meter_batches import write_batch
from ..sources.reports import write_report
from ..sources.scores import read_scores
from .features import inference_features, training_features

log = logging.getLogger(__name__)


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    """First ``n`` rows for a look at the output (a separate job; never inside a pipeline)."""
    return df.limit(n)


def ingest(spark: SparkSession, source, dest: str, table: str | None = None, batch: str | None = None) -> dict:
    """Raw JSON -> cleaned, partitioned meter table (append). Counts of rows read and written come
    from observations on the write, not from extra passes. With an id ``batch``, ``dest`` is a table of
    replayable batches (``meter_batches``): running the job again replaces the batch."""
    read, written = Observation("ingest-read"), Observation("ingest-written")
    raw = read_raw_meter(spark, source).observe(read, F.count(F.lit(1)).alias("rows_read"))
    clean = clean_meter(raw).observe(written, F.count(F.lit(1)).alias("rows_written"))
    if batch is None:
        write_meter(clean, dest, table)
    else:
        write_batch(spark, clean, dest, batch)
    return read.get | written.get


def build_training_features(spark: SparkSession, meter_path: str, weather_path: str, start, end,
                            out_path: str, **kw) -> None:
    with scratch(spark):
        f = training_features(read_meter(spark, meter_path), read_weather(spark, weather_path), start, end, **kw)
        write_features(f, out_path)


def build_inference_features(spark: SparkSession, meter_path: str, weather_path: str, date, **kw) -> DataFrame:
    return inference_features(read_meter(spark, meter_path), read_weather(spark, weather_path), date, **kw)


def train(spark: SparkSession, features_path: str, model_path: str, strategy: str = "LR_LOF",
          feature_columns=MODEL_FEATURES, **params) -> None:
    """Feature store (newest row per key) -> fitted model tables. Fails on a store without rows."""
    feats = latest_features(read_features(spark, features_path))
    if feats.isEmpty():
        raise ValueError(f"The feature store {features_path} has no rows to train on")
    with scratch(spark):
        model = fit(strategy, feats, feature_columns=list(feature_columns), **params)
        save_model(model, model_path)


def evaluate_job(model, eval_features: DataFrame, labels: DataFrame | None, report_path: str | None = None,
                 q: float = 0.95) -> DataFrame:
    """Score held-out rows with the model and build the evaluation report."""
    scored = score(model, eval_features)
    rep = evaluate(scored, labels, q=q)
    if report_path:
        write_report(rep, report_path)
    return rep


def score_job(model, features: DataFrame) -> DataFrame:
    """Scoring rows -> (apartment_id, building_id, event_date, anomaly_score_combined)."""
    return score(model, features).select(*SCORE_COLUMNS)


def alerts_job(spark: SparkSession, scores_path: str, store_path: str | None = None,
               threshold: float = DEFAULT_THRESHOLD, alert_time=None):
    """Score files -> alerts (de-duplicated) -> optional upsert; returns (alerts, counts, rejects)."""
    good, bad = parse_scores(read_scores(spark, scores_path))
    alerts = dedupe_alerts(make_alerts(good, threshold, alert_time))
    counts = alert_counts(good, bad, threshold)
    if store_path:
        upsert_alerts(spark, alerts, store_path)
    return alerts, counts, bad
