"""End-to-end jobs: raw JSON -> meter table -> features -> model -> evaluation -> scores -> alerts."""

import json
import os

from pyspark.sql import functions as F

from tests.conftest import SF
from thermolytics.plans import jobs
from thermolytics.schemas import SCORE_COLUMNS
from thermolytics.sources import testviews as tv
from thermolytics.sources.alerts_store import read_alerts
from thermolytics.sources.reports import read_report
from thermolytics.sources.scores import write_scores
from thermolytics.operators.strategy import load_model


def test_jobs_end_to_end(spark, tmp_dir):
    raw_dir = f"{tmp_dir}/raw/2024/01"
    os.makedirs(raw_dir)
    rows = tv.raw(spark, SF).collect()
    with open(f"{raw_dir}/part.json", "w") as f:
        for r in rows:
            f.write(json.dumps(r.asDict()) + "\n")
    counts = jobs.ingest(spark, f"{tmp_dir}/raw", f"{tmp_dir}/meter")
    assert counts["rows_written"] == sum(1 for r in rows if r.meter_id and not r.timestamp_str.startswith("0"))
    tv.weather(spark, SF).write.parquet(f"{tmp_dir}/weather")

    jobs.build_training_features(spark, f"{tmp_dir}/meter", f"{tmp_dir}/weather", "2024-01-01", "2024-01-20",
                                 f"{tmp_dir}/features", event_time=F.lit("2024-02-01 00:00:00").cast("timestamp"))
    jobs.train(spark, f"{tmp_dir}/features", f"{tmp_dir}/model", lof_neighbors=5, within="building_id")
    model = load_model(spark, f"{tmp_dir}/model")

    held_out = jobs.build_inference_features(spark, f"{tmp_dir}/meter", f"{tmp_dir}/weather", "2024-01-24")
    labels = tv.labels(spark, SF)
    rep = jobs.evaluate_job(model, held_out.withColumnRenamed("apartment_id", "apartment_record_id"), labels,
                            f"{tmp_dir}/report")
    r = read_report(spark, f"{tmp_dir}/report").first()
    assert r.status == "Success" and r.num_records_evaluated == held_out.count() > 0
    assert 0.0 <= r.f1_score <= 1.0 and rep.count() == 1

    scores = jobs.score_job(model, held_out)
    assert scores.columns == SCORE_COLUMNS
    assert scores.where("anomaly_score_combined IS NULL").count() == 0
    write_scores(scores, f"{tmp_dir}/scores")
    alerts, counts, bad = jobs.alerts_job(spark, f"{tmp_dir}/scores", f"{tmp_dir}/alerts", 5.0, "t")
    n_hi = scores.where("anomaly_score_combined > 5.0").count()
    assert alerts.count() == n_hi == read_alerts(spark, f"{tmp_dir}/alerts").count()
    assert bad.count() == 0
