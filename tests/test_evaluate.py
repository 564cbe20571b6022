"""Evaluation report, throughput and gate."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from thermolytics.operators.evaluate import evaluate, gate, throughput

SCORES = [("apt1", dt.date(2024, 1, 18), 2.1), ("apt1", dt.date(2024, 1, 19), 6.0),
          ("apt2", dt.date(2024, 1, 17), 5.5), ("apt2", dt.date(2024, 1, 18), 3.05)]
SCHEMA = "apartment_record_id string, event_date date, anomaly_score_combined double"
LABELS = [("apt1", dt.date(2024, 1, 19), 1), ("apt2", dt.date(2024, 1, 17), 0), ("apt2", dt.date(2024, 1, 17), 0)]


def test_report_with_labels(spark):
    s = spark.createDataFrame(SCORES, SCHEMA)
    lab = spark.createDataFrame(LABELS, "apartment_record_id string, event_date date, is_anomaly int")
    r = evaluate(s, lab).first()
    assert r.score_mean == pytest.approx(4.1625)
    assert r.score_stddev == pytest.approx(1.884752, abs=1e-6)
    assert (r.score_min, r.score_max, r.num_records_evaluated) == (2.1, 6.0, 4)
    assert r.threshold_used == pytest.approx(5.925)
    assert (r.precision, r.recall, r.f1_score) == (1.0, 1.0, 1.0)
    assert r.status == "Success"


def test_report_without_labels_and_empty(spark):
    s = spark.createDataFrame(SCORES, SCHEMA)
    r = evaluate(s).first()
    assert r.precision is None and r.status == "Success"
    e = evaluate(spark.createDataFrame([], SCHEMA)).collect()
    assert len(e) == 1 and e[0].status == "NoData" and e[0].num_records_evaluated == 0


def test_nan_scores_never_predicted(spark):
    s = spark.createDataFrame(SCORES + [("apt3", dt.date(2024, 1, 18), float("nan"))], SCHEMA)
    lab = spark.createDataFrame(LABELS, "apartment_record_id string, event_date date, is_anomaly int")
    from thermolytics.operators.evaluate import label_metrics
    thr = spark.createDataFrame([(5.9,)], "threshold_used double")
    r = label_metrics(s, lab, thr).first()
    assert (r.precision, r.recall) == (1.0, 1.0)


def test_throughput_edges(spark):
    assert throughput(50, 10) == 5.0
    assert throughput(0, 10) == 0.0
    assert throughput(5, 0) == float("inf")
    df = spark.createDataFrame([(50, 10.0), (0, 0.0), (5, 0.0)], "r long, s double")
    got = [r.t for r in df.select(throughput(F.col("r"), F.col("s")).alias("t")).collect()]
    assert got == [5.0, 0.0, float("inf")]


def test_gate(spark):
    rows = [("m", 1, 0.7, 100.0), ("m", 2, 0.5, 110.0), ("m", 3, 0.8, 200.0), ("m", 4, None, float("inf")),
            ("m", 5, 0.9, 10.0)]
    df = spark.createDataFrame(rows, "model_group string, run_id int, f1_score double, throughput double")
    g = {r.run_id: r for r in gate(df).collect()}
    assert g[1].passed and g[1].reasons == ""
    assert not g[2].passed and g[2].reasons == "f1 below minimum"
    assert not g[3].passed and "throughput" in g[3].reasons
    assert not g[4].passed                       # infinite vs finite previous
    assert g[5].passed                           # previous infinite: no finite reference


def metrics(spark, rows, labels, threshold):
    from thermolytics.operators.evaluate import label_metrics
    s = spark.createDataFrame(rows, "apartment_record_id string, event_date string, anomaly_score_combined double")
    lab = spark.createDataFrame(labels, "apartment_record_id string, event_date string, is_anomaly int")
    thr = spark.createDataFrame([(threshold,)], "threshold_used double").groupBy().max("threshold_used") \
        .withColumnRenamed("max(threshold_used)", "threshold_used")
    return tuple(label_metrics(s, lab, thr).first())


def test_unscored_anomalies_are_misses(spark):
    labels = [("a", "d", 1), ("b", "d", 1), ("c", "d", 1), ("e", "d", 0)]
    rows = [("a", "d", 9.0), ("b", "d", None), ("c", "d", float("nan")), ("e", "d", 1.0)]
    assert metrics(spark, rows, labels, 5.0) == pytest.approx((1.0, 1 / 3, 0.5))


def test_negative_thresholds(spark):
    assert metrics(spark, [("a", "d", -1.0), ("b", "d", -0.5), ("c", "d", -3.0)], [("a", "d", 1), ("b", "d", 1)], -2.0) == (1.0, 1.0, 1.0)


def test_an_empty_label_table_gives_no_metrics(spark):
    assert metrics(spark, [("a", "d", 9.0)], [], 5.0) == (None, None, None)


def test_threshold_join_has_no_broadcast_hint(spark):
    from thermolytics.operators.evaluate import label_metrics, score_threshold
    s = spark.createDataFrame([("a", "d", 1.0)], "apartment_record_id string, event_date string, anomaly_score_combined double")
    lab = spark.createDataFrame([("a", "d", 1)], "apartment_record_id string, event_date string, is_anomaly int")
    plan = label_metrics(s, lab, score_threshold(s, group_cols=["event_date"], exact=False), group_cols=["event_date"])
    assert "hint" not in plan._jdf.queryExecution().logical().toString().lower()
