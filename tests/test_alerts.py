"""Score files -> alerts."""

import os

import pytest

from thermolytics.operators.alerts import alert_counts, dedupe_alerts, make_alerts, merge_alerts, parse_scores
from thermolytics.plans.jobs import alerts_job
from thermolytics.sources.alerts_store import alerts_for_date, delete_from_store, read_alerts, upsert_alerts
from thermolytics.sources.scores import read_scores

LINES = ["apt1,bldgA,2024-01-18,6.5", "apt2,bldgA,2024-01-18,3.2", "apt3,bldgB,2024-01-19,9.9",
         "apt4,bldgB,2024-01-19,invalid_score", "apt5,bldgC,2024-01-20"]
EXTRA = ["apt6,b,2024-01-20,7.0,x", "apt7,b,2024-01-20,nan", "apt8,b,2024-01-20,inf", "apt9,b,2024-01-20,1_0",
         ",bldgD,2024-01-21,8.0", "apt10,b,2024-01-21,5.0", "apt1,bldgA,2024-01-18,7.5"]


def write(path, name, lines):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w") as f:
        f.write("\n".join(lines) + ("\n" if lines else ""))


def test_plain_rows(spark, tmp_dir):
    write(tmp_dir, "scores.csv", LINES)
    write(tmp_dir, "ignored.txt", ["apt9,b,2024-01-01,99"])
    good, bad = parse_scores(read_scores(spark, tmp_dir))
    alerts = {r.AlertID: r for r in make_alerts(good, 5.0, "t").collect()}
    assert set(alerts) == {"apt1#2024-01-18", "apt3#2024-01-19"}
    a = alerts["apt1#2024-01-18"]
    assert (a.AnomalyScore, a.Status, a.Threshold, a.BuildingID) == (6.5, "Unseen", 5.0, "bldgA")
    assert sorted(r.reason for r in bad.collect()) == ["field count", "unparsable score"]


def test_no_alerts_and_empty_file(spark, tmp_dir):
    write(tmp_dir + "/a", "low.csv", ["apt1,bldgA,2024-01-18,1.5", "apt2,bldgA,2024-01-18,4.9"])
    write(tmp_dir + "/b", "empty.out", [])
    good, _ = parse_scores(read_scores(spark, tmp_dir))
    assert make_alerts(good, 5.0).count() == 0


def test_extra_rows(spark, tmp_dir):
    write(tmp_dir, "s.csv.out", LINES + EXTRA)
    good, bad = parse_scores(read_scores(spark, tmp_dir))
    reasons = {r.apartment_id: r.reason for r in bad.collect()}
    assert reasons["apt6"] == "field count"
    assert reasons["apt7"] == reasons["apt8"] == "non-finite score"
    assert reasons["apt9"] == "unparsable score"
    alerts = dedupe_alerts(make_alerts(good, 5.0, "t"))
    got = {r.AlertID: r.AnomalyScore for r in alerts.collect()}
    assert got["apt1#2024-01-18"] == 7.5          # one key twice: highest score kept
    assert "#2024-01-21" in got                   # empty id stays empty, not null
    assert "apt10#2024-01-21" not in got          # equal to the threshold: no alert
    counts = alert_counts(good, bad, 5.0).first()
    assert (counts.rows_parsed, counts.rows_rejected, counts.alerts_generated) == (6, 6, 4)


def test_merge_latest_wins(spark):
    cols = "AlertID string, ApartmentID string, EventDate string, BuildingID string, AnomalyScore double, " \
           "Threshold double, AlertTimestamp string, Status string, S3SourceFile string"
    old = spark.createDataFrame([("a#1", "a", "1", "b", 6.0, 5.0, "2024-01-01T00", "Seen", "f"),
                                 ("c#1", "c", "1", "b", 9.0, 5.0, "2024-01-01T00", "Seen", "f")], cols)
    new = spark.createDataFrame([("a#1", "a", "1", "b", 7.0, 5.0, "2024-01-02T00", "Unseen", "g")], cols)
    got = {r.AlertID: (r.AnomalyScore, r.Status) for r in merge_alerts(old, new).collect()}
    assert got == {"a#1": (7.0, "Unseen"), "c#1": (9.0, "Seen")}


def test_store_upsert_idempotent_and_delete(spark, tmp_dir):
    write(tmp_dir + "/scores", "s.csv", LINES + EXTRA)
    store = tmp_dir + "/store"
    alerts, _, _ = alerts_job(spark, tmp_dir + "/scores", store, 5.0, "2024-02-01T05:00:00")
    first = sorted(map(tuple, read_alerts(spark, store).collect()))
    upsert_alerts(spark, alerts, store)
    assert sorted(map(tuple, read_alerts(spark, store).collect())) == first
    assert read_alerts(spark, store).schema["AnomalyScore"].dataType.simpleString() == "decimal(38,18)"
    assert {r.AlertID for r in alerts_for_date(read_alerts(spark, store), "2024-01-19").collect()} == {"apt3#2024-01-19"}
    delete_from_store(spark, store, spark.createDataFrame([("apt3#2024-01-19",)], "AlertID string"))
    ids = {r.AlertID for r in read_alerts(spark, store).collect()}
    assert "apt3#2024-01-19" not in ids and "apt1#2024-01-18" in ids


def test_jsonl_scores(spark, tmp_dir):
    from thermolytics.sources.scores import read_scores_jsonl, write_scores
    df = spark.createDataFrame([("apt1", "bldgA", "2024-01-18", 6.5), ("apt2", "bldgA", "2024-01-18", 3.2)],
                               "apartment_id string, building_id string, event_date string, "
                               "anomaly_score_combined double")
    write_scores(df, f"{tmp_dir}/jl", accept="application/jsonlines")
    good, bad = parse_scores(read_scores_jsonl(spark, f"{tmp_dir}/jl"))
    assert bad.count() == 0
    assert {r.AlertID for r in make_alerts(good, 5.0).collect()} == {"apt1#2024-01-18"}
    with pytest.raises(ValueError):
        write_scores(df, f"{tmp_dir}/x", accept="text/html")


def test_store_keeps_alerts_without_a_date(spark, tmp_dir):
    from thermolytics.operators.alerts import make_alerts
    from thermolytics.sources.alerts_store import delete_from_store, read_alerts, upsert_alerts
    store = f"{tmp_dir}/store"

    def put(apartment, date, when):
        rows = spark.createDataFrame([(apartment, "b", date, 9.0, "f")],
                                     "apartment_id string, building_id string, event_date string, anomaly_score_combined double, source_file string")
        upsert_alerts(spark, make_alerts(rows, 5.0, when), store)

    for apartment, date in (("apt1", ""), ("apt9", ""), ("apt1", "2024/01=x%"), ("apt2", "2024-01-18"), ("apt1", "")):
        put(apartment, date, "t1")
    ids = {"apt1#", "apt9#", "apt1#2024/01=x%", "apt2#2024-01-18"}
    assert {r.AlertID for r in read_alerts(spark, store).collect()} == ids
    assert {r.AlertID for r in read_alerts(spark, store, "").collect()} == {"apt1#", "apt9#"}
    assert {r.AlertID for r in read_alerts(spark, store, "2024-01-18").collect()} == {"apt2#2024-01-18"}
    delete_from_store(spark, store, spark.createDataFrame([("apt1#2024/01=x%",), ("apt9#",)], "AlertID string"))
    assert {r.AlertID for r in read_alerts(spark, store).collect()} == {"apt1#", "apt2#2024-01-18"}


def test_unreadable_files_are_reported(spark, tmp_dir):
    import gzip
    import os

    from thermolytics.sources.scores import read_scores, unread_files
    os.makedirs(f"{tmp_dir}/s")
    with open(f"{tmp_dir}/s/good.csv", "w") as f:
        f.write("apt1,b,2024-01-18,6.5\n")
    with open(f"{tmp_dir}/s/bad.csv.gz", "wb") as f:
        f.write(gzip.compress(b"apt2,b,2024-01-18,6.5\n")[:12])
    with pytest.raises(Exception):
        read_scores(spark, f"{tmp_dir}/s", ("csv", "csv.gz")).count()
    df = read_scores(spark, f"{tmp_dir}/s", ("csv", "csv.gz"), skip_unreadable=True)
    assert [r.apartment_id for r in df.collect()] == ["apt1"]
    assert [r.source_file.rsplit("/", 1)[1] for r in unread_files(spark, f"{tmp_dir}/s", df, ("csv", "csv.gz")).collect()] == ["bad.csv.gz"]
