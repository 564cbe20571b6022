"""Incremental jobs: bookmark semantics of the streaming checkpoint."""

import json
import os

from thermolytics.schemas import METER
from thermolytics.streaming.alert_stream import stream_alerts
from thermolytics.streaming.ingest_stream import ingest_incremental
from thermolytics.sources.alerts_store import read_alerts


def raw_line(ts, meter):
    return json.dumps({"timestamp_str": ts, "meter_id": meter, "apartment_id": "a", "building_id": "b",
                       "energy_kwh": 1.0, "room_temp_c": 20.0, "setpoint_temp_c": 21.0, "hot_water_litres": 1.0,
                       "extra": "x"})


def test_ingest_only_new_files(spark, tmp_dir):
    src, dest, cp = f"{tmp_dir}/raw", f"{tmp_dir}/meter", f"{tmp_dir}/cp"
    os.makedirs(src)
    with open(f"{src}/1.json", "w") as f:
        f.write("\n".join([raw_line("2024-01-15 10:00:00", "m1"), raw_line("bad", "m2"),
                           raw_line("2024-01-16 10:00:00", None)]))
    ingest_incremental(spark, src, dest, cp)
    assert spark.read.schema(METER).parquet(dest).count() == 1
    ingest_incremental(spark, src, dest, cp)               # nothing new: nothing added
    assert spark.read.schema(METER).parquet(dest).count() == 1
    with open(f"{src}/2.json", "w") as f:
        f.write(raw_line("2024-01-17 10:00:00", "m3"))
    ingest_incremental(spark, src, dest, cp)
    rows = spark.read.schema(METER).parquet(dest).collect()
    assert sorted(r.meter_id for r in rows) == ["m1", "m3"]
    assert {(r.year, r.month, r.day) for r in rows} == {(2024, 1, 15), (2024, 1, 17)}


def test_stream_alerts_once_per_file(spark, tmp_dir):
    src, store, cp = f"{tmp_dir}/scores", f"{tmp_dir}/store", f"{tmp_dir}/cp"
    os.makedirs(src)
    with open(f"{src}/a.csv", "w") as f:
        f.write("apt1,b,2024-01-18,6.5\napt2,b,2024-01-18,1.0\n")
    stream_alerts(spark, src, store, cp, 5.0, "t1")
    with open(f"{src}/b.out", "w") as f:
        f.write("apt3,b,2024-01-19,9.0\nbroken\n")
    stream_alerts(spark, src, store, cp, 5.0, "t2")
    got = {r.AlertID: r.AlertTimestamp for r in read_alerts(spark, store).collect()}
    assert got == {"apt1#2024-01-18": "t1", "apt3#2024-01-19": "t2"}


def test_ingest_finds_nested_files(spark, tmp_dir):
    src, dest, cp = f"{tmp_dir}/raw", f"{tmp_dir}/meter", f"{tmp_dir}/cp"
    os.makedirs(f"{src}/2024/01")
    for path, meter in ((f"{src}/top.json", "m1"), (f"{src}/2024/01/deep.json", "m2")):
        with open(path, "w") as f:
            f.write(raw_line("2024-01-15 10:00:00", meter))
    ingest_incremental(spark, src, dest, cp, table="meter_nested_test")
    assert sorted(r.meter_id for r in spark.read.schema(METER).parquet(dest).collect()) == ["m1", "m2"]
    with open(f"{src}/2024/01/more.json", "w") as f:
        f.write(raw_line("2024-02-20 10:00:00", "m3"))
    ingest_incremental(spark, src, dest, cp, table="meter_nested_test")
    got = spark.table("meter_nested_test").where("month = 2").collect()
    spark.sql("DROP TABLE meter_nested_test")
    assert [(r.meter_id, r.day) for r in got] == [("m3", 20)]


def test_stream_keeps_rejects_and_counts(spark, tmp_dir):
    src, store, cp, bad, counts = (f"{tmp_dir}/{n}" for n in ("scores", "store", "cp", "bad", "counts"))
    os.makedirs(f"{src}/deep")
    with open(f"{src}/a.csv", "w") as f:
        f.write("apt1,b,2024-01-18,6.5\napt2,b,2024-01-18,x\nshort\napt4,b,2024-01-18,\n")
    with open(f"{src}/deep/b.jsonl", "w") as f:
        f.write('{"apartment_id": "apt3", "building_id": "b", "event_date": "2024-01-19", "anomaly_score_combined": 9.5}\n{broken\n')
    stream_alerts(spark, src, store, cp, 5.0, "t1", rejects_path=bad, counts_path=counts)
    assert {r.AlertID for r in read_alerts(spark, store).collect()} == {"apt1#2024-01-18", "apt3#2024-01-19"}
    assert sorted(r.reason for r in spark.read.parquet(bad).collect()) == ["field count", "field count", "no score", "unparsable score"]
    got = {r.source_file.rsplit("/", 1)[1]: (r.rows_parsed, r.rows_rejected, r.alerts_generated)
           for r in spark.read.parquet(counts).collect()}
    assert got == {"a.csv": (1, 3, 1), "b.jsonl": (1, 1, 1)}
