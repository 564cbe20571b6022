"""Score files that cannot be read: set aside with a reason, tried again, no other file's alerts lost."""

import gzip
import os

import pytest

from thermolytics.sources import quarantine
from thermolytics.sources.alerts_store import read_alerts
from thermolytics.sources.versioned import current
from thermolytics.streaming.alert_stream import stream_alerts

SUFFIXES = ("csv", "csv.gz", "jsonl")


def put(folder, name, data):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "wb") as f:
        f.write(data)


def line(i):
    return f"apt{i},b,2024-01-18,6.5\n".encode()


def run(spark, d, when="t", **kw):
    stream_alerts(spark, f"{d}/scores", f"{d}/store", f"{d}/cp", 5.0, when, suffixes=SUFFIXES, quarantine_path=f"{d}/quarantine",
                  counts_path=f"{d}/counts", **kw)


def apartments(spark, d):
    return sorted(r.ApartmentID for r in read_alerts(spark, f"{d}/store").collect())


def state(spark, d):
    return {r.source_file.rsplit("/", 1)[1]: (r.status, r.tries) for r in quarantine.entries(spark, f"{d}/quarantine").collect()}


def test_bad_files_wait_and_recover(spark, tmp_dir):
    src = f"{tmp_dir}/scores"
    whole = gzip.compress(b"".join(line(i) for i in range(100, 5100)))
    for i in range(5):
        put(src, f"{i}.csv", line(i))
    put(src, "short.csv.gz", gzip.compress(line(90))[:12])
    put(src, "torn.csv.gz", whole[:len(whole) // 2])      # a good beginning: none of its rows may be taken
    put(f"{src}/deep", "x.jsonl", b'{"apartment_id": "apt9", "building_id": "b", "event_date": "2024-01-18", "anomaly_score_combined": 9.0}\n')
    run(spark, tmp_dir)
    fine = sorted([f"apt{i}" for i in range(5)] + ["apt9"])
    assert apartments(spark, tmp_dir) == fine
    assert state(spark, tmp_dir) == {"short.csv.gz": ("open", 1), "torn.csv.gz": ("open", 1)}
    reasons = [r.reason for r in quarantine.entries(spark, f"{tmp_dir}/quarantine", "open").collect()]
    assert all("EOFException" in r for r in reasons), reasons

    put(src, "6.csv", line(6))
    run(spark, tmp_dir)                                     # both still bad, the new file is taken
    assert apartments(spark, tmp_dir) == sorted([*fine, "apt6"])
    assert state(spark, tmp_dir) == {"short.csv.gz": ("open", 2), "torn.csv.gz": ("open", 2)}

    put(src, "torn.csv.gz", whole)
    run(spark, tmp_dir)
    assert len(apartments(spark, tmp_dir)) == 5007
    assert state(spark, tmp_dir) == {"short.csv.gz": ("open", 3), "torn.csv.gz": ("recovered", 3)}
    run(spark, tmp_dir)
    assert len(apartments(spark, tmp_dir)) == 5007 and state(spark, tmp_dir)["torn.csv.gz"] == ("recovered", 3)
    counts = {r.source_file.rsplit("/", 1)[1]: r.rows_parsed for r in spark.read.parquet(f"{tmp_dir}/counts").collect()}
    assert counts["torn.csv.gz"] == 5000 and counts["x.jsonl"] == 1 and "short.csv.gz" not in counts


def test_small_batches_and_a_vanished_file(spark, tmp_dir):
    src = f"{tmp_dir}/scores"
    for i in range(4):
        put(src, f"{i}.csv", line(i))
    put(src, "bad.csv.gz", b"\x1f\x8b\x08\x00")
    run(spark, tmp_dir, max_files_per_trigger=2)
    assert apartments(spark, tmp_dir) == [f"apt{i}" for i in range(4)] and state(spark, tmp_dir) == {"bad.csv.gz": ("open", 1)}
    os.remove(f"{src}/bad.csv.gz")
    run(spark, tmp_dir, max_files_per_trigger=2)
    assert state(spark, tmp_dir) == {"bad.csv.gz": ("open", 2)}


def test_without_bad_files_nothing_is_noted(spark, tmp_dir):
    put(f"{tmp_dir}/scores", "0.csv", line(0))
    run(spark, tmp_dir)
    assert apartments(spark, tmp_dir) == ["apt0"] and current(spark, f"{tmp_dir}/quarantine").number == 0


def test_an_attempt_noted_twice_counts_once(spark, tmp_dir):
    path = f"{tmp_dir}/q"
    for _ in range(2):
        quarantine.record(spark, path, {"f": "r"}, [], "batch 0")
    quarantine.record(spark, path, {"f": "r2", "g": "r"}, [], "batch 1")
    got = {r.source_file: (r.reason, r.tries, r.first_tried, r.last_tried) for r in quarantine.entries(spark, path).collect()}
    assert got == {"f": ("r2", 2, "batch 0", "batch 1"), "g": ("r", 1, "batch 1", "batch 1")}


def test_other_errors_are_raised(spark):
    def read(files):
        raise RuntimeError("no cluster")

    with pytest.raises(RuntimeError):
        quarantine.read_apart(["a", "b"], read)
