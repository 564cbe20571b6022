"""Replayable batches: one copy however often a batch is written, compaction, run-wide audit."""

import json
import os

import pytest

from thermolytics.plans import jobs
from thermolytics.sources import meter_batches, versioned
from thermolytics.sources.meter_batches import batches, compact, read_batches, write_batch
from thermolytics.streaming import ingest_stream
from thermolytics.streaming.ingest_stream import ingest_batches, read_audit


def raw_line(ts, meter, energy=1.0):
    return json.dumps({"timestamp_str": ts, "meter_id": meter, "apartment_id": "a", "building_id": "b",
                       "energy_kwh": energy, "room_temp_c": 20.0, "setpoint_temp_c": 21.0, "hot_water_litres": 1.0})


def put(folder, name, *lines):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w") as f:
        f.write("\n".join(lines))


def meters(spark, path, *days):
    return sorted(r.meter_id for r in read_batches(spark, path, *days).collect())


def test_a_batch_run_twice_leaves_one_copy(spark, tmp_dir):
    src, dest = f"{tmp_dir}/raw", f"{tmp_dir}/meter"
    put(src, "1.json", raw_line("2024-01-15 10:00:00", "m1"), raw_line("2024-01-16 10:00:00", "m2"), raw_line("bad", "m3"))
    for _ in range(2):
        assert jobs.ingest(spark, src, dest, batch="b1") == {"rows_read": 3, "rows_written": 2}
        assert meters(spark, dest) == ["m1", "m2"]
    put(f"{tmp_dir}/raw2", "2.json", raw_line("2024-01-16 11:00:00", "m4"), raw_line("2024-01-17 11:00:00", "m5"))
    jobs.ingest(spark, f"{tmp_dir}/raw2", dest, batch="b2")
    assert meters(spark, dest) == ["m1", "m2", "m4", "m5"] and batches(spark, dest) == ["b1", "b2"]
    # The batch comes again with other rows and days: its old ones go.
    put(src, "1.json", raw_line("2024-01-16 12:00:00", "m6"))
    jobs.ingest(spark, src, dest, batch="b1")
    assert meters(spark, dest) == ["m4", "m5", "m6"] and meters(spark, dest, "2024-01-15") == []


def test_a_batch_comes_again_after_compaction(spark, tmp_dir):
    dest = f"{tmp_dir}/meter"
    for i in range(4):
        put(f"{tmp_dir}/raw{i}", "x.json", raw_line("2024-01-15 10:00:00", f"a{i}"), raw_line(f"2024-01-1{6 + i} 10:00:00", f"b{i}"))
        jobs.ingest(spark, f"{tmp_dir}/raw{i}", dest, batch=str(i))
    before = meters(spark, dest)
    assert compact(spark, dest) == 1 and compact(spark, dest) == 0
    assert meters(spark, dest) == before and len(versioned.current(spark, dest).parts()["2024-01-15"]) == 1
    put(f"{tmp_dir}/raw2", "x.json", raw_line("2024-01-15 10:00:00", "new"))
    jobs.ingest(spark, f"{tmp_dir}/raw2", dest, batch="2")
    assert meters(spark, dest) == sorted([m for m in before if m not in ("a2", "b2")] + ["new"])
    assert batches(spark, dest) == ["0", "1", "2", "3"] and compact(spark, dest, ["2024-01-15"]) == 1
    assert meters(spark, dest, "2024-01-15") == ["a0", "a1", "a3", "new"]


def test_a_range_opens_its_days_only(spark, tmp_dir):
    dest = f"{tmp_dir}/meter"
    put(f"{tmp_dir}/raw", "x.json", *[raw_line(f"2024-01-{d:02d} 23:59:59", f"m{d:02d}") for d in range(1, 29)])
    jobs.ingest(spark, f"{tmp_dir}/raw", dest, batch="1")
    got = read_batches(spark, dest, "2024-01-10", "2024-01-12")
    assert sorted(r.meter_id for r in got.collect()) == ["m10", "m11", "m12"]
    assert all(any(f"2024-01-{d}" in f for d in (10, 11, 12)) for f in got.inputFiles())


def test_an_empty_batch_replaces_too(spark, tmp_dir):
    dest = f"{tmp_dir}/meter"
    put(f"{tmp_dir}/raw", "x.json", raw_line("2024-01-15 10:00:00", "m1"))
    jobs.ingest(spark, f"{tmp_dir}/raw", dest, batch="1")
    write_batch(spark, spark.createDataFrame([], meter_batches.SCHEMA), dest, "1")
    assert meters(spark, dest) == [] and batches(spark, dest) == []


def test_audit_covers_every_micro_batch_of_a_run(spark, tmp_dir):
    src, dest, cp, audit = (f"{tmp_dir}/{n}" for n in ("raw", "meter", "cp", "audit"))
    for i in range(5):
        put(src, f"{i}.json", raw_line("2024-01-15 10:00:00", f"m{i}"), raw_line("bad", f"x{i}"), *[raw_line("bad", "y")] * i)
    first = ingest_batches(spark, src, dest, cp, audit, max_files_per_trigger=1)
    assert (first["batches"], first["rows_read"], first["rows_written"]) == (5, 20, 5)
    put(f"{src}/deep", "late.json", raw_line("2024-01-15 10:00:00", "m9"))
    second = ingest_batches(spark, src, dest, cp, audit, max_files_per_trigger=1)
    assert (second["batches"], second["rows_read"], second["rows_written"]) == (1, 1, 1)
    none = ingest_batches(spark, src, dest, cp, audit)
    assert (none["batches"], none["rows_read"]) == (0, 0)
    assert read_audit(spark, audit).count() == 6 and meters(spark, dest) == ["m0", "m1", "m2", "m3", "m4", "m9"]
    assert read_audit(spark, f"{tmp_dir}/nothing").count() == 0


def test_a_failed_run_is_replayed_without_copies(spark, tmp_dir, monkeypatch):
    src, dest, cp, audit = (f"{tmp_dir}/{n}" for n in ("raw", "meter", "cp", "audit"))
    for i in range(4):
        put(src, f"{i}.json", raw_line("2024-01-15 10:00:00", f"m{i}"))
    whole, calls = ingest_stream.write_batch, []

    def dies_after_the_write(*a):
        whole(*a)
        calls.append(a[3])
        if len(calls) == 3:
            raise RuntimeError("killed")

    monkeypatch.setattr(ingest_stream, "write_batch", dies_after_the_write)
    with pytest.raises(Exception, match="killed"):
        ingest_batches(spark, src, dest, cp, audit, max_files_per_trigger=1)
    assert len(meters(spark, dest)) == 3 and read_audit(spark, audit).count() == 2
    monkeypatch.undo()
    again = ingest_batches(spark, src, dest, cp, audit, max_files_per_trigger=1)
    assert again["batches"] == 2 and meters(spark, dest) == ["m0", "m1", "m2", "m3"]
    assert read_audit(spark, audit).count() == 4
