"""Late readings: features kept by batches equal those computed from all readings."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from thermolytics.operators.daily import daily_consumption
from thermolytics.operators.daily_state import daily_state, finish
from thermolytics.plans.features import daily_features
from thermolytics.plans.incremental import add_readings, compact_state, update_features
from thermolytics.schemas import METER
from thermolytics.sources import feature_log, versioned

DAY0 = dt.datetime(2024, 1, 1)


def readings(seed, n=500, apartments=6, days=30):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        ts = DAY0 + dt.timedelta(days=rng.randrange(days), seconds=rng.randrange(86_400))
        apt = rng.randrange(apartments)
        number = lambda: None if rng.random() < 0.05 else round(rng.uniform(0, 50), 3)
        out.append((ts, f"m{apt}{rng.randrange(2)}", f"a{apt}" if apt else None, f"b{apt % 2}", number(), number(), number(), number(),
                    ts.year, ts.month, ts.day))
    return out


def weather(spark):
    return spark.createDataFrame([((DAY0 + dt.timedelta(i)).strftime("%Y-%m-%d"), float(i), 5.0 - i) for i in range(25)],
                                 "date_col_name string, hdd double, avg_temp_c double")


def values(df, apartment="apartment_id"):
    cols = ["building_id", apartment, "event_date", "avg_temp_diff", "daily_energy_kwh", "daily_water_l", "hdd", "avg_temp_c",
            "energy_lag_1d", "energy_roll_avg_7d", "temp_diff_lag_1d"]
    return sorted((tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in df.select(*cols).collect()), key=repr)


@pytest.mark.parametrize("per_meter", [False, True])
def test_merged_states_give_the_roll_up(spark, per_meter):
    rows = readings(1)
    whole = daily_consumption(spark.createDataFrame(rows, METER), per_meter)
    parts = [daily_state(spark.createDataFrame(rows[i::3], METER)) for i in range(3)]
    got = finish(parts[0].unionByName(parts[1]).unionByName(parts[2]), per_meter)
    key = lambda df: sorted((tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in df.select(sorted(df.columns)).collect()), key=repr)
    assert key(got) == key(whole)


@pytest.mark.parametrize("kw", [{}, {"calendar": True}, {"per_meter": True}, {"calendar": True, "lookback_days": 3}])
def test_batches_equal_a_full_rebuild(spark, tmp_dir, kw):
    state, feats = f"{tmp_dir}/state", f"{tmp_dir}/feats"
    rows = readings(2)
    rng = random.Random(9)
    batches = [[], [], []]
    for r in rows:
        batches[1 if r[3] == "b1" and r[0].day in (4, 17) else 2 if rng.random() < 0.05 else 0].append(r)
    seen = []
    for i, some in enumerate(batches):
        seen += some
        when = F.lit(f"2024-02-0{i + 1} 00:00:00").cast("timestamp")
        update_features(spark, spark.createDataFrame(some, METER), weather(spark), state, feats, f"b{i}", when, **kw)
        want = values(daily_features(spark.createDataFrame(seen, METER), weather(spark), **kw))
        assert values(feature_log.latest(spark, feats), "apartment_record_id") == [r for r in want if r[1] is not None]
    # A batch sent again, before and after compaction, changes nothing.
    before = values(feature_log.latest(spark, feats), "apartment_record_id")
    for _ in range(2):
        update_features(spark, spark.createDataFrame(batches[2], METER), weather(spark), state, feats, "b2",
                        F.lit("2024-02-09 00:00:00").cast("timestamp"), **kw)
        assert values(feature_log.latest(spark, feats), "apartment_record_id") == before
        compact_state(spark, state)


@pytest.mark.parametrize("calendar, want", [(False, 7), (True, 4)])
def test_only_touched_windows_are_computed(spark, tmp_dir, calendar, want):
    """One late reading: its day and the rows whose frames hold it. Every other day has a reading."""
    state, feats = f"{tmp_dir}/state", f"{tmp_dir}/feats"
    row = lambda a, d: (DAY0 + dt.timedelta(days=d), "m", a, "b", 1.0 * d, 20.0, 21.0, 1.0, 2024, 1, d + 1)
    base = [row(a, d) for a in ("x", "y") for d in range(0, 30, 2)]
    update_features(spark, spark.createDataFrame(base, METER), weather(spark), state, feats, "first", calendar=calendar)
    update_features(spark, spark.createDataFrame([row("x", 10)], METER), weather(spark), state, feats, "late", calendar=calendar)
    late = versioned.read(spark, feats, feature_log.SCHEMA, where=lambda e: e.tags == ("late",)).collect()
    assert {r.apartment_record_id for r in late} == {"x"}
    assert sorted(r.event_date.day - 1 for r in late) == list(range(10, 10 + 2 * want, 2))
    if calendar:
        days = versioned.current(spark, state).parts()
        assert len(days["2024-01-11"]) == 2 and len(days["2024-01-13"]) == 1


def test_a_dead_update_is_repeated(spark, tmp_dir, monkeypatch):
    state, feats = f"{tmp_dir}/state", f"{tmp_dir}/feats"
    rows = readings(3, n=120)
    df = spark.createDataFrame(rows, METER)
    monkeypatch.setattr(feature_log, "append_features", lambda *a: (_ for _ in ()).throw(RuntimeError("killed")))
    with pytest.raises(RuntimeError):
        update_features(spark, df, weather(spark), state, feats, "b0")
    monkeypatch.undo()
    update_features(spark, df, weather(spark), state, feats, "b0")
    assert values(feature_log.latest(spark, feats), "apartment_record_id") == [
        r for r in values(daily_features(df, weather(spark))) if r[1] is not None]


def test_an_empty_batch(spark, tmp_dir):
    update_features(spark, spark.createDataFrame([], METER), weather(spark), f"{tmp_dir}/s", f"{tmp_dir}/f", "b0")
    add_readings(spark, spark.createDataFrame([], METER), f"{tmp_dir}/s", "b1")
    assert feature_log.latest(spark, f"{tmp_dir}/f").count() == 0 and compact_state(spark, f"{tmp_dir}/s") == 0
