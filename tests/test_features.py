"""Daily features for training (range) and serving (one date)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from thermolytics.plans.features import daily_features, inference_features, training_features
from thermolytics.schemas import FEATURE_COLUMNS, INFER_COLUMNS

METER = "event_ts timestamp, meter_id string, apartment_id string, building_id string, energy_kwh double, " \
        "room_temp_c double, setpoint_temp_c double, hot_water_litres double"
WEATHER = "date_col_name string, hdd double, avg_temp_c double, building_id_weather string"


def ts(d, hm):
    return dt.datetime.fromisoformat(f"{d} {hm}")


def meter_rows():
    r = []
    for day, e0, e1, t0, t1, w0, w1 in [("2024-01-15", 100, 110, 20.0, 20.5, 50, 55),
                                         ("2024-01-16", 110, 122, 20.6, 20.8, 55, 60),
                                         ("2024-01-17", 122, 130, 20.7, 20.7, 60, 62)]:
        r.append((ts(day, "00:00"), "m1", "apt1", "bldgA", float(e0), t0, 21.0, float(w0)))
        r.append((ts(day, "23:59"), "m1", "apt1", "bldgA", float(e1), t1, 21.0, float(w1)))
    r.append((ts("2024-01-15", "00:00"), "m2", "apt2", "bldgA", 50.0, 21.0, 22.0, 10.0))
    r.append((ts("2024-01-15", "23:59"), "m2", "apt2", "bldgA", 55.0, 21.5, 22.0, 12.0))
    return r


def weather(spark):
    return spark.createDataFrame([("2024-01-15", 10.0, 5.0, "bldgA"), ("2024-01-16", 12.0, 3.0, "bldgA"),
                                  ("2024-01-17", 11.0, 4.0, "bldgA"), ("2024-01-18", 9.0, 6.0, "bldgA")], WEATHER)


def event_time():
    return F.lit("2024-02-01 00:00:00").cast("timestamp")


def test_training_features_golden(spark):
    m = spark.createDataFrame(meter_rows(), METER)
    out = training_features(m, weather(spark), "2024-01-15", "2024-01-17", event_time=event_time())
    assert out.columns == FEATURE_COLUMNS
    got = {(r.apartment_record_id, str(r.event_date)): r for r in out.collect()}
    assert len(got) == 4
    exp = {("apt1", "2024-01-15"): (10, -0.75, 5, 10, None, 10, None),
           ("apt1", "2024-01-16"): (12, -0.3, 5, 12, 10, 11, -0.75),
           ("apt1", "2024-01-17"): (8, -0.3, 2, 11, 12, 10, -0.3),
           ("apt2", "2024-01-15"): (5, -0.75, 2, 10, None, 5, None)}
    for key, (e, td, w, hdd, lag, roll, tlag) in exp.items():
        r = got[key]
        assert r.daily_energy_kwh == pytest.approx(e)
        assert r.avg_temp_diff == pytest.approx(td)
        assert r.daily_water_l == pytest.approx(w)
        assert r.hdd == pytest.approx(hdd)
        assert (r.energy_lag_1d is None) if lag is None else r.energy_lag_1d == pytest.approx(lag)
        assert r.energy_roll_avg_7d == pytest.approx(roll)
        assert (r.temp_diff_lag_1d is None) if tlag is None else r.temp_diff_lag_1d == pytest.approx(tlag)


def test_empty_meter(spark):
    m = spark.createDataFrame([], METER)
    out = training_features(m, weather(spark), "2024-01-15", "2024-01-17", event_time=event_time())
    assert out.count() == 0 and out.columns == FEATURE_COLUMNS


def test_missing_weather_gives_nulls(spark):
    m = spark.createDataFrame([(ts("2024-01-20", "00:00"), "m1", "apt1", "bldgA", 1.0, 20.0, 21.0, 1.0),
                               (ts("2024-01-20", "12:00"), "m1", "apt1", "bldgA", 11.0, 20.0, 21.0, 2.0)], METER)
    r = training_features(m, weather(spark), "2024-01-20", "2024-01-20", event_time=event_time()).collect()
    assert len(r) == 1 and r[0].hdd is None and r[0].avg_temp_c is None and r[0].daily_energy_kwh == 10.0


def test_last_day_is_whole(spark):
    m = spark.createDataFrame([(ts("2024-01-17", "00:00"), "m1", "a", "b", 1.0, 20.0, 21.0, 1.0),
                               (ts("2024-01-17", "23:59"), "m1", "a", "b", 5.0, 20.0, 21.0, 1.0),
                               (dt.datetime(2024, 1, 17, 23, 59, 59, 500000), "m1", "a", "b", 7.0, 20.0, 21.0, 1.0)],
                              METER)
    r = training_features(m, weather(spark), "2024-01-15", "2024-01-17", event_time=event_time()).collect()
    assert r[0].daily_energy_kwh == 6.0


def test_inference_features_golden(spark):
    rows = [r for r in meter_rows() if r[2] == "apt1"]
    rows += [(ts("2024-01-17", "00:00"), "m2", "apt2", "bldgA", 50.0, 21.0, 22.0, 10.0),
             (ts("2024-01-17", "23:59"), "m2", "apt2", "bldgA", 59.0, 21.5, 22.0, 12.0)]
    m = spark.createDataFrame(rows, METER)
    out = inference_features(m, weather(spark), "2024-01-17")
    assert out.columns == INFER_COLUMNS
    got = {r.apartment_id: r for r in out.collect()}
    assert got["apt1"].daily_energy_kwh == 8 and got["apt1"].hdd == 11
    assert got["apt1"].energy_lag_1d == 12 and got["apt1"].energy_roll_avg_7d == 10
    assert got["apt2"].daily_energy_kwh == 9 and got["apt2"].energy_roll_avg_7d == 9
    assert got["apt2"].energy_lag_1d == 0.0      # filled (fill_value=None keeps null)
    keep = inference_features(m, weather(spark), "2024-01-17", fill_value=None)
    assert {r.apartment_id: r for r in keep.collect()}["apt2"].energy_lag_1d is None


def test_inference_no_rows_on_date(spark):
    m = spark.createDataFrame(meter_rows(), METER)
    out = inference_features(m, weather(spark), "2024-01-25")
    assert out.count() == 0 and out.columns == INFER_COLUMNS


def test_train_serve_equality(spark):
    """Training for start=end=d with warm-up equals serving for d (before the fill)."""
    from thermolytics.sources import testviews as tv
    from tests.conftest import SF
    meter, w = tv.meter(spark, SF), tv.weather(spark, SF)
    for d, calendar in [("2024-01-17", False), ("2024-01-23", True)]:
        t = training_features(meter, w, d, d, event_time=event_time(), calendar=calendar) \
            .withColumnRenamed("apartment_record_id", "apartment_id")
        s = inference_features(meter, w, d, fill_value=None, calendar=calendar)
        cols = INFER_COLUMNS
        assert sorted(map(tuple, t.select(*cols).collect()), key=str) == \
            sorted(map(tuple, s.select(*cols).collect()), key=str)


def test_calendar_windows_count_days(spark):
    rows = [(ts("2024-01-10", "00:00"), "m", "a", "b", 0.0, 20.0, 21.0, 0.0),
            (ts("2024-01-10", "12:00"), "m", "a", "b", 4.0, 20.0, 21.0, 0.0),
            (ts("2024-01-12", "00:00"), "m", "a", "b", 0.0, 20.0, 21.0, 0.0),
            (ts("2024-01-12", "12:00"), "m", "a", "b", 8.0, 20.0, 21.0, 0.0)]
    m = spark.createDataFrame(rows, METER)
    rows_mode = {str(r.event_date): r for r in daily_features(m, weather(spark)).collect()}
    cal = {str(r.event_date): r for r in daily_features(m, weather(spark), calendar=True).collect()}
    assert rows_mode["2024-01-12"].energy_lag_1d == 4.0     # previous row
    assert cal["2024-01-12"].energy_lag_1d is None          # previous calendar day missing
    assert cal["2024-01-12"].energy_roll_avg_7d == 6.0


def test_weather_per_building_does_not_fan_out(spark):
    m = spark.createDataFrame(meter_rows(), METER)
    w = weather(spark).unionByName(weather(spark).withColumn("building_id_weather", F.lit("bldgB"))
                                   .withColumn("hdd", F.col("hdd") + 2))
    out = daily_features(m, w)
    assert out.count() == 4
    r = {(x.apartment_id, str(x.event_date)): x for x in out.collect()}
    assert r[("apt1", "2024-01-15")].hdd == 11.0       # averaged, one row per date
    keyed = daily_features(m, w, weather_keys=("event_date", "building_id"),
                           weather_key_cols={"building_id": "building_id_weather"})
    r2 = {(x.apartment_id, str(x.event_date)): x for x in keyed.collect()}
    assert r2[("apt1", "2024-01-15")].hdd == 10.0


def test_per_meter_deltas(spark):
    """Two counters in one apartment: per-meter deltas are summed instead of mixing counters."""
    from thermolytics.operators.daily import daily_consumption
    rows = [(ts("2024-01-15", "00:00"), "m1", "apt1", "b", 100.0, 20.0, 21.0, 10.0),
            (ts("2024-01-15", "23:00"), "m1", "apt1", "b", 104.0, 20.0, 21.0, 12.0),
            (ts("2024-01-15", "00:00"), "m2", "apt1", "b", 500.0, 22.0, 21.0, 1.0),
            (ts("2024-01-15", "23:00"), "m2", "apt1", "b", 503.0, 22.0, 21.0, 2.0)]
    m = spark.createDataFrame(rows, METER)
    mixed = daily_consumption(m).first()
    per = daily_consumption(m, per_meter=True).first()
    assert mixed.daily_energy_kwh == 403.0          # max of one counter minus min of the other
    assert per.daily_energy_kwh == 7.0 and per.daily_water_l == 3.0
    assert per.avg_temp_diff == mixed.avg_temp_diff == 0.0
