"""Bucketed daily rows: windows over series without an exchange, results as before."""

import datetime as dt
import random

from thermolytics.operators.windows import add_lag_rolling
from thermolytics.sources.daily_table import read_daily, write_daily

SCHEMA = "building_id string, apartment_id string, event_date date, avg_temp_diff double, daily_energy_kwh double"


def daily(spark, n=400):
    rng = random.Random(2)
    keys = {(f"b{rng.randrange(3)}", f"a{rng.randrange(9)}", dt.date(2024, 1, 1) + dt.timedelta(rng.randrange(60))) for _ in range(n)}
    keys |= {(None, "a1", dt.date(2024, 1, d)) for d in range(1, 9)}
    return spark.createDataFrame([(*k, rng.random(), rng.random()) for k in sorted(keys, key=str)], SCHEMA)


def test_windows_read_the_buckets_as_they_lie(spark, tmp_dir):
    df = daily(spark)
    write_daily(df, "daily_bucketed_test", f"{tmp_dir}/daily", buckets=5)
    try:
        stored = read_daily(spark, "daily_bucketed_test")
        for calendar in (False, True):
            out = add_lag_rolling(stored, calendar=calendar)
            plan = out._jdf.queryExecution().executedPlan().toString()
            assert "Window" in plan and "Exchange" not in plan
            assert "Exchange" in add_lag_rolling(df, calendar=calendar)._jdf.queryExecution().executedPlan().toString()
            assert sorted(map(str, out.collect())) == sorted(map(str, add_lag_rolling(df, calendar=calendar).collect()))
        per_series = stored.groupBy("building_id", "apartment_id").count()
        assert "Exchange" not in per_series._jdf.queryExecution().executedPlan().toString()
        write_daily(df.limit(10), "daily_bucketed_test", f"{tmp_dir}/daily", buckets=5)
        assert read_daily(spark, "daily_bucketed_test").count() == 10
    finally:
        spark.sql("DROP TABLE daily_bucketed_test")
