"""Source behaviour: partition pruning on date ranges, raw JSON reading, score suffix filter."""

import datetime as dt

from thermolytics.operators.clean import clean_meter
from thermolytics.sources.meter import read_meter, read_raw_meter, write_meter


def test_meter_range_prunes_partitions(spark, tmp_dir):
    rows = [(f"2024-01-{d:02d} 10:00:00", "m", "a", "b", 1.0, 20.0, 21.0, 1.0) for d in range(1, 11)]
    raw = spark.createDataFrame(rows, "timestamp_str string, meter_id string, apartment_id string, "
                                      "building_id string, energy_kwh double, room_temp_c double, "
                                      "setpoint_temp_c double, hot_water_litres double")
    write_meter(clean_meter(raw), f"{tmp_dir}/meter")
    df = read_meter(spark, f"{tmp_dir}/meter", "2024-01-03", "2024-01-05")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "make_date" in plan
    assert "PushedFilters: [IsNotNull(event_ts), GreaterThanOrEqual(event_ts" in plan
    assert sorted(r.day for r in df.collect()) == [3, 4, 5]


def test_raw_json_recursive(spark, tmp_dir):
    import os
    os.makedirs(f"{tmp_dir}/in/2024/01")
    with open(f"{tmp_dir}/in/2024/01/x.json", "w") as f:
        f.write('{"timestamp_str": "2024-01-15 10:30:00", "meter_id": "m", "energy_kwh": 2.5, "more": 1}\n')
        f.write("not json\n")
    df = read_raw_meter(spark, f"{tmp_dir}/in")
    out = clean_meter(df).collect()
    assert len(out) == 1 and out[0].energy_kwh == 2.5 and out[0].event_ts == dt.datetime(2024, 1, 15, 10, 30)


def test_cleanup_staging_by_age(spark, tmp_dir):
    import os
    import time
    from thermolytics.session import cleanup_staging
    for name in ("stage-old-1", "stage-new-1", "keep-me"):
        os.makedirs(f"{tmp_dir}/{name}")
    old = time.time() - 3 * 3600
    os.utime(f"{tmp_dir}/stage-old-1", (old, old))
    os.utime(f"{tmp_dir}/keep-me", (old, old))
    assert cleanup_staging(spark, older_than_hours=1, root=tmp_dir) == 1
    assert sorted(os.listdir(tmp_dir)) == ["keep-me", "stage-new-1"]


def test_positional_scoring_rows(spark, tmp_dir):
    import pytest
    from thermolytics.sources.features import attach_names, read_inference_features
    feats = ["daily_energy_kwh", "hdd", "avg_temp_diff"]
    with open(f"{tmp_dir}/ids.csv", "w") as f:
        f.write("apt1,bldgA,2024-01-18,10,8,-0.5\n")
    with open(f"{tmp_dir}/plain.csv", "w") as f:
        f.write("5,8,-0.8\n")
    r = read_inference_features(spark, f"{tmp_dir}/ids.csv", feature_columns=feats).first()
    assert (r.apartment_id, r.daily_energy_kwh, r.avg_temp_diff) == ("apt1", 10.0, -0.5)
    p = read_inference_features(spark, f"{tmp_dir}/plain.csv", feature_columns=feats).first()
    assert p.apartment_id is None and p.hdd == 8.0
    with pytest.raises(ValueError, match="do not match expected feature columns"):
        attach_names(spark.createDataFrame([("1", "2")], "a string, b string"), feats)
    with pytest.raises(ValueError, match="Unsupported content type"):
        read_inference_features(spark, f"{tmp_dir}/plain.csv", "application/json")


def test_feature_store_rejects(spark, tmp_dir):
    from pyspark.sql import functions as F
    from thermolytics.schemas import FEATURE
    from thermolytics.sources.features import read_features, write_features
    rows = [("apt1", dt.datetime(2024, 2, 1), dt.date(2024, 1, 15), "b", *[1.0] * 8),
            (None, dt.datetime(2024, 2, 1), dt.date(2024, 1, 15), "b", *[1.0] * 8)]
    df = spark.createDataFrame(rows, FEATURE)
    write_features(df, f"{tmp_dir}/store", f"{tmp_dir}/rejects")
    assert read_features(spark, f"{tmp_dir}/store").count() == 1
    assert spark.read.parquet(f"{tmp_dir}/rejects").where(F.col("apartment_record_id").isNull()).count() == 1


def test_read_labels_optional(spark, tmp_dir):
    from thermolytics.sources.labels import read_labels
    assert read_labels(spark, None) is None
    assert read_labels(spark, f"{tmp_dir}/missing") is None
    spark.createDataFrame([("apt1", dt.date(2024, 1, 19), 1)], "apartment_record_id string, event_date date, "
                                                             "is_anomaly long").write.parquet(f"{tmp_dir}/lab")
    lab = read_labels(spark, f"{tmp_dir}/lab")
    assert lab.schema["is_anomaly"].dataType.simpleString() == "int" and lab.count() == 1


def test_write_meter_registers_table(spark, tmp_dir):
    rows = [("2024-01-15 10:00:00", "m", "a", "b", 1.0, 20.0, 21.0, 1.0),
            ("2024-01-16 10:00:00", "m", "a", "b", 2.0, 20.0, 21.0, 1.0)]
    raw = spark.createDataFrame(rows, "timestamp_str string, meter_id string, apartment_id string, "
                                      "building_id string, energy_kwh double, room_temp_c double, "
                                      "setpoint_temp_c double, hot_water_litres double")
    write_meter(clean_meter(raw), f"{tmp_dir}/meter_tbl", table="meter_catalog_test")
    write_meter(clean_meter(raw), f"{tmp_dir}/meter_tbl", table="meter_catalog_test")   # append
    t = spark.table("meter_catalog_test")
    assert t.count() == 4 and {r.day for r in t.collect()} == {15, 16}
    spark.sql("DROP TABLE meter_catalog_test")


def test_an_empty_feature_store_is_an_error(spark, tmp_dir):
    import os

    import pytest

    from thermolytics.plans.jobs import train
    from thermolytics.schemas import FEATURE
    from thermolytics.sources.features import read_features
    os.makedirs(f"{tmp_dir}/none")
    with pytest.raises(FileNotFoundError):
        read_features(spark, f"{tmp_dir}/none")
    with pytest.raises(FileNotFoundError):
        read_features(spark, f"{tmp_dir}/missing")
    spark.createDataFrame([], FEATURE).write.parquet(f"{tmp_dir}/empty")
    with pytest.raises((FileNotFoundError, ValueError)):
        train(spark, f"{tmp_dir}/empty", f"{tmp_dir}/model")


def test_a_large_day_has_several_writers(spark, tmp_dir):
    import os

    from thermolytics.operators.clean import clean_meter
    from thermolytics.schemas import RAW
    from thermolytics.sources.meter import write_meter
    from pyspark.sql import functions as F
    raw = spark.range(60000).select(
        F.when(F.col("id") % 50 == 0, "2024-01-16 10:00:00").otherwise("2024-01-15 10:00:00").alias("timestamp_str"),
        F.sha2(F.col("id").cast("string"), 256).alias("meter_id"), F.lit("a").alias("apartment_id"), F.lit("b").alias("building_id"),
        *[F.rand(i).alias(c) for i, c in enumerate(("energy_kwh", "room_temp_c", "setpoint_temp_c", "hot_water_litres"))])
    assert set(raw.columns) == set(RAW.fieldNames())
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    try:
        write_meter(clean_meter(raw.repartition(4)), f"{tmp_dir}/m")
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files = {d: len([f for f in os.listdir(f"{tmp_dir}/m/year=2024/month=1/day={d}") if f.endswith(".parquet")]) for d in (15, 16)}
    assert 1 < files[15] <= 8 and files[16] <= files[15]
    write_meter(clean_meter(raw.repartition(4)), f"{tmp_dir}/small")        # far below the advised size: few files
    assert sum(f.endswith(".parquet") for _, _, names in os.walk(f"{tmp_dir}/small") for f in names) <= 4
