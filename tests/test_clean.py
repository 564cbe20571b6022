"""Cleaning rules of raw readings, each on rows of its own."""

import datetime as dt

import pytest

from thermolytics.operators.clean import clean_meter, rejected_readings, require_columns
from thermolytics.schemas import METER, METER_COLUMNS, RAW_COLUMNS

DDL = ("note string, hot_water_litres double, energy_kwh string, timestamp_str string, building_id string, "
       "meter_id string, setpoint_temp_c double, room_temp_c double, apartment_id string")

#: (timestamp text, meter id, energy text) -> the reason for which the reading goes, None if it stays.
CASES = [
    ("2023-12-31 23:59:59", "heat-77", "0.125", None),
    ("2024-02-29 00:00:00", "heat-78", "-3", None),
    ("2024-03-31 02:30:00", "", None, None),                    # an empty meter id is one; so is an hour that summer time skips
    ("2024-05-05 05:05:05", "heat-79", "n/a", None),            # text that is no number becomes null
    (None, "heat-80", "1", "null timestamp"),
    ("soon", "heat-81", "1", "unparsable timestamp"),
    ("", "heat-82", "1", "unparsable timestamp"),
    ("2023-02-29 12:00:00", "heat-83", "1", "unparsable timestamp"),
    ("2024-06-01", "heat-84", "1", "unparsable timestamp"),
    ("06/01/2024 07:00:00", "heat-85", "1", "unparsable timestamp"),
    ("2024-06-01T07:00:00Z", "heat-86", "1", "unparsable timestamp"),
    ("2024-06-01 07:00:00", None, "1", "null meter_id"),
    (None, None, "1", "null timestamp"),
]


def readings(spark, cases):
    return spark.createDataFrame([("n", 4.0, energy, ts, f"house {i % 2}", meter, 19.0, 18.5, f"flat {i}")
                                  for i, (ts, meter, energy, *_) in enumerate(cases)], DDL)


@pytest.mark.parametrize("case", CASES, ids=lambda c: f"{c[0]}/{c[1]}")
def test_one_reading(spark, case):
    ts, meter, energy, reason = case
    df = readings(spark, [case])
    assert [r.reason for r in rejected_readings(df).collect()] == [reason] * (reason is not None)
    kept = clean_meter(df).collect()
    assert len(kept) == (reason is None)
    if kept:
        when = dt.datetime.fromisoformat(ts)
        number = float(energy) if energy and energy != "n/a" else None
        assert tuple(kept[0]) == (when, meter, "flat 0", "house 0", number, 18.5, 19.0, 4.0, when.year, when.month, when.day)


def test_every_reading_is_kept_or_rejected_once(spark):
    df = readings(spark, CASES * 3)
    assert clean_meter(df).count() + rejected_readings(df).count() == 3 * len(CASES)
    assert rejected_readings(df).columns == [*RAW_COLUMNS, "reason"]


@pytest.mark.parametrize("cases", [[], CASES])
def test_result_has_the_meter_schema(spark, cases):
    out = clean_meter(readings(spark, cases))
    assert out.columns == METER_COLUMNS
    assert [f.dataType for f in out.schema] == [METER[c].dataType for c in METER_COLUMNS]


@pytest.mark.parametrize("gone", RAW_COLUMNS)
def test_each_raw_column_is_required(spark, gone):
    with pytest.raises(ValueError, match=rf"Input DataFrame missing required columns: \['{gone}'\]"):
        clean_meter(readings(spark, CASES).drop(gone))


def test_only_frames_are_taken():
    with pytest.raises(TypeError):
        require_columns([1, 2], ["a"])
