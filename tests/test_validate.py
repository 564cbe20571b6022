"""Schema contract check."""

import json

import pytest

from thermolytics.operators.validate import check_contract, contract_passed, load_contract


def test_load_contract_errors():
    with pytest.raises(ValueError):
        load_contract('{"cols": []}')
    with pytest.raises(json.JSONDecodeError):
        load_contract("{not json")


def test_statuses_and_profile(spark):
    df = spark.createDataFrame([("2024-01-15 10:30:00", "m1", 1.0, [1]), ("01/15/2024 10:30:00", None, 2.0, [2]),
                                (None, "m3", None, None)],
                               "timestamp_str string, Meter_ID string, energy_kwh double, tags array<int>")
    contract = {"columns": [{"name": "timestamp_str", "type": "timestamp"}, {"name": "meter_id", "type": "STRING"},
                            {"name": "energy_kwh", "type": "double"}, {"name": "flow", "type": "double"},
                            {"name": "tags", "type": "array<int>"}]}
    rep = {r.column: r for r in check_contract(df, json.dumps(contract)).collect()}
    assert rep["timestamp_str"].status == "type_mismatch"
    assert (rep["timestamp_str"].rows, rep["timestamp_str"].nulls, rep["timestamp_str"].invalid) == (3, 1, 1)
    assert rep["Meter_ID"].status == "ok" and rep["Meter_ID"].nulls == 1
    assert rep["energy_kwh"].status == "ok" and rep["energy_kwh"].invalid == 0
    assert rep["flow"].status == "missing" and rep["flow"].rows is None
    assert rep["tags"].status == "ok"
    assert contract_passed(check_contract(df, contract)).first().passed is False
    ok = {"columns": [{"name": "energy_kwh", "type": "double"}]}
    r2 = check_contract(df, ok)
    assert {r.status for r in r2.collect()} == {"ok", "extra"}
    assert contract_passed(r2).first().passed is True


def test_unreadable_path_fails(spark, tmp_dir):
    from thermolytics.operators.validate import validate_path
    rep = validate_path(spark, f"{tmp_dir}/nothing-here", {"columns": [{"name": "a", "type": "double"}]})
    rows = rep.collect()
    assert len(rows) == 1 and rows[0].status == "unreadable"
    assert contract_passed(rep).first().passed is False
    spark.createDataFrame([(1.0,)], "a double").write.parquet(f"{tmp_dir}/t")
    ok = validate_path(spark, f"{tmp_dir}/t", {"columns": [{"name": "a", "type": "double"}]})
    assert contract_passed(ok).first().passed is True
