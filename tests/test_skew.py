"""Hot keys: a third of all rows on one key / one value / one vector."""

import numpy as np
import pytest

from tests.lof_brute import lof as brute_lof
from thermolytics.operators.daily import daily_consumption
from thermolytics.operators.dedup import latest_per_key
from thermolytics.operators.lof import lof_scores
from thermolytics.operators.quantile import exact_quantile


def test_quantile_with_a_hot_value(spark):
    rng = np.random.default_rng(4)
    vals = np.concatenate([np.full(400, 2.5), rng.normal(size=800)])
    df = spark.createDataFrame([(float(v),) for v in vals], ["v"])
    for q in (0.1, 0.5, 0.95):
        assert exact_quantile(df, "v", q).first()[0] == pytest.approx(np.quantile(vals, q))


def test_lof_with_a_third_identical_rows(spark):
    rng = np.random.default_rng(8)
    X = np.round(rng.normal(size=(150, 2)), 1)
    X[:50] = [0.3, -0.2]
    ids = np.arange(150) + 1
    df = spark.createDataFrame([(int(i), *map(float, x)) for i, x in zip(ids, X)], ["id", "a", "b"])
    got = {r.id: r.lof for r in lof_scores(df, ["a", "b"], "id", k=5, leaf_size=8).collect()}
    exp, _, _ = brute_lof(X, ids, 5)
    for i, e in zip(ids, exp):
        assert got[int(i)] == pytest.approx(e, rel=1e-9)


def test_latest_per_key_hot_key_is_an_aggregate(spark):
    rows = [("hot", i, f"v{i}") for i in range(300)] + [("cold", 1, "c")]
    df = spark.createDataFrame(rows, "k string, t int, v string")
    out = latest_per_key(df, ["k"], ["t"])
    assert {r.k: r.v for r in out.collect()} == {"hot": "v299", "cold": "c"}
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and plan.count("HashAggregate") + plan.count("ObjectHashAggregate") + \
        plan.count("SortAggregate") >= 2        # partial + final


def test_daily_rollup_combines_before_shuffle(spark):
    import datetime as dt
    rows = [(dt.datetime(2024, 1, 1, 0, i % 60), "m", "a", "b", float(i), 20.0, 21.0, 1.0) for i in range(500)]
    m = spark.createDataFrame(rows, "event_ts timestamp, meter_id string, apartment_id string, building_id string, "
                                    "energy_kwh double, room_temp_c double, setpoint_temp_c double, "
                                    "hot_water_litres double")
    out = daily_consumption(m)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "partial_avg" in plan and "partial_max" in plan
    assert out.first().daily_energy_kwh == 499.0


def test_no_pair_joins_in_plans(spark):
    """The kNN search and the LOF result contain no cartesian or nested-loop joins."""
    from pyspark.sql import functions as F
    from thermolytics.operators.knn import build_tree, knn
    from thermolytics.operators.lof import distinct_vectors
    from thermolytics.operators.scale import apply_scaler, fit_scaler
    rng = np.random.default_rng(2)
    X = rng.normal(size=(300, 3))
    df = spark.createDataFrame([(int(i), "g", *map(float, x)) for i, x in enumerate(X)], ["id", "grp", "a", "b", "c"])
    vec = distinct_vectors(df, ["grp"], ["a", "b", "c"], "id")
    tree = build_tree(vec, ["grp"], ["a", "b", "c"], leaf_size=20)
    assert tree.depth >= 2
    plans = [knn(tree, tree.vectors, 5, True), lof_scores(df, ["a", "b", "c"], "id", k=5, within="grp", leaf_size=20),
             apply_scaler(df, fit_scaler(df, ["a"]), ["a"])]
    for p in plans:
        text = p._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in text and "NestedLoopJoin" not in text
