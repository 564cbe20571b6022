"""Exact quantiles by selection: against numpy, at limits small enough that every step runs."""

import numpy as np
import pytest

from thermolytics.operators import quantile
from thermolytics.operators.quantile import exact_quantile, exact_quantiles

QS = [0.0, 0.003, 0.25, 0.5, 0.95, 1.0]


def shapes():
    rng = np.random.default_rng(3)
    return {"normal": rng.normal(size=3000), "hot value": np.concatenate([np.full(1500, 2.5), rng.normal(size=1500)]),
            "two values": np.repeat([1.0, 2.0], [2000, 1]), "wide": 10.0 ** rng.uniform(-300, 300, 2000) * rng.choice([-1, 1], 2000),
            "infinite": np.concatenate([rng.normal(size=900), [np.inf] * 40, [-np.inf] * 40]), "one": np.array([7.0]),
            "steps": np.round(rng.exponential(size=2500), 1)}


@pytest.mark.parametrize("limit, pivots", [(100_000, 63), (40, 63), (8, 3)])
def test_against_numpy(spark, monkeypatch, limit, pivots):
    monkeypatch.setattr(quantile, "LIMIT", limit)
    monkeypatch.setattr(quantile, "PIVOTS", pivots)
    groups = shapes()
    rows = [(name, float(v)) for name, values in groups.items() for v in values] + [("normal", None), (None, 4.0), (None, 6.0)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(5)
    got = {(r.g, r.q): r.quantile for r in exact_quantiles(df, "v", QS, ["g"]).collect()}
    assert got.pop((None, 0.5)) == 5.0 and len(got) == len(groups) * len(QS) + len(QS) - 1
    for name, values in groups.items():
        for q in QS:
            s, at = np.sort(values), q * (len(values) - 1)
            lo, hi = s[int(np.floor(at))], s[int(np.ceil(at))]
            with np.errstate(invalid="ignore"):
                want = lo + (hi - lo) * (at - np.floor(at))
            assert got[name, q] == pytest.approx(want, nan_ok=True), (name, q)


def test_a_sketch_beyond_its_error_is_noticed(spark, monkeypatch):
    monkeypatch.setattr(quantile, "LIMIT", 50)
    monkeypatch.setattr(quantile, "ACCURACY", 10**9)     # bounds that claim more than the sketch can hold
    keep = quantile.F.percentile_approx
    monkeypatch.setattr(quantile.F, "percentile_approx", lambda c, p, a: keep(c, p, 20 if a == 10**9 else a))
    values = np.random.default_rng(5).normal(size=4000)
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    assert exact_quantile(df, "v", 0.9).first()[0] == pytest.approx(np.quantile(values, 0.9))


def test_nan_is_the_largest_and_null_does_not_count(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (None,), (3.0,)], "v double")
    assert exact_quantile(df, "v", 0.5).first()[0] == 3.0 and np.isnan(exact_quantile(df, "v", 1.0).first()[0])


def test_without_values(spark):
    df = spark.createDataFrame([(None, "a")], "v double, g string")
    assert [tuple(r) for r in exact_quantile(df, "v", 0.5).collect()] == [(None,)]
    assert exact_quantile(df, "v", 0.5, ["g"]).collect() == []
    with pytest.raises(ValueError):
        exact_quantile(df, "v", 1.5)


def test_rows_are_not_exchanged(spark, monkeypatch):
    """No plan sorts or range-partitions the values; what is shuffled has been summed before."""
    plans, keep = [], quantile.materialize

    def spy(df, name, count=False):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return keep(df, name, count)

    monkeypatch.setattr(quantile, "materialize", spy)
    df = spark.range(5000).selectExpr("cast(id * 37 % 5000 as double) as v")
    plans.append(exact_quantile(df, "v", 0.95)._jdf.queryExecution().executedPlan().toString())
    assert all("rangepartitioning" not in p for p in plans)
    assert "Exchange" not in plans[0] and "partial_count" in plans[2]
