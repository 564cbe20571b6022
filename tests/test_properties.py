"""Property tests against plain Python references."""

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from thermolytics.operators.dedup import latest_per_key
from thermolytics.operators.quantile import exact_quantile

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@SETTINGS
@given(values=st.lists(st.sampled_from([0.0, 1.5, 2.0, -3.25, 7.0]) | st.floats(-100, 100, allow_nan=False),
                       min_size=1, max_size=60),
       groups=st.integers(1, 3), q=st.sampled_from([0.0, 0.05, 0.5, 0.95, 1.0]))
def test_exact_quantile_property(spark, values, groups, q):
    g = [i % groups for i in range(len(values))]
    df = spark.createDataFrame([(int(a), float(v)) for a, v in zip(g, values)], "g long, v double")
    got = {r.g: r.quantile for r in exact_quantile(df, "v", q, ["g"]).collect()}
    for k in set(g):
        vals = np.array([v for a, v in zip(g, values) if a == k])
        assert got[k] == pytest.approx(np.quantile(vals, q), abs=1e-9)


@SETTINGS
@given(rows=st.lists(st.tuples(st.sampled_from(["a", "b", "c"]), st.integers(0, 5), st.integers(0, 1000)),
                     min_size=1, max_size=40, unique_by=lambda r: (r[0], r[1])))
def test_latest_per_key_property(spark, rows):
    df = spark.createDataFrame(rows, "k string, t int, v int")
    got = {r.k: (r.t, r.v) for r in latest_per_key(df, ["k"], ["t"]).collect()}
    exp = {}
    for k, t, v in rows:
        if k not in exp or t > exp[k][0]:
            exp[k] = (t, v)
    assert got == exp


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(seed=st.integers(0, 10_000), n=st.integers(2, 90), k=st.integers(1, 8), dims=st.integers(1, 3),
       grid=st.sampled_from([0.5, 1.0]))
def test_lof_property(spark, seed, n, k, dims, grid):
    from tests.lof_brute import lof as brute_lof
    from thermolytics.operators.lof import lof_scores
    rng = np.random.default_rng(seed)
    X = np.round(rng.normal(size=(n, dims)) * 2 / grid) * grid      # coarse grid: ties and copies
    ids = rng.permutation(n) + 1
    cols = [f"x{j}" for j in range(dims)]
    df = spark.createDataFrame([(int(i), *map(float, x)) for i, x in zip(ids, X)], ["id", *cols])
    got = {r.id: r.lof for r in lof_scores(df, cols, "id", k=k, leaf_size=4).collect()}
    exp, _, _ = brute_lof(X, ids, k)
    for i, e in zip(ids, exp):
        if np.isnan(e):
            assert got[int(i)] is None
        else:
            assert got[int(i)] == pytest.approx(e, rel=1e-9, abs=1e-9)


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(seed=st.integers(0, 10_000), n_ref=st.integers(3, 70), n_q=st.integers(1, 30), k=st.integers(1, 6))
def test_lof_novelty_property(spark, seed, n_ref, n_q, k):
    from tests.lof_brute import novelty as brute_novelty
    from thermolytics.operators.lof import fit_lof, lof_novelty
    rng = np.random.default_rng(seed)
    Xr = np.round(rng.normal(size=(n_ref, 2)) * 2)
    Xq = np.round(rng.normal(size=(n_q, 2)) * 2)
    idr = np.arange(n_ref) + 1
    idq = np.arange(n_q) + 10_000
    ref = spark.createDataFrame([(int(i), *map(float, x)) for i, x in zip(idr, Xr)], ["id", "a", "b"])
    qry = spark.createDataFrame([(int(i), *map(float, x)) for i, x in zip(idq, Xq)], ["id", "a", "b"])
    model = fit_lof(ref, ["a", "b"], "id", k=k, leaf_size=4)
    got = {r.id: r.lof for r in lof_novelty(model, qry, ["a", "b"], "id").collect()}
    exp = brute_novelty(Xr, idr, Xq, k)
    for i, e in zip(idq, exp):
        assert got[int(i)] == pytest.approx(e, rel=1e-9, abs=1e-9)
