"""Scaler, regression, strategy registry and scoring."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from thermolytics.operators.quantile import exact_quantile
from thermolytics.operators.regress import fit_hdd_regression, regression_residual
from thermolytics.operators.scale import apply_scaler, fit_scaler
from thermolytics.operators.strategy import fit, get_strategy, load_model, save_model, score
from thermolytics.schemas import MODEL_FEATURES

ROWS = [("apt1", "2024-01-15", 10.0, -0.75, 10.0, 5.0, None, 10.0),
        ("apt1", "2024-01-16", 12.0, -0.3, 12.0, 3.0, 10.0, 11.0),
        ("apt1", "2024-01-17", 8.0, -0.3, 11.0, 4.0, 12.0, 10.0),
        ("apt2", "2024-01-15", 5.0, -0.75, 10.0, 5.0, None, 5.0),
        ("apt2", "2024-01-16", 6.0, -0.4, 12.0, 3.0, 5.0, 5.5)]
COLS = ["apartment_record_id", "event_date", *MODEL_FEATURES]


def feats(spark):
    return spark.createDataFrame(ROWS, COLS).withColumn("event_date", F.to_date("event_date")) \
        .withColumn("building_id", F.lit("bldgA"))


def test_population_std_and_zero_std(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (3.0, 5.0), (10.0, 5.0)], ["a", "c"])
    p = fit_scaler(df, ["a", "c"]).first()
    assert p.a_mean == 4.0 and p.a_std == pytest.approx(3.5355339)
    assert p.c_std == 1.0
    z = apply_scaler(df, fit_scaler(df, ["a", "c"]), ["a", "c"]).collect()
    assert sorted(r.z_c for r in z) == [0.0] * 4


def test_regression_fixture(spark):
    m = fit_hdd_regression(feats(spark)).first()
    assert m.slope == pytest.approx(0.75) and m.intercept == pytest.approx(-0.05)


def test_regression_constant_x(spark):
    df = spark.createDataFrame([(1.0, 3.0), (5.0, 3.0)], ["daily_energy_kwh", "hdd"])
    m = fit_hdd_regression(df).first()
    assert m.slope == 0.0 and m.intercept == 3.0


def test_scoring_formula_fixture(spark):
    """3 ids + features; predictions 0.5 * hdd; LOF scores given -> combined 7.0, 2.1, 8.2."""
    rows = [("apt1", 10.0, 8.0, -1.0), ("apt2", 5.0, 8.0, -1.1), ("apt3", 12.0, 10.0, -1.2)]
    df = spark.createDataFrame(rows, ["apartment_id", "daily_energy_kwh", "hdd", "lof_score"])
    model = spark.createDataFrame([(0.5, 0.0)], ["slope", "intercept"])
    out = regression_residual(df, model).withColumn("c", F.abs("residual") - F.col("lof_score"))
    got = {r.apartment_id: r.c for r in out.collect()}
    assert got == pytest.approx({"apt1": 7.0, "apt2": 2.1, "apt3": 8.2})


def test_fit_errors(spark):
    with pytest.raises(ValueError):
        fit("LR_LOF", feats(spark), feature_columns=[])
    with pytest.raises(KeyError):
        fit("LR_LOF", feats(spark).drop("hdd"), feature_columns=MODEL_FEATURES)
    with pytest.raises(ValueError, match="Unknown model strategy: X"):
        get_strategy("X")


def test_fit_save_load_score(spark, tmp_dir):
    model = fit("LR_LOF", feats(spark), feature_columns=MODEL_FEATURES, lof_neighbors=3)
    save_model(model, f"{tmp_dir}/model")
    loaded = load_model(spark, f"{tmp_dir}/model")
    new = feats(spark).withColumn("daily_energy_kwh", F.col("daily_energy_kwh") + 1)
    a = {r.event_date: r.anomaly_score_combined for r in score(model, new).collect() if r.apartment_record_id == "apt1"}
    b = {r.event_date: r.anomaly_score_combined for r in score(loaded, new).collect() if r.apartment_record_id == "apt1"}
    assert len(a) == 3 and all(v is not None for v in a.values())
    assert a == pytest.approx(b)
    with pytest.raises(ValueError, match="Missing feature columns"):
        score(model, new.drop("hdd"))


def test_exact_quantile_matches_numpy(spark):
    rng = np.random.default_rng(1)
    vals = rng.normal(size=503)
    grp = rng.integers(0, 4, size=503)
    df = spark.createDataFrame([(int(g), float(v)) for g, v in zip(grp, vals)], ["g", "v"])
    for q in (0.0, 0.05, 0.5, 0.95, 1.0):
        assert exact_quantile(df, "v", q).first()[0] == pytest.approx(np.quantile(vals, q))
        got = {r.g: r.quantile for r in exact_quantile(df, "v", q, ["g"]).collect()}
        for g in range(4):
            assert got[g] == pytest.approx(np.quantile(vals[grp == g], q))


def test_feature_store_roundtrip(spark, tmp_dir):
    from thermolytics.operators.dedup import latest_features
    from thermolytics.sources.features import read_features, write_features
    f = feats(spark).withColumn("event_time", F.lit("2024-02-01 00:00:00").cast("timestamp")) \
        .withColumn("daily_water_l", F.lit(1.0)).withColumn("temp_diff_lag_1d", F.lit(None).cast("double"))
    write_features(f, f"{tmp_dir}/store")
    later = f.withColumn("event_time", F.lit("2024-02-02 00:00:00").cast("timestamp")) \
             .withColumn("daily_energy_kwh", F.col("daily_energy_kwh") * 10)
    write_features(later.where("apartment_record_id = 'apt1'"), f"{tmp_dir}/store")
    back = read_features(spark, f"{tmp_dir}/store")
    assert back.where("event_date IS NULL").count() == 0 and back.count() == 8
    got = {(r.apartment_record_id, str(r.event_date)): r.daily_energy_kwh for r in latest_features(back).collect()}
    assert got[("apt1", "2024-01-15")] == 100.0 and got[("apt2", "2024-01-15")] == 5.0 and len(got) == 5


def test_latest_approved_and_none(spark):
    from thermolytics.operators.dedup import latest_approved, require_one
    reg = spark.createDataFrame([("g1", 1, "Approved", "2024-01-01"), ("g1", 2, "Approved", "2024-02-01"),
                                 ("g1", 3, "Rejected", "2024-03-01"), ("g2", 4, "PendingManualApproval", "2024-01-01")],
                                "group_name string, package_id int, status string, creation_time string")
    got = {r.group_name: r.package_id for r in latest_approved(reg).collect()}
    assert got == {"g1": 2}
    with pytest.raises(ValueError, match="group g2"):
        require_one(latest_approved(reg).where("group_name = 'g2'"), "g2")


def test_contamination_and_row_layout(spark):
    """The fraction sets the outlier offset on the training rows; ids from keys make results independent of layout."""
    import numpy as np

    from thermolytics.operators.strategy import fit, score
    rng = np.random.default_rng(3)
    rows = [(f"apt{i % 20}", f"2024-01-{1 + i // 20:02}", *map(float, np.round(rng.normal(size=2), 1)), float(i % 9)) for i in range(200)]
    df = spark.createDataFrame(rows, "apartment_id string, event_date string, daily_energy_kwh double, avg_temp_diff double, hdd double")
    cols = ["daily_energy_kwh", "avg_temp_diff"]

    def fitted(d, **kw):
        return fit("LR_LOF", d, feature_columns=cols, lof_neighbors=7, **kw)

    model = fitted(df, lof_contamination=0.1)
    lof = [-r["lof"] for r in model.lof.ref.collect() for _ in range(r["cnt"])]
    assert model.offset.first()[0] == pytest.approx(np.quantile(lof, 0.1))
    assert fitted(df).offset.first()[0] == -1.5
    got = score(model, df)
    assert got.where("is_outlier = 1").count() > 0
    key = ["apartment_id", "event_date", "anomaly_score_combined"]
    again = score(fitted(df.repartition(7, "hdd"), lof_contamination=0.1), df.orderBy("hdd"))
    a, b = ({tuple(r[:2]): r[2] for r in d.select(*key).collect()} for d in (got, again))
    assert a.keys() == b.keys() and all(a[k] == pytest.approx(b[k], rel=1e-9) for k in a)
