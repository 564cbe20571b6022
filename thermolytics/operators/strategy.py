"""Model strategies: a registry of (fit, score) pairs over DataFrames.

A fitted model is a dict of small DataFrames plus plain parameters; it is
saved as Parquet tables under one folder.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .knn import LEAF, KdTree
from .lof import GLOBAL, LofModel, _reference, contamination_offset, fit_lof, lof_novelty
from .regress import fit_hdd_regression, regression_residual
from .scale import apply_scaler, fit_scaler, require_features
from ..functions.params import attach_row
from ..session import materialize

DEFAULT_ID = "_row_id"


@dataclass
class FittedModel:
    strategy: str
    feature_columns: list
    scaler: DataFrame
    regression: DataFrame
    offset: DataFrame       # one row: LOF scores below it are outliers
    lof: LofModel
    params: dict = field(default_factory=dict)


def _with_row_id(df: DataFrame, id_col: str | None) -> tuple[DataFrame, str]:
    """Id that breaks ties between equally near neighbours: a given column, or a hash of the record's
    key and date, so that results do not depend on how rows are laid out."""
    if id_col and id_col in df.columns:
        return df, id_col
    keys = [c for c in ("apartment_record_id", "apartment_id", "building_id", "event_date") if c in df.columns]
    return df.withColumn(DEFAULT_ID, F.xxhash64(*(keys or sorted(df.columns)))), DEFAULT_ID


def fit_lr_lof(features: DataFrame, feature_columns, lof_neighbors: int = 20, lof_contamination="auto",
               within: str | None = None, id_col: str | None = None, leaf_size: int = LEAF) -> FittedModel:
    """Scaler (population std) + energy~hdd regression + LOF on the scaled features."""
    if not feature_columns:
        raise ValueError("Hyperparameter 'feature_columns' must be provided: the names of the model's inputs")
    missing = [c for c in list(feature_columns) + ["hdd", "daily_energy_kwh"] if c not in features.columns]
    if missing:
        raise KeyError(f"Columns not found: {missing}")
    cols = list(feature_columns)
    filled = features.fillna(0.0, subset=[c for c in set(cols + ["hdd", "daily_energy_kwh"])])
    scaler = materialize(fit_scaler(filled, cols), "model-scaler")
    reg = materialize(fit_hdd_regression(filled), "model-regression")
    df, rid = _with_row_id(filled, id_col)
    z = apply_scaler(df, scaler, cols)
    lof = fit_lof(z, [f"z_{c}" for c in cols], rid, k=int(lof_neighbors), within=within, leaf_size=leaf_size)
    # Contamination sets the outlier offset on the training rows' own scores, as often as each vector occurs.
    own = lof.ref.select((-F.col("lof")).alias("lof_score"), F.explode(F.sequence(F.lit(1), F.col("cnt"))).alias("_copy")) \
        if lof_contamination not in (None, "auto") else lof.ref.select((-F.col("lof")).alias("lof_score"))
    offset = materialize(contamination_offset(own, lof_contamination), "model-offset")
    return FittedModel("LR_LOF", cols, scaler, reg, offset, lof,
                       {"lof_neighbors": int(lof_neighbors), "lof_contamination": str(lof_contamination),
                        "within": within, "leaf_size": leaf_size})


def score_lr_lof(model: FittedModel, df: DataFrame, id_col: str | None = None) -> DataFrame:
    """Adds residual, lof_score (novelty, higher = more normal), is_outlier (lof_score below
    the fitted offset) and anomaly_score_combined = |residual| - lof_score."""
    require_features(df, model.feature_columns + ["hdd", "daily_energy_kwh"], ValueError,
                     "Missing feature columns in evaluation data.")
    cols = model.feature_columns
    filled = df.fillna(0.0, subset=list(set(cols + ["hdd", "daily_energy_kwh"])))
    d, rid = _with_row_id(filled, id_col)
    z = apply_scaler(d, model.scaler, cols)
    scored = lof_novelty(model.lof, z, [f"z_{c}" for c in cols], rid)
    scored = regression_residual(scored, model.regression)
    out = attach_row(scored, model.offset) \
        .withColumn("is_outlier", (F.col("lof_score") < F.col("offset")).cast("int")).drop("offset") \
        .withColumn("anomaly_score_combined", F.abs("residual") - F.col("lof_score"))
    return out.drop(*[f"z_{c}" for c in cols], *([DEFAULT_ID] if rid == DEFAULT_ID else []))


STRATEGIES = {"LR_LOF": (fit_lr_lof, score_lr_lof)}


def get_strategy(name: str):
    try:
        return STRATEGIES[name]
    except KeyError:
        raise ValueError(f"Unknown model strategy: {name}") from None


def fit(strategy: str, df: DataFrame, **params) -> FittedModel:
    return get_strategy(strategy)[0](df, **params)


def score(model: FittedModel, df: DataFrame, **kw) -> DataFrame:
    return get_strategy(model.strategy)[1](model, df, **kw)


# ---------------------------------------------------------------- persistence
def save_model(model: FittedModel, path: str) -> None:
    """Parquet tables: scaler, regression, offset, lof_ref, tree_splits, tree_boxes; plus meta JSON."""
    spark = model.scaler.sparkSession
    p = path.rstrip("/")
    model.scaler.write.mode("overwrite").parquet(f"{p}/scaler")
    model.regression.write.mode("overwrite").parquet(f"{p}/regression")
    model.offset.write.mode("overwrite").parquet(f"{p}/offset")
    model.lof.ref.write.mode("overwrite").parquet(f"{p}/lof_ref")
    model.lof.tree.splits.write.mode("overwrite").parquet(f"{p}/tree_splits")
    model.lof.tree.boxes.write.mode("overwrite").parquet(f"{p}/tree_boxes")
    meta = {"strategy": model.strategy, "feature_columns": model.feature_columns, "params": model.params,
            "groups": model.lof.groups, "dims": model.lof.dims, "within": model.lof.within,
            "k": model.lof.k, "depth": model.lof.tree.depth, "leaf_size": model.lof.tree.leaf_size,
            "least": model.lof.tree.least, "leaves": model.lof.tree.leaves, "fanout": 4}
    spark.createDataFrame([(json.dumps(meta),)], "meta string").coalesce(1).write.mode("overwrite").json(f"{p}/meta")


def load_model(spark: SparkSession, path: str) -> FittedModel:
    p = path.rstrip("/")
    meta = json.loads(spark.read.json(f"{p}/meta").first()["meta"])
    ref = spark.read.parquet(f"{p}/lof_ref")
    vectors = ref.select(*meta["groups"], "vid", *meta["dims"], "cnt", "leaf")
    tree = KdTree(vectors, spark.read.parquet(f"{p}/tree_splits"), spark.read.parquet(f"{p}/tree_boxes"),
                  meta["groups"], meta["dims"], meta["depth"], meta["leaf_size"], meta["least"], meta.get("leaves", 0))
    lof = LofModel(_reference(tree, ref), ref, meta["groups"], meta["dims"], meta["within"], meta["k"])
    return FittedModel(meta["strategy"], meta["feature_columns"], spark.read.parquet(f"{p}/scaler"),
                       spark.read.parquet(f"{p}/regression"), spark.read.parquet(f"{p}/offset"), lof, meta["params"])


__all__ = ["FittedModel", "fit", "score", "get_strategy", "save_model", "load_model", "STRATEGIES", "GLOBAL"]
