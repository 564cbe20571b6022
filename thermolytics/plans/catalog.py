"""Registered queries: each is (spark, sf_dir) -> DataFrame over the driver's
tables, with an equivalent DuckDB SQL text where SQL can express it.

Float outputs are rounded to 6 decimals (and -0.0 folded into 0.0) in both
engines so that value hashes compare exactly.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.numeric import round6
from ..sources import testviews as tv
from .features import DAILY_FEATURE_COLUMNS, daily_features

QUERIES: dict = {}
ORACLE_SQL: dict = {}


def register(name: str, sql: str | None = None):
    """Register a query; it runs with the session time zone pinned to UTC (the data
    contract), whatever session the caller passes."""
    def deco(fn):
        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return fn(spark, sf_dir)
        QUERIES[name] = run
        if sql is not None:
            ORACLE_SQL[name] = sql
        return fn
    return deco


def rounded(df: DataFrame) -> DataFrame:
    """Round every float column to 6 decimals (output hygiene only)."""
    return df.select(*[round6(f.name).alias(f.name) if isinstance(f.dataType, (T.DoubleType, T.FloatType))
                       else F.col(f.name) for f in df.schema.fields])


def r6(expr: str, alias: str) -> str:
    return f"round(CAST({expr} AS DOUBLE), 6) + 0.0 AS {alias}"


# ---------------------------------------------------------------- features
SQL_DAILY = """
  SELECT building_id, apartment_id, CAST(event_ts AS DATE) AS event_date,
         avg(room_temp_c - setpoint_temp_c) AS avg_temp_diff,
         max(energy_kwh) - min(energy_kwh) AS daily_energy_kwh,
         max(hot_water_litres) - min(hot_water_litres) AS daily_water_l
  FROM meter GROUP BY 1, 2, 3"""
SQL_WEATHER_DAY = """
  SELECT CAST(try_strptime(date_col_name, '%Y-%m-%d') AS DATE) AS event_date,
         avg(hdd) AS hdd, avg(avg_temp_c) AS avg_temp_c
  FROM weather WHERE try_strptime(date_col_name, '%Y-%m-%d') IS NOT NULL GROUP BY 1"""
SQL_JOINED = """
  SELECT d.*, w.hdd, w.avg_temp_c FROM daily d LEFT JOIN wday w ON d.event_date = w.event_date"""
W_SERIES = "PARTITION BY building_id, apartment_id ORDER BY event_date"
SQL_FEATURES = f"""
  SELECT building_id, apartment_id, event_date, avg_temp_diff, daily_energy_kwh, daily_water_l, hdd, avg_temp_c,
         lag(daily_energy_kwh) OVER ({W_SERIES}) AS energy_lag_1d,
         avg(daily_energy_kwh) OVER ({W_SERIES} ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS energy_roll_avg_7d,
         lag(avg_temp_diff) OVER ({W_SERIES}) AS temp_diff_lag_1d
  FROM joined"""
FEATURE_CTES = [("daily", SQL_DAILY), ("wday", SQL_WEATHER_DAY), ("joined", SQL_JOINED), ("feat", SQL_FEATURES)]

FEATURE_SELECT = ", ".join(
    ["building_id", "apartment_id", "event_date"]
    + [r6(c, c) for c in ["avg_temp_diff", "daily_energy_kwh", "daily_water_l", "hdd", "avg_temp_c",
                          "energy_lag_1d", "energy_roll_avg_7d", "temp_diff_lag_1d"]])


def all_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily features over the whole events-derived meter table."""
    return daily_features(tv.meter(spark, sf_dir), tv.weather(spark, sf_dir))


@register("features_daily", tv.with_views(f"SELECT {FEATURE_SELECT} FROM feat", "meter", "weather",
                                          extra=FEATURE_CTES))
def q_features_daily(spark, sf_dir):
    return rounded(all_features(spark, sf_dir))


# ---------------------------------------------------------------- model parts
from ..operators.lof import fit_lof, lof_flag, lof_novelty, lof_scores  # noqa: E402
from ..operators.regress import fit_hdd_regression, regression_residual  # noqa: E402
from ..operators.scale import apply_scaler, fit_scaler, scaler_long  # noqa: E402
from ..schemas import MODEL_FEATURES  # noqa: E402
from ..session import materialize  # noqa: E402

FEATS = MODEL_FEATURES
ZCOLS = [f"z_{c}" for c in FEATS]
KEYS3 = ["building_id", "apartment_id", "event_date"]


def point_id():
    """Row id of a daily feature row: apartment number and day number (unique per row)."""
    return (F.regexp_extract("apartment_id", r"(\d+)$", 1).cast("long") * 100000
            + F.unix_date("event_date").cast("long"))


SQL_POINT_ID = "CAST(regexp_extract(apartment_id, '(\\d+)$', 1) AS BIGINT) * 100000 + (event_date - DATE '1970-01-01')"


def sql_filled(src: str) -> str:
    fills = ", ".join(f"coalesce({c}, 0.0) AS {c}" for c in FEATS)
    return f"SELECT building_id, apartment_id, event_date, {SQL_POINT_ID} AS id, {fills} FROM {src}"


def sql_params(src: str) -> str:
    parts = []
    for c in FEATS:
        parts.append(f"avg({c}) AS m_{c}")
        parts.append(f"CASE WHEN stddev_pop({c}) IS NULL OR stddev_pop({c}) = 0 THEN 1.0 ELSE stddev_pop({c}) END AS s_{c}")
    return f"SELECT {', '.join(parts)} FROM {src}"


def sql_z(src: str, params: str) -> str:
    zs = ", ".join(f"({c} - m_{c}) / s_{c} AS z_{c}" for c in FEATS)
    return f"SELECT building_id, apartment_id, event_date, id, {FEATS[0]}, hdd, {zs} FROM {src} CROSS JOIN {params}"


def sql_dist(a: str, b: str) -> str:
    return "sqrt(" + " + ".join(f"({a}.{z} - {b}.{z}) * ({a}.{z} - {b}.{z})" for z in ZCOLS) + ")"


def sql_lof_ctes(ref: str, k: int = 20, prefix: str = "") -> list:
    """CTEs computing kdist, lrd and lof per row of ``ref`` (building_id, id, z_*), LOF within building."""
    p = prefix
    zlist = ", ".join(ZCOLS)
    return [
        (f"{p}refr", f"SELECT *, min(id) OVER (PARTITION BY building_id, {zlist}) AS rep FROM {ref}"),
        (f"{p}pairs", f"SELECT a.building_id, a.id AS qid, b.id AS cid, b.rep AS crep, {sql_dist('a', 'b')} AS dist "
                      f"FROM {p}refr a JOIN {p}refr b ON a.building_id = b.building_id AND a.id <> b.id"),
        (f"{p}kk", f"SELECT building_id, least({k}, count(*) - 1) AS k FROM {p}refr GROUP BY building_id"),
        (f"{p}rk", f"SELECT x.*, row_number() OVER (PARTITION BY x.qid ORDER BY round(x.dist, 9), x.crep, x.cid) AS rn "
                   f"FROM {p}pairs x"),
        (f"{p}nb", f"SELECT r.* FROM {p}rk r JOIN {p}kk USING (building_id) WHERE r.rn <= {p}kk.k"),
        (f"{p}kd", f"SELECT qid, max(dist) AS kdist FROM {p}nb GROUP BY qid"),
        (f"{p}lrd", f"SELECT n.qid, 1.0 / (avg(greatest(n.dist, d.kdist)) + 1e-10) AS lrd "
                    f"FROM {p}nb n JOIN {p}kd d ON n.cid = d.qid GROUP BY n.qid"),
        (f"{p}lof", f"SELECT n.qid, avg(l2.lrd) / any_value(l1.lrd) AS lof FROM {p}nb n "
                    f"JOIN {p}lrd l1 ON n.qid = l1.qid JOIN {p}lrd l2 ON n.cid = l2.qid GROUP BY n.qid"),
    ]


MODEL_CTES = FEATURE_CTES + [("filled", sql_filled("feat")), ("params", sql_params("filled")),
                             ("z", sql_z("filled", "params"))]


def model_sql(select: str, extra=()) -> str:
    return tv.with_views(select, "meter", "weather", extra=MODEL_CTES + list(extra))


def filled_features(spark, sf_dir):
    f = all_features(spark, sf_dir).fillna(0.0, subset=FEATS)
    return f.withColumn("id", point_id())


def scaled_features(spark, sf_dir):
    f = filled_features(spark, sf_dir)
    return apply_scaler(f, fit_scaler(f, FEATS), FEATS)


@register("scale_params", model_sql(" UNION ALL ".join(
    f"SELECT '{c}' AS feature, {r6(f'm_{c}', 'mean')}, {r6(f's_{c}', 'std')} FROM params" for c in FEATS)))
def q_scale_params(spark, sf_dir):
    f = filled_features(spark, sf_dir)
    return rounded(scaler_long(fit_scaler(f, FEATS), FEATS))


@register("scaled_features", model_sql(
    "SELECT building_id, apartment_id, event_date, " + ", ".join(r6(z, z) for z in ZCOLS) + " FROM z"))
def q_scaled_features(spark, sf_dir):
    return rounded(scaled_features(spark, sf_dir).select(*KEYS3, *ZCOLS))


@register("hdd_regression", model_sql(
    "SELECT " + r6("coalesce(regr_slope(daily_energy_kwh, hdd), 0.0)", "slope") + ", "
    + r6("CASE WHEN regr_slope(daily_energy_kwh, hdd) IS NULL THEN avg(daily_energy_kwh) "
         "ELSE regr_intercept(daily_energy_kwh, hdd) END", "intercept") + ", count(*) AS n FROM filled"))
def q_hdd_regression(spark, sf_dir):
    return rounded(fit_hdd_regression(filled_features(spark, sf_dir)))


SQL_REG = ("SELECT coalesce(regr_slope(daily_energy_kwh, hdd), 0.0) AS slope, "
           "CASE WHEN regr_slope(daily_energy_kwh, hdd) IS NULL THEN avg(daily_energy_kwh) "
           "ELSE regr_intercept(daily_energy_kwh, hdd) END AS intercept FROM filled")


@register("regression_residual", model_sql(
    "SELECT building_id, apartment_id, event_date, "
    + r6("daily_energy_kwh - (intercept + slope * hdd)", "residual") + " FROM filled CROSS JOIN reg",
    extra=[("reg", SQL_REG)]))
def q_regression_residual(spark, sf_dir):
    f = filled_features(spark, sf_dir)
    r = regression_residual(f, fit_hdd_regression(f))
    return rounded(r.select(*KEYS3, "residual"))


@register("lof_by_building", model_sql(
    "SELECT z.building_id, z.apartment_id, z.event_date, " + r6("lof.lof", "lof")
    + " FROM z LEFT JOIN lof ON z.id = lof.qid", extra=sql_lof_ctes("z")))
def q_lof_by_building(spark, sf_dir):
    z = scaled_features(spark, sf_dir)
    out = lof_scores(z, ZCOLS, "id", k=20, within="building_id")
    return rounded(out.select(*KEYS3, "lof"))


# ---------------------------------------------------------------- novelty scoring, combined score
from ..operators.evaluate import evaluate, gate, label_metrics, score_stats, score_threshold, throughput  # noqa: E402

SPLIT_DATE = "2024-01-21"   # rows before: reference (training) set; from this day on: new rows to score


def sql_novelty_ctes(zq: str, ref: str = "r_", out: str = "q") -> list:
    """Novelty LOF (table ``{out}lof``) of rows of ``zq`` against the reference CTEs prefixed ``ref``."""
    return [
        (f"{out}pairs", f"SELECT q.building_id, q.id AS qid, b.id AS cid, b.rep AS crep, {sql_dist('q', 'b')} AS dist "
                        f"FROM {zq} q JOIN {ref}refr b ON q.building_id = b.building_id"),
        (f"{out}rk", "SELECT x.*, row_number() OVER (PARTITION BY x.qid ORDER BY round(x.dist, 9), x.crep, x.cid) AS rn "
                     f"FROM {out}pairs x"),
        (f"{out}nb", f"SELECT r.* FROM {out}rk r JOIN {ref}kk USING (building_id) WHERE r.rn <= {ref}kk.k"),
        (f"{out}lrd", "SELECT n.qid, 1.0 / (avg(greatest(n.dist, d.kdist)) + 1e-10) AS lrd "
                      f"FROM {out}nb n JOIN {ref}kd d ON n.cid = d.qid GROUP BY n.qid"),
        (f"{out}lof", f"SELECT n.qid, avg(l2.lrd) / any_value(q.lrd) AS lof FROM {out}nb n "
                      f"JOIN {out}lrd q ON n.qid = q.qid JOIN {ref}lrd l2 ON n.cid = l2.qid GROUP BY n.qid"),
    ]


def novelty_ctes(qry_sql: str, pre=()) -> list:
    """Reference = filled feature rows before SPLIT_DATE; new rows from ``qry_sql``."""
    return FEATURE_CTES + list(pre) + [
    ("filled", sql_filled("feat")),
    ("ref_f", f"SELECT * FROM filled WHERE event_date < DATE '{SPLIT_DATE}'"),
    ("qry_f", qry_sql),
    ("params", sql_params("ref_f")),
    ("zr", sql_z("ref_f", "params")),
    ("zq", sql_z("qry_f", "params")),
    ("reg", SQL_REG.replace("FROM filled", "FROM ref_f")),
] + sql_lof_ctes("zr", prefix="r_") + sql_novelty_ctes("zq") + [
    ("scores", "SELECT zq.apartment_id, zq.building_id, zq.event_date, "
               "abs(zq.daily_energy_kwh - (reg.intercept + reg.slope * zq.hdd)) + qlof.lof AS anomaly_score_combined "
               "FROM zq CROSS JOIN reg LEFT JOIN qlof ON zq.id = qlof.qid"),
    ]


NOVELTY_CTES = novelty_ctes(f"SELECT * FROM filled WHERE event_date >= DATE '{SPLIT_DATE}'")


def novelty_sql(select: str, extra=(), views=("meter", "weather")) -> str:
    return tv.with_views(select, *views, extra=NOVELTY_CTES + list(extra))


def split_sets(spark, sf_dir):
    f = materialize(filled_features(spark, sf_dir), "features")     # scaler, fit, scoring and regression read it
    ref = f.where(F.col("event_date") < F.lit(SPLIT_DATE).cast("date"))
    qry = f.where(F.col("event_date") >= F.lit(SPLIT_DATE).cast("date"))
    params = materialize(fit_scaler(ref, FEATS), "scaler")          # one row, which reference and new rows share
    return apply_scaler(ref, params, FEATS), apply_scaler(qry, params, FEATS), ref


def novelty_scores(spark, sf_dir):
    """Combined score |residual| + LOF of the new rows against the reference rows."""
    zr, zq, ref = split_sets(spark, sf_dir)
    model = fit_lof(zr, ZCOLS, "id", k=20, within="building_id")
    scored = lof_novelty(model, zq, ZCOLS, "id")
    scored = regression_residual(scored, fit_hdd_regression(ref))
    return scored.select("apartment_id", "building_id", "event_date",
                         (F.abs("residual") - F.col("lof_score")).alias("anomaly_score_combined"), "lof")


@register("lof_novelty", novelty_sql(
    "SELECT zq.building_id, zq.apartment_id, zq.event_date, " + r6("qlof.lof", "lof")
    + " FROM zq LEFT JOIN qlof ON zq.id = qlof.qid"))
def q_lof_novelty(spark, sf_dir):
    zr, zq, _ = split_sets(spark, sf_dir)
    model = fit_lof(zr, ZCOLS, "id", k=20, within="building_id")
    return rounded(lof_novelty(model, zq, ZCOLS, "id").select(*KEYS3, "lof"))


@register("lof_flag", model_sql(
    "SELECT z.building_id, z.apartment_id, z.event_date, " + r6("lof.lof", "lof")
    + ", CAST(-lof.lof < -1.5 AS INTEGER) AS is_outlier FROM z LEFT JOIN lof ON z.id = lof.qid",
    extra=sql_lof_ctes("z")))
def q_lof_flag(spark, sf_dir):
    z = scaled_features(spark, sf_dir)
    out = lof_flag(lof_scores(z, ZCOLS, "id", k=20, within="building_id"), "auto")
    return rounded(out.select(*KEYS3, "lof", "is_outlier"))


@register("lof_flag_contamination", model_sql(
    "SELECT z.building_id, z.apartment_id, z.event_date, " + r6("lof.lof", "lof")
    + ", CAST(-lof.lof < off.offset AS INTEGER) AS is_outlier FROM z LEFT JOIN lof ON z.id = lof.qid "
    "CROSS JOIN off", extra=sql_lof_ctes("z") + [
        ("off", "SELECT quantile_cont(-lof, 0.05) AS offset FROM z LEFT JOIN lof ON z.id = lof.qid")]))
def q_lof_flag_contamination(spark, sf_dir):
    z = scaled_features(spark, sf_dir)
    out = lof_flag(lof_scores(z, ZCOLS, "id", k=20, within="building_id"), 0.05)
    return rounded(out.select(*KEYS3, "lof", "is_outlier"))


@register("combined_score", novelty_sql(
    "SELECT apartment_id, building_id, event_date, " + r6("anomaly_score_combined", "anomaly_score_combined")
    + " FROM scores"))
def q_combined_score(spark, sf_dir):
    return rounded(novelty_scores(spark, sf_dir).drop("lof"))


# ---------------------------------------------------------------- evaluation
LABEL_CTE = [("lab", "SELECT apartment_record_id, event_date, max(is_anomaly) AS is_anomaly "
                     "FROM labels_v GROUP BY 1, 2")]
LABELS_VIEW = ("labels_v", tv.SQL_VIEWS["labels"])


def labels_for(spark, sf_dir):
    return tv.labels(spark, sf_dir)


def scores_keyed(spark, sf_dir):
    return novelty_scores(spark, sf_dir).withColumnRenamed("apartment_id", "apartment_record_id")


STATS_SELECT = ("SELECT " + r6("avg(anomaly_score_combined)", "score_mean") + ", "
                + r6("stddev_samp(anomaly_score_combined)", "score_stddev") + ", "
                + r6("min(anomaly_score_combined)", "score_min") + ", "
                + r6("max(anomaly_score_combined)", "score_max") + ", "
                + "count(anomaly_score_combined) AS num_records_evaluated FROM scores")


@register("score_stats", novelty_sql(STATS_SELECT))
def q_score_stats(spark, sf_dir):
    return rounded(score_stats(novelty_scores(spark, sf_dir)))


@register("score_quantile", novelty_sql(
    "SELECT " + r6("quantile_cont(anomaly_score_combined, 0.95)", "threshold_used") + " FROM scores"))
def q_score_quantile(spark, sf_dir):
    return rounded(score_threshold(novelty_scores(spark, sf_dir), q=0.95))


SQL_METRICS = """
  SELECT CASE WHEN tp + fp = 0 THEN 0.0 ELSE tp / (tp + fp) END AS precision,
         CASE WHEN tp + fn = 0 THEN 0.0 ELSE tp / (tp + fn) END AS recall,
         CASE WHEN 2 * tp + fp + fn = 0 THEN 0.0 ELSE 2 * tp / (2 * tp + fp + fn) END AS f1_score
  FROM (SELECT CAST(count(*) FILTER (WHERE pred AND actual) AS DOUBLE) AS tp,
               CAST(count(*) FILTER (WHERE pred AND NOT actual) AS DOUBLE) AS fp,
               CAST(count(*) FILTER (WHERE NOT pred AND actual) AS DOUBLE) AS fn
        FROM (SELECT s.anomaly_score_combined > t.thr AS pred, coalesce(l.is_anomaly, 0) = 1 AS actual
              FROM scores s CROSS JOIN thr t
              LEFT JOIN lab l ON l.apartment_record_id = s.apartment_id AND l.event_date = s.event_date) j) c"""
THR_CTE = [("thr", "SELECT quantile_cont(anomaly_score_combined, 0.95) AS thr FROM scores")]


@register("label_metrics", novelty_sql(
    "SELECT " + ", ".join(r6(c, c) for c in ("precision", "recall", "f1_score")) + " FROM metrics",
    extra=LABEL_CTE + THR_CTE + [("metrics", SQL_METRICS)], views=("meter", "weather", "labels_v")))
def q_label_metrics(spark, sf_dir):
    s = materialize(scores_keyed(spark, sf_dir), "scores")          # read for the threshold and for the metrics
    thr = score_threshold(s, q=0.95)
    return rounded(label_metrics(s, labels_for(spark, sf_dir), thr))


@register("evaluation_report", novelty_sql(
    "SELECT " + ", ".join(r6(c, c) for c in ("score_mean", "score_stddev", "score_min", "score_max")) + ", "
    "num_records_evaluated, " + r6("thr", "threshold_used") + ", "
    + ", ".join(r6(c, c) for c in ("precision", "recall", "f1_score"))
    + ", CASE WHEN num_records_evaluated = 0 THEN 'NoData' ELSE 'Success' END AS status "
    "FROM st CROSS JOIN thr CROSS JOIN metrics",
    extra=LABEL_CTE + THR_CTE + [("metrics", SQL_METRICS), ("st", STATS_SELECT.replace(
        "FROM scores", "FROM scores").replace("SELECT ", "SELECT ", 1))],
    views=("meter", "weather", "labels_v")))
def q_evaluation_report(spark, sf_dir):
    s = scores_keyed(spark, sf_dir)
    return rounded(evaluate(s, labels_for(spark, sf_dir), q=0.95))


# ---------------------------------------------------------------- ingest and feature steps
import datetime as _dt  # noqa: E402

from ..operators.clean import clean_meter  # noqa: E402
from ..operators.daily import daily_consumption  # noqa: E402
from ..operators.dedup import latest_approved, latest_features  # noqa: E402
from ..operators.weather import join_weather, prepare_weather  # noqa: E402
from ..operators.windows import add_lag_rolling  # noqa: E402
from .features import inference_features, training_features  # noqa: E402

METER_OUT = ["event_ts", "meter_id", "apartment_id", "building_id", "energy_kwh", "room_temp_c",
             "setpoint_temp_c", "hot_water_litres", "year", "month", "day"]
SQL_CLEAN = """
  SELECT try_strptime(timestamp_str, '%Y-%m-%d %H:%M:%S') AS event_ts, meter_id, apartment_id, building_id,
         round(energy_kwh, 6) + 0.0 AS energy_kwh, round(room_temp_c, 6) + 0.0 AS room_temp_c,
         round(setpoint_temp_c, 6) + 0.0 AS setpoint_temp_c, round(hot_water_litres, 6) + 0.0 AS hot_water_litres,
         CAST(year(try_strptime(timestamp_str, '%Y-%m-%d %H:%M:%S')) AS INTEGER) AS year,
         CAST(month(try_strptime(timestamp_str, '%Y-%m-%d %H:%M:%S')) AS INTEGER) AS month,
         CAST(day(try_strptime(timestamp_str, '%Y-%m-%d %H:%M:%S')) AS INTEGER) AS day
  FROM raw
  WHERE try_strptime(timestamp_str, '%Y-%m-%d %H:%M:%S') IS NOT NULL AND meter_id IS NOT NULL"""


@register("ingest_clean", tv.with_views(SQL_CLEAN, "raw"))
def q_ingest_clean(spark, sf_dir):
    return rounded(clean_meter(tv.raw(spark, sf_dir)))


DAILY_SELECT = "building_id, apartment_id, event_date, " + ", ".join(
    r6(c, c) for c in ("avg_temp_diff", "daily_energy_kwh", "daily_water_l"))


@register("daily_consumption", tv.with_views(f"SELECT {DAILY_SELECT} FROM daily", "meter",
                                             extra=[("daily", SQL_DAILY)]))
def q_daily_consumption(spark, sf_dir):
    return rounded(daily_consumption(tv.meter(spark, sf_dir)))


@register("daily_consumption_per_meter", tv.with_views(
    f"SELECT {DAILY_SELECT} FROM pm", "meter", extra=[("bm", """
      SELECT building_id, apartment_id, CAST(event_ts AS DATE) AS event_date, meter_id,
             sum(room_temp_c - setpoint_temp_c) AS g, count(room_temp_c - setpoint_temp_c) AS n,
             max(energy_kwh) - min(energy_kwh) AS e, max(hot_water_litres) - min(hot_water_litres) AS w
      FROM meter GROUP BY 1, 2, 3, 4"""), ("pm", """
      SELECT building_id, apartment_id, event_date, sum(g) / sum(n) AS avg_temp_diff,
             sum(e) AS daily_energy_kwh, sum(w) AS daily_water_l FROM bm GROUP BY 1, 2, 3""")]))
def q_daily_consumption_per_meter(spark, sf_dir):
    return rounded(daily_consumption(tv.meter(spark, sf_dir), per_meter=True))


@register("weather_join", tv.with_views(
    f"SELECT {DAILY_SELECT}, {r6('hdd', 'hdd')}, {r6('avg_temp_c', 'avg_temp_c')} FROM joined", "meter", "weather",
    extra=[("daily", SQL_DAILY), ("wday", SQL_WEATHER_DAY), ("joined", SQL_JOINED)]))
def q_weather_join(spark, sf_dir):
    d = daily_consumption(tv.meter(spark, sf_dir))
    return rounded(join_weather(d, prepare_weather(tv.weather(spark, sf_dir))))


def _joined(spark, sf_dir):
    d = daily_consumption(tv.meter(spark, sf_dir))
    return join_weather(d, prepare_weather(tv.weather(spark, sf_dir)))


@register("lag_features", tv.with_views(
    f"SELECT building_id, apartment_id, event_date, {r6('energy_lag_1d', 'energy_lag_1d')}, "
    f"{r6('temp_diff_lag_1d', 'temp_diff_lag_1d')} FROM feat", "meter", "weather", extra=FEATURE_CTES))
def q_lag_features(spark, sf_dir):
    return rounded(add_lag_rolling(_joined(spark, sf_dir)).select(*KEYS3, "energy_lag_1d", "temp_diff_lag_1d"))


@register("rolling_7_rows", tv.with_views(
    f"SELECT building_id, apartment_id, event_date, {r6('energy_roll_avg_7d', 'energy_roll_avg_7d')} FROM feat",
    "meter", "weather", extra=FEATURE_CTES))
def q_rolling_7_rows(spark, sf_dir):
    return rounded(add_lag_rolling(_joined(spark, sf_dir)).select(*KEYS3, "energy_roll_avg_7d"))


W_CAL = "PARTITION BY building_id, apartment_id ORDER BY event_date"


@register("rolling_7_days", tv.with_views(
    f"""SELECT building_id, apartment_id, event_date,
          {r6(f"max(daily_energy_kwh) OVER ({W_CAL} RANGE BETWEEN INTERVAL 1 DAY PRECEDING AND INTERVAL 1 DAY PRECEDING)", 'energy_lag_1d')},
          {r6(f"avg(daily_energy_kwh) OVER ({W_CAL} RANGE BETWEEN INTERVAL 6 DAY PRECEDING AND CURRENT ROW)", 'energy_roll_avg_7d')},
          {r6(f"max(avg_temp_diff) OVER ({W_CAL} RANGE BETWEEN INTERVAL 1 DAY PRECEDING AND INTERVAL 1 DAY PRECEDING)", 'temp_diff_lag_1d')}
        FROM joined""", "meter", "weather",
    extra=[("daily", SQL_DAILY), ("wday", SQL_WEATHER_DAY), ("joined", SQL_JOINED)]))
def q_rolling_7_days(spark, sf_dir):
    out = add_lag_rolling(_joined(spark, sf_dir), calendar=True)
    return rounded(out.select(*KEYS3, "energy_lag_1d", "energy_roll_avg_7d", "temp_diff_lag_1d"))


def sql_feature_ctes(p: str, lo: str, hi: str) -> list:
    """Feature CTEs over the meter rows of whole days [lo, hi] (prefix p)."""
    hi_next = (_dt.date.fromisoformat(hi) + _dt.timedelta(days=1)).isoformat()
    return [
        (f"{p}m", f"SELECT * FROM meter WHERE event_ts >= DATE '{lo}' AND event_ts < DATE '{hi_next}'"),
        (f"{p}daily", SQL_DAILY.replace("FROM meter", f"FROM {p}m")),
        (f"{p}joined", f"SELECT d.*, w.hdd, w.avg_temp_c FROM {p}daily d LEFT JOIN wday w ON d.event_date = w.event_date"),
        (f"{p}feat", SQL_FEATURES.replace("FROM joined", f"FROM {p}joined")),
    ]


FEATURE_OUT = ["building_id", "daily_energy_kwh", "avg_temp_diff", "daily_water_l", "hdd", "avg_temp_c",
               "energy_lag_1d", "energy_roll_avg_7d", "temp_diff_lag_1d"]
FEATURE_OUT_SQL = "apartment_id AS apartment_record_id, event_date, building_id, " + ", ".join(
    r6(c, c) for c in FEATURE_OUT[1:])
EVENT_TIME_1 = "2024-02-01 00:00:00"
EVENT_TIME_2 = "2024-02-02 00:00:00"


def _train_feats(spark, sf_dir, start, end, warmup=True, event_time=EVENT_TIME_1):
    et = F.lit(event_time).cast("timestamp")
    return training_features(tv.meter(spark, sf_dir), tv.weather(spark, sf_dir), start, end,
                             warmup=warmup, event_time=et)


@register("training_features", tv.with_views(
    f"SELECT {FEATURE_OUT_SQL} FROM t_feat WHERE event_date BETWEEN DATE '2024-01-08' AND DATE '2024-01-31'",
    "meter", "weather", extra=[("wday", SQL_WEATHER_DAY)] + sql_feature_ctes("t_", "2024-01-01", "2024-01-31")))
def q_training_features(spark, sf_dir):
    f = _train_feats(spark, sf_dir, "2024-01-08", "2024-01-31")
    return rounded(f.drop("event_time"))


@register("training_features_no_warmup", tv.with_views(
    f"SELECT {FEATURE_OUT_SQL} FROM t_feat", "meter", "weather",
    extra=[("wday", SQL_WEATHER_DAY)] + sql_feature_ctes("t_", "2024-01-08", "2024-01-31")))
def q_training_features_no_warmup(spark, sf_dir):
    return rounded(_train_feats(spark, sf_dir, "2024-01-08", "2024-01-31", warmup=False).drop("event_time"))


INFER_DATE = "2024-01-17"


@register("features_for_date", tv.with_views(
    "SELECT apartment_id, building_id, event_date, " + ", ".join(
        r6(f"coalesce({c}, 0.0)", c) for c in ("daily_energy_kwh", "avg_temp_diff", "hdd", "avg_temp_c",
                                               "energy_lag_1d", "energy_roll_avg_7d", "temp_diff_lag_1d"))
    + f" FROM i_feat WHERE event_date = DATE '{INFER_DATE}'", "meter", "weather",
    extra=[("wday", SQL_WEATHER_DAY)] + sql_feature_ctes("i_", "2024-01-10", INFER_DATE)))
def q_features_for_date(spark, sf_dir):
    return rounded(inference_features(tv.meter(spark, sf_dir), tv.weather(spark, sf_dir), INFER_DATE))


@register("latest_features", tv.with_views(
    f"""SELECT {FEATURE_OUT_SQL}, event_time FROM (
          SELECT *, row_number() OVER (PARTITION BY apartment_id, building_id, event_date ORDER BY event_time DESC) AS rn
          FROM (SELECT *, '{EVENT_TIME_1}' AS event_time FROM r1_feat
                WHERE event_date BETWEEN DATE '2024-01-01' AND DATE '2024-01-20'
                UNION ALL
                SELECT *, '{EVENT_TIME_2}' AS event_time FROM r2_feat
                WHERE event_date BETWEEN DATE '2024-01-15' AND DATE '2024-01-31') u) x WHERE rn = 1""",
    "meter", "weather", extra=[("wday", SQL_WEATHER_DAY)]
    + sql_feature_ctes("r1_", "2023-12-25", "2024-01-20") + sql_feature_ctes("r2_", "2024-01-08", "2024-01-31")))
def q_latest_features(spark, sf_dir):
    run1 = _train_feats(spark, sf_dir, "2024-01-01", "2024-01-20", event_time=EVENT_TIME_1)
    run2 = _train_feats(spark, sf_dir, "2024-01-15", "2024-01-31", event_time=EVENT_TIME_2)
    out = latest_features(run1.unionByName(run2))
    return rounded(out.withColumn("event_time", F.date_format("event_time", "yyyy-MM-dd HH:mm:ss")))


SQL_REGISTRY = """
  SELECT 'grp' || CAST(o_custkey AS VARCHAR) AS group_name, o_orderkey AS package_id,
         CASE o_orderstatus WHEN 'F' THEN 'Approved' WHEN 'O' THEN 'PendingManualApproval' ELSE 'Rejected' END AS status,
         o_orderdate AS creation_time
  FROM orders"""


def registry(spark, sf_dir):
    """Model-package registry view over ``orders``: group per customer, status per order status."""
    o = spark.read.parquet(f"{sf_dir}/orders.parquet")
    status = (F.when(F.col("o_orderstatus") == "F", "Approved")
              .when(F.col("o_orderstatus") == "O", "PendingManualApproval").otherwise("Rejected"))
    return o.select(F.concat(F.lit("grp"), F.col("o_custkey").cast("string")).alias("group_name"),
                    F.col("o_orderkey").alias("package_id"), status.alias("status"),
                    F.col("o_orderdate").alias("creation_time"))


@register("latest_approved", tv.with_views(
    """SELECT group_name, package_id, status, strftime(creation_time, '%Y-%m-%d %H:%M:%S') AS creation_time FROM (
         SELECT *, row_number() OVER (PARTITION BY group_name ORDER BY creation_time DESC, package_id DESC) AS rn
         FROM reg WHERE status = 'Approved') x WHERE rn = 1""", extra=[("reg", SQL_REGISTRY)]))
def q_latest_approved(spark, sf_dir):
    out = latest_approved(registry(spark, sf_dir))
    return out.withColumn("creation_time", F.date_format("creation_time", "yyyy-MM-dd HH:mm:ss"))


# ---------------------------------------------------------------- alerts
from ..operators.alerts import alert_counts, dedupe_alerts, make_alerts, merge_alerts, parse_scores  # noqa: E402
from ..operators.validate import check_contract  # noqa: E402
from ..session import staging_path  # noqa: E402
from ..sources.alerts_store import alerts_for_date, delete_alerts, read_alerts  # noqa: E402
from ..sources.scores import read_scores  # noqa: E402

THRESHOLD = 5.0
ALERT_TIME_1 = "2024-02-01T05:00:00"
ALERT_TIME_2 = "2024-02-02T05:00:00"
ALERT_OUT = ["AlertID", "ApartmentID", "EventDate", "BuildingID", "AnomalyScore", "Threshold", "Status", "SourceGroup"]


def residual_scores(spark, sf_dir):
    """Score rows for the alert steps: |energy - regression(hdd)| of every daily row."""
    f = materialize(filled_features(spark, sf_dir), "features")
    r = regression_residual(f, fit_hdd_regression(f))
    return r.select("apartment_id", "building_id", F.date_format("event_date", "yyyy-MM-dd").alias("event_date"),
                    F.round(F.abs("residual"), 6).alias("score"), F.dayofmonth("event_date").alias("dom"))


def score_lines(scores):
    """CSV lines as a scoring step writes them, with some damaged lines derived from the
    day: day 13 has a non-numeric score, day 27 lacks the score field, day 29 has a fifth field."""
    base = F.concat_ws(",", "apartment_id", "building_id", "event_date")
    s = F.col("score").cast("string")
    line = (F.when(F.col("dom") == 27, base)
            .when(F.col("dom") == 13, F.concat(base, F.lit(",invalid_score")))
            .when(F.col("dom") == 29, F.concat(base, F.lit(","), s, F.lit(",x")))
            .otherwise(F.concat(base, F.lit(","), s)))
    return scores.select(F.col("building_id").alias("file_group"), line.alias("line"))


def write_score_files(spark, sf_dir) -> str:
    """Score CSV files, one folder per building, under a fresh staging path."""
    path = staging_path(spark, "scores")
    (score_lines(residual_scores(spark, sf_dir)).write.partitionBy("file_group")
     .option("sep", "\t").option("header", "false").csv(path))
    return path


def source_group(col="S3SourceFile"):
    return F.regexp_extract(F.col(col), r"file_group=([^/]+)", 1)


def parsed_scores(spark, sf_dir):
    """(parsed, rejected) of the written files; parsed once, as several steps branch on the rows."""
    return parse_scores(materialize(read_scores(spark, write_score_files(spark, sf_dir)), "score-rows"))


def alert_rows(good, alert_time=ALERT_TIME_1, status="Unseen"):
    return dedupe_alerts(make_alerts(good, THRESHOLD, alert_time, status))


def alert_out(a, extra=()):
    return rounded(a.withColumn("SourceGroup", source_group()).select(*ALERT_OUT, *extra))


SQL_ALERT_CTES = FEATURE_CTES + [
    ("filled", sql_filled("feat")), ("reg", SQL_REG),
    ("rs", "SELECT apartment_id, building_id, strftime(event_date, '%Y-%m-%d') AS event_date, "
           "round(abs(daily_energy_kwh - (intercept + slope * hdd)), 6) AS score, dayofmonth(event_date) AS dom "
           "FROM filled CROSS JOIN reg"),
    ("lines", "SELECT building_id AS file_group, CASE WHEN dom = 27 THEN b WHEN dom = 13 THEN b || ',invalid_score' "
              "WHEN dom = 29 THEN b || ',' || CAST(score AS VARCHAR) || ',x' ELSE b || ',' || CAST(score AS VARCHAR) END "
              "AS line FROM (SELECT *, apartment_id || ',' || building_id || ',' || event_date AS b FROM rs) t"),
    ("fields", "SELECT file_group, string_split(line, ',') AS f FROM lines"),
    ("okrows", "SELECT file_group, f, len(f) = 4 AND TRY_CAST(f[4] AS DOUBLE) IS NOT NULL "
               "AND isfinite(TRY_CAST(f[4] AS DOUBLE)) AS ok FROM fields"),
    ("good", "SELECT f[1] AS apartment_id, f[2] AS building_id, f[3] AS event_date, "
             "TRY_CAST(f[4] AS DOUBLE) AS score, file_group FROM okrows WHERE ok"),
    ("alerts", f"SELECT apartment_id || '#' || event_date AS AlertID, apartment_id AS ApartmentID, "
               f"event_date AS EventDate, building_id AS BuildingID, round(score, 6) + 0.0 AS AnomalyScore, "
               f"CAST({THRESHOLD} AS DOUBLE) AS Threshold, 'Unseen' AS Status, file_group AS SourceGroup "
               f"FROM good WHERE score > {THRESHOLD}"),
]


def alert_sql(select, extra=()):
    return tv.with_views(select, "meter", "weather", extra=SQL_ALERT_CTES + list(extra))


@register("alerts", alert_sql("SELECT * FROM alerts"))
def q_alerts(spark, sf_dir):
    good, _ = parsed_scores(spark, sf_dir)
    return alert_out(alert_rows(good))


@register("alert_counts", alert_sql(
    f"""SELECT file_group AS source_group, count(*) FILTER (WHERE ok) AS rows_parsed,
               count(*) FILTER (WHERE NOT ok) AS rows_rejected,
               count(*) FILTER (WHERE ok AND TRY_CAST(f[4] AS DOUBLE) > {THRESHOLD}) AS alerts_generated
        FROM okrows GROUP BY file_group"""))
def q_alert_counts(spark, sf_dir):
    good, bad = parsed_scores(spark, sf_dir)
    g = good.withColumn("source_file", source_group("source_file"))
    b = bad.withColumn("source_file", source_group("source_file"))
    return alert_counts(g, b, THRESHOLD).withColumnRenamed("source_file", "source_group")


@register("alerts_upsert", alert_sql(
    """SELECT AlertID, ApartmentID, EventDate, BuildingID, AnomalyScore, Threshold, Status, SourceGroup, AlertTimestamp
       FROM (SELECT *, row_number() OVER (PARTITION BY AlertID ORDER BY AlertTimestamp DESC) AS rn FROM (
               SELECT * REPLACE ('Seen' AS Status), '""" + ALERT_TIME_1 + """' AS AlertTimestamp FROM alerts
               WHERE EventDate <= '2024-01-20'
               UNION ALL
               SELECT *, '""" + ALERT_TIME_2 + """' AS AlertTimestamp FROM alerts WHERE EventDate >= '2024-01-15') u) x
       WHERE rn = 1"""))
def q_alerts_upsert(spark, sf_dir):
    good, _ = parsed_scores(spark, sf_dir)
    run1 = alert_rows(good.where(F.col("event_date") <= "2024-01-20"), ALERT_TIME_1, "Seen")
    run2 = alert_rows(good.where(F.col("event_date") >= "2024-01-15"), ALERT_TIME_2, "Unseen")
    return alert_out(merge_alerts(run1, run2), ["AlertTimestamp"])


@register("alerts_for_date", alert_sql("SELECT * FROM alerts WHERE EventDate = '2024-01-18'"))
def q_alerts_for_date(spark, sf_dir):
    good, _ = parsed_scores(spark, sf_dir)
    return alert_out(alerts_for_date(alert_rows(good), "2024-01-18"))


@register("alerts_delete", alert_sql(
    "SELECT * FROM alerts WHERE AlertID NOT IN (SELECT AlertID FROM alerts WHERE BuildingID = 'bldg3')"))
def q_alerts_delete(spark, sf_dir):
    good, _ = parsed_scores(spark, sf_dir)
    a = alert_rows(good)
    return alert_out(delete_alerts(a, a.where(F.col("BuildingID") == "bldg3").select("AlertID")))


# ---------------------------------------------------------------- schema contract
CONTRACT = {"columns": [
    {"name": "timestamp_str", "type": "timestamp"}, {"name": "Meter_ID", "type": "string"},
    {"name": "apartment_id", "type": "string"}, {"name": "building_id", "type": "STRING"},
    {"name": "energy_kwh", "type": "double"}, {"name": "room_temp_c", "type": "double"},
    {"name": "setpoint_temp_c", "type": "double"}, {"name": "hot_water_litres", "type": "double"},
    {"name": "flow_rate", "type": "double"}]}


def _contract_sql() -> str:
    rows = [("timestamp_str", "'timestamp'", "'string'", "type_mismatch", "TIMESTAMP"),
            ("meter_id", "'string'", "'string'", "ok", "VARCHAR"),
            ("apartment_id", "'string'", "'string'", "ok", "VARCHAR"),
            ("building_id", "'STRING'", "'string'", "ok", "VARCHAR"),
            ("energy_kwh", "'double'", "'double'", "ok", "DOUBLE"),
            ("room_temp_c", "'double'", "'double'", "ok", "DOUBLE"),
            ("setpoint_temp_c", "'double'", "'double'", "ok", "DOUBLE"),
            ("hot_water_litres", "'double'", "'double'", "ok", "DOUBLE")]
    aggs = ["count(*) AS nrows"]
    for i, (c, _e, _a, _s, dt) in enumerate(rows):
        aggs.append(f"count(*) FILTER (WHERE {c} IS NULL) AS n{i}")
        aggs.append(f"count(*) FILTER (WHERE {c} IS NOT NULL AND TRY_CAST({c} AS {dt}) IS NULL) AS b{i}")
    aggs.append("count(*) FILTER (WHERE extra_raw_col IS NULL) AS nx")
    parts = [f"SELECT '{c}' AS \"column\", {e} AS expected, {a} AS actual, '{s}' AS status, nrows AS \"rows\", "
             f"n{i} AS nulls, b{i} AS invalid FROM prof" for i, (c, e, a, s, _d) in enumerate(rows)]
    parts.append("SELECT 'flow_rate', 'double', NULL, 'missing', NULL, NULL, NULL FROM prof")
    parts.append("SELECT 'extra_raw_col', NULL, 'string', 'extra', nrows, nx, NULL FROM prof")
    return tv.with_views(" UNION ALL ".join(parts), "raw", extra=[("prof", f"SELECT {', '.join(aggs)} FROM raw")])


@register("schema_profile", _contract_sql())
def q_schema_profile(spark, sf_dir):
    return check_contract(tv.raw(spark, sf_dir), CONTRACT)


# ---------------------------------------------------------------- incremental jobs
from ..schemas import METER  # noqa: E402
from ..streaming.alert_stream import stream_alerts  # noqa: E402
from ..streaming.ingest_stream import ingest_incremental  # noqa: E402


@register("incremental_ingest", tv.with_views(SQL_CLEAN, "raw"))
def q_incremental_ingest(spark, sf_dir):
    """Raw rows land as JSON files; the streaming job picks up all new files and appends."""
    src = staging_path(spark, "raw-json")
    tv.raw(spark, sf_dir).drop("extra_raw_col").write.json(src)
    dest, cp = staging_path(spark, "meter"), staging_path(spark, "meter-cp")
    ingest_incremental(spark, src, dest, cp)
    return rounded(spark.read.schema(METER).parquet(dest).select(*METER_OUT))


@register("stream_alerts", alert_sql("SELECT * FROM alerts"))
def q_stream_alerts(spark, sf_dir):
    """New score files -> streaming micro-batches -> upsert into the alert store."""
    scores = write_score_files(spark, sf_dir)
    store, cp = staging_path(spark, "alert-store"), staging_path(spark, "alert-cp")
    stream_alerts(spark, scores, store, cp, THRESHOLD, ALERT_TIME_1)
    a = read_alerts(spark, store).withColumn("AnomalyScore", F.col("AnomalyScore").cast("double")) \
                                 .withColumn("Threshold", F.col("Threshold").cast("double"))
    return alert_out(a)


# ---------------------------------------------------------------- evaluation per run and gate
RUN_KEYS = ["building_id", "event_date"]


@register("evaluation_gate", alert_sql("""
    SELECT building_id, event_date, """ + r6("f1_score", "f1_score") + ", " + r6("tput", "throughput") + ", "
    + r6("prev", "prev_throughput") + ", " + r6("dev", "throughput_deviation") + """,
           (f1_ok AND tp_ok) AS passed,
           concat_ws('; ', CASE WHEN NOT f1_ok THEN 'f1 below minimum' END,
                           CASE WHEN NOT tp_ok THEN 'throughput deviation above maximum' END) AS reasons
    FROM (SELECT *, f1_score IS NULL OR f1_score >= 0.6 AS f1_ok,
                 NOT cmp OR dev <= 0.2 AS tp_ok
          FROM (SELECT *, CASE WHEN cmp THEN abs(tput - prev) / prev END AS dev
                FROM (SELECT *, prev IS NOT NULL AND prev > 0 AND NOT isinf(prev) AS cmp
                      FROM (SELECT *, lag(tput) OVER (PARTITION BY building_id ORDER BY event_date) AS prev
                            FROM runs) a) b) c) d""", extra=[LABELS_VIEW] + LABEL_CTE + [
    ("rsd", "SELECT apartment_id, building_id, CAST(event_date AS DATE) AS event_date, score FROM rs"),
    ("rthr", "SELECT building_id, event_date, quantile_cont(score, 0.95) AS thr FROM rsd GROUP BY 1, 2"),
    ("rmet", """SELECT building_id, event_date,
                CASE WHEN 2 * tp + fp + fn = 0 THEN 0.0 ELSE 2 * tp / (2 * tp + fp + fn) END AS f1_score
                FROM (SELECT s.building_id, s.event_date,
                        CAST(count(*) FILTER (WHERE s.score > t.thr AND coalesce(l.is_anomaly, 0) = 1) AS DOUBLE) AS tp,
                        CAST(count(*) FILTER (WHERE s.score > t.thr AND coalesce(l.is_anomaly, 0) <> 1) AS DOUBLE) AS fp,
                        CAST(count(*) FILTER (WHERE NOT s.score > t.thr AND coalesce(l.is_anomaly, 0) = 1) AS DOUBLE) AS fn
                      FROM rsd s JOIN rthr t ON s.building_id = t.building_id AND s.event_date = t.event_date
                      LEFT JOIN lab l ON l.apartment_record_id = s.apartment_id AND l.event_date = s.event_date
                      GROUP BY 1, 2) c"""),
    ("rlog", """SELECT building_id, CAST(event_ts AS DATE) AS event_date, count(*) AS records,
                (epoch_us(max(event_ts)) - epoch_us(min(event_ts))) / 1e6 AS secs FROM meter GROUP BY 1, 2"""),
    ("runs", """SELECT m.building_id, m.event_date, m.f1_score,
                CASE WHEN r.records = 0 THEN 0.0 WHEN r.secs = 0 THEN CAST('inf' AS DOUBLE)
                     ELSE r.records / r.secs END AS tput
                FROM rmet m JOIN rlog r ON m.building_id = r.building_id AND m.event_date = r.event_date"""),
]))
def q_evaluation_gate(spark, sf_dir):
    s = residual_scores(spark, sf_dir).select(
        F.col("apartment_id").alias("apartment_record_id"), "building_id",
        F.to_date("event_date").alias("event_date"), F.col("score").alias("anomaly_score_combined"))
    thr = score_threshold(s, q=0.95, group_cols=RUN_KEYS)
    met = label_metrics(s, labels_for(spark, sf_dir), thr, group_cols=RUN_KEYS)
    m = tv.meter(spark, sf_dir).withColumn("event_date", F.to_date("event_ts"))
    secs = (F.unix_micros(F.max("event_ts").cast("timestamp")) - F.unix_micros(F.min("event_ts").cast("timestamp"))) / 1e6
    log = m.groupBy(*RUN_KEYS).agg(F.count(F.lit(1)).alias("records"), secs.alias("secs"))
    runs = met.join(log, RUN_KEYS).withColumn("throughput", throughput(F.col("records"), F.col("secs")))
    g = gate(runs, 0.6, 0.2, group_cols=["building_id"], order_col="event_date")
    return rounded(g.select(*RUN_KEYS, "f1_score", "throughput", "prev_throughput", "throughput_deviation",
                            "passed", "reasons"))


# ---------------------------------------------------------------- global LOF, train -> score chain, report file
@register("lof_global", model_sql(
    "SELECT z.building_id, z.apartment_id, z.event_date, " + r6("lof.lof", "lof")
    + " FROM z LEFT JOIN lof ON z.id = lof.qid",
    extra=[("zall", "SELECT * REPLACE ('all' AS building_id) FROM z")] + sql_lof_ctes("zall")))
def q_lof_global(spark, sf_dir):
    z = scaled_features(spark, sf_dir)
    return rounded(lof_scores(z, ZCOLS, "id", k=20, within=None).select(*KEYS3, "lof"))


SCORE_DATE = "2024-01-24"


@register("scores_for_date", tv.with_views(
    "SELECT apartment_id, building_id, event_date, " + r6("anomaly_score_combined", "anomaly_score_combined")
    + " FROM scores", "meter", "weather",
    extra=novelty_ctes(sql_filled("i_feat") + f" WHERE event_date = DATE '{SCORE_DATE}'",
                       pre=sql_feature_ctes("i_", "2024-01-17", SCORE_DATE))))
def q_scores_for_date(spark, sf_dir):
    """Training features -> feature store -> newest rows -> fit, save, load model ->
    scoring rows for one day as headerless CSV -> scores as CSV files -> parsed scores."""
    from ..operators.strategy import fit, load_model, save_model, score
    from ..schemas import INFER_COLUMNS
    from ..sources.features import read_features, read_inference_features, write_features, write_inference_features
    from ..sources.scores import write_scores
    meter, weather = tv.meter(spark, sf_dir), tv.weather(spark, sf_dir)
    store = staging_path(spark, "feature-store")
    end = (_dt.date.fromisoformat(SPLIT_DATE) - _dt.timedelta(days=1)).isoformat()
    write_features(training_features(meter, weather, "2024-01-01", end,
                                     event_time=F.lit(EVENT_TIME_1).cast("timestamp")), store)
    train = latest_features(read_features(spark, store)).withColumnRenamed("apartment_record_id", "apartment_id")
    train = train.withColumn("id", point_id())
    model_path = staging_path(spark, "model")
    save_model(fit("LR_LOF", train, feature_columns=FEATS, lof_neighbors=20, within="building_id", id_col="id"),
               model_path)
    model = load_model(spark, model_path)
    rows_path = staging_path(spark, "scoring-rows")
    write_inference_features(inference_features(meter, weather, SCORE_DATE), rows_path, fmt="csv")
    rows = read_inference_features(spark, rows_path, "text/csv", feature_columns=INFER_COLUMNS[3:])
    scores_path = staging_path(spark, "scores-out")
    write_scores(score(model, rows), scores_path)
    good, _bad = parse_scores(read_scores(spark, scores_path))
    return rounded(good.select("apartment_id", "building_id", F.to_date("event_date").alias("event_date"),
                               "anomaly_score_combined"))


@register("evaluation_report_json", novelty_sql(
    "SELECT " + ", ".join(r6(c, c) for c in ("score_mean", "score_stddev", "score_min", "score_max")) + ", "
    "num_records_evaluated, " + r6("thr", "threshold_used") + ", "
    + ", ".join(r6(c, c) for c in ("precision", "recall", "f1_score"))
    + ", CASE WHEN num_records_evaluated = 0 THEN 'NoData' ELSE 'Success' END AS status "
    "FROM st CROSS JOIN thr CROSS JOIN metrics",
    extra=LABEL_CTE + THR_CTE + [("metrics", SQL_METRICS), ("st", STATS_SELECT)],
    views=("meter", "weather", "labels_v")))
def q_evaluation_report_json(spark, sf_dir):
    """The evaluation report written as JSON and read back (what registration reads)."""
    from ..sources.reports import read_report, write_report
    rep = rounded(evaluate(scores_keyed(spark, sf_dir), labels_for(spark, sf_dir), q=0.95))
    path = staging_path(spark, "report")
    write_report(rep, path)
    return read_report(spark, path, rep.schema)


# ---------------------------------------------------------------- stored forms of sources

from ..sources.alerts_store import delete_from_store, upsert_alerts  # noqa: E402
from ..sources.labels import read_labels  # noqa: E402
from ..sources.meter import read_meter, read_raw_meter, write_meter  # noqa: E402


def write_raw_folders(spark, sf_dir, where="true") -> str:
    """Raw rows as JSON files, in nested folders by apartment and one file group at the top."""
    path = staging_path(spark, "raw-nested")
    raw = tv.raw(spark, sf_dir).drop("extra_raw_col").where(where)
    raw.where("building_id <> 'bldg1'").withColumn("year", F.lit(2024)).withColumn("house", F.col("building_id")) \
        .write.partitionBy("year", "house").json(path)
    raw.where("building_id = 'bldg1'").write.mode("append").json(path)
    return path


@register("raw_meter_nested", tv.with_views(SQL_CLEAN, "raw"))
def q_raw_meter_nested(spark, sf_dir):
    """JSON files at any depth, read with the fixed schema and cleaned."""
    return rounded(clean_meter(read_raw_meter(spark, write_raw_folders(spark, sf_dir))).select(*METER_OUT))


@register("incremental_ingest_runs", tv.with_views(SQL_CLEAN, "raw"))
def q_incremental_ingest_runs(spark, sf_dir):
    """Two runs over a growing folder with nested files: each file is ingested once."""
    src, dest, cp = (staging_path(spark, n) for n in ("raw-json", "meter", "meter-cp"))
    raw = tv.raw(spark, sf_dir).drop("extra_raw_col")
    first = F.col("building_id").isin("bldg0", "bldg1", "bldg2")
    raw.where(first).write.json(f"{src}/2024/01")
    ingest_incremental(spark, src, dest, cp)
    raw.where(~first).write.json(f"{src}/2024/02/late")
    raw.where("building_id is null").write.json(f"{src}/top")
    ingest_incremental(spark, src, dest, cp)
    return rounded(spark.read.schema(METER).parquet(dest).select(*METER_OUT))


@register("meter_table_range", tv.with_views(
    SQL_CLEAN + " AND try_strptime(timestamp_str, '%Y-%m-%d %H:%M:%S') >= DATE '2024-01-10'"
                " AND try_strptime(timestamp_str, '%Y-%m-%d %H:%M:%S') < DATE '2024-01-21'", "raw"))
def q_meter_table_range(spark, sf_dir):
    """The written, partitioned meter table read for whole days: only their folders are listed."""
    path = staging_path(spark, "meter-table")
    write_meter(clean_meter(tv.raw(spark, sf_dir)), path)
    return rounded(read_meter(spark, path, "2024-01-10", "2024-01-20").select(*METER_OUT))


@register("ingest_audit", tv.with_views(
    f"SELECT (SELECT count(*) FROM raw) AS rows_read, (SELECT count(*) FROM ({SQL_CLEAN}) c) AS rows_written", "raw"))
def q_ingest_audit(spark, sf_dir):
    """Counts that the ingest job observes while it writes."""
    from .jobs import ingest
    counts = ingest(spark, write_raw_folders(spark, sf_dir), staging_path(spark, "meter-audit"))
    return spark.createDataFrame([(counts["rows_read"], counts["rows_written"])], "rows_read long, rows_written long")


@register("labels_from_file", tv.with_views(
    "SELECT apartment_record_id, event_date, CAST(max(is_anomaly) AS INTEGER) AS is_anomaly FROM labels_v GROUP BY 1, 2",
    "labels_v"))
def q_labels_from_file(spark, sf_dir):
    """Labels written as Parquet, read back as the optional label table, one per key."""
    from ..operators.evaluate import dedupe_labels
    path = staging_path(spark, "labels")
    labels_for(spark, sf_dir).write.parquet(path)
    return dedupe_labels(read_labels(spark, path))


# Alerts of day 18 lack their date, as score files with an empty date field give them.
SQL_UNDATED = ("SELECT * REPLACE (CASE WHEN EventDate = '2024-01-18' THEN '' ELSE EventDate END AS EventDate, "
               "CASE WHEN EventDate = '2024-01-18' THEN ApartmentID || '#' ELSE AlertID END AS AlertID) FROM alerts")


def stored_alerts(spark, sf_dir) -> str:
    """A store after two upserts that overlap in dates, in alerts and in alerts without a date."""
    good = materialize(parsed_scores(spark, sf_dir)[0], "store-scores")
    day = F.when(F.col("event_date") == "2024-01-18", "").otherwise(F.col("event_date"))
    store = staging_path(spark, "alert-store")
    early, late = good.where("event_date <= '2024-01-20'"), good.where("event_date >= '2024-01-15'")
    # The first upsert lacks building 2: its undated alerts arrive later, into a folder that has others.
    upsert_alerts(spark, alert_rows(early.where("building_id <> 'bldg2'").withColumn("event_date", day), ALERT_TIME_1, "Seen"), store)
    upsert_alerts(spark, alert_rows(late.where("event_date <> '2024-01-18' OR building_id = 'bldg2'")
                                    .withColumn("event_date", day), ALERT_TIME_2), store)
    return store


SQL_STORED = ("""SELECT AlertID, ApartmentID, EventDate, BuildingID, AnomalyScore, Threshold, Status, SourceGroup, AlertTimestamp
    FROM (SELECT *, row_number() OVER (PARTITION BY AlertID ORDER BY AlertTimestamp DESC, AnomalyScore DESC) AS rn FROM (
            SELECT * REPLACE ('Seen' AS Status), '""" + ALERT_TIME_1 + """' AS AlertTimestamp FROM undated
            WHERE day <= '2024-01-20' AND BuildingID <> 'bldg2'
            UNION ALL
            SELECT *, '""" + ALERT_TIME_2 + """' AS AlertTimestamp FROM undated
            WHERE day >= '2024-01-15' AND (day <> '2024-01-18' OR BuildingID = 'bldg2')) u) x WHERE rn = 1""")
STORED_CTES = [("undated", SQL_UNDATED.replace("SELECT * REPLACE", "SELECT EventDate AS day, * REPLACE")), ("stored", SQL_STORED)]


def stored_out(a):
    a = a.withColumn("AnomalyScore", F.col("AnomalyScore").cast("double")).withColumn("Threshold", F.col("Threshold").cast("double"))
    return alert_out(a, ["AlertTimestamp"])


@register("alerts_store_upsert", alert_sql("SELECT * FROM stored", STORED_CTES))
def q_alerts_store_upsert(spark, sf_dir):
    return stored_out(read_alerts(spark, stored_alerts(spark, sf_dir)))


@register("alerts_store_for_date", alert_sql("SELECT * FROM stored WHERE EventDate = '2024-01-17'", STORED_CTES))
def q_alerts_store_for_date(spark, sf_dir):
    return stored_out(read_alerts(spark, stored_alerts(spark, sf_dir), "2024-01-17"))


@register("alerts_store_delete", alert_sql(
    "SELECT * FROM stored WHERE BuildingID <> 'bldg3' AND EventDate <> '2024-01-17'", STORED_CTES))
def q_alerts_store_delete(spark, sf_dir):
    """One building's alerts go, and all of one date, whose folder is emptied."""
    store = stored_alerts(spark, sf_dir)
    keys = read_alerts(spark, store).where("BuildingID = 'bldg3' OR EventDate = '2024-01-17'").select("AlertID")
    delete_from_store(spark, store, materialize(keys, "delete-keys"))
    return stored_out(read_alerts(spark, store))


@register("stream_alert_counts", alert_sql(
    f"""SELECT file_group AS source_group, count(*) FILTER (WHERE ok) AS rows_parsed,
               count(*) FILTER (WHERE NOT ok) AS rows_rejected,
               count(*) FILTER (WHERE ok AND TRY_CAST(f[4] AS DOUBLE) > {THRESHOLD}) AS alerts_generated
        FROM okrows GROUP BY file_group"""))
def q_stream_alert_counts(spark, sf_dir):
    """Per-file counts that the stream writes beside the alerts, rejects included."""
    scores = write_score_files(spark, sf_dir)
    store, cp, rejects, counts = (staging_path(spark, n) for n in ("alert-store", "alert-cp", "rejects", "counts"))
    stream_alerts(spark, scores, store, cp, THRESHOLD, ALERT_TIME_1, rejects_path=rejects, counts_path=counts)
    c = spark.read.parquet(counts).withColumn("source_group", source_group("source_file"))
    return c.groupBy("source_group").agg(*[F.sum(n).alias(n) for n in ("rows_parsed", "rows_rejected", "alerts_generated")])


# ---------------------------------------------------------------- fault isolation, replayable batches, run-wide audit
from ..operators.lof import lof_scores_approximate  # noqa: E402
from ..sources import daily_table, feature_log, meter_batches, quarantine  # noqa: E402
from . import incremental  # noqa: E402
from ..streaming.ingest_stream import ingest_batches, read_audit  # noqa: E402


def copy_file(spark, src: str, dst: str, first_bytes: int | None = None) -> None:
    """Copy a file within the store, whole or its first few bytes only."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    a, b = jvm.org.apache.hadoop.fs.Path(src), jvm.org.apache.hadoop.fs.Path(dst)
    fs = a.getFileSystem(conf)
    if first_bytes is None:
        jvm.org.apache.hadoop.fs.FileUtil.copy(fs, a, fs, b, False, True, conf)
        return
    stream, out = fs.open(a), fs.create(b, True)
    out.write(jvm.org.apache.commons.io.IOUtils.toByteArray(stream, first_bytes))
    out.close()
    stream.close()


@register("stream_alerts_quarantine", alert_sql(
    f"""SELECT *, CASE WHEN SourceGroup = 'bldg3' THEN '{ALERT_TIME_2}' ELSE '{ALERT_TIME_1}' END AS AlertTimestamp,
               CASE WHEN SourceGroup = 'bldg3' THEN 'recovered' ELSE 'read' END AS file_status,
               CAST(CASE WHEN SourceGroup = 'bldg3' THEN 2 ELSE 0 END AS BIGINT) AS file_tries FROM alerts"""))
def q_stream_alerts_quarantine(spark, sf_dir):
    """One building's compressed score files are cut short in the first run: the others' alerts are written. The second
    run finds them repaired."""
    lines = materialize(score_lines(residual_scores(spark, sf_dir)), "score-lines")
    scores, whole, store, cp, apart = (staging_path(spark, n) for n in ("scores", "scores-gz", "alert-store", "alert-cp", "quarantine"))
    lines.where("file_group <> 'bldg3'").write.partitionBy("file_group").option("sep", "\t").option("header", "false").csv(scores)
    lines.where("file_group = 'bldg3'").select("line").coalesce(2).write.option("compression", "gzip").text(whole)
    files = spark.read.text(whole).inputFiles()                 # two
    targets = [f"{scores}/file_group=bldg3/{i}.csv.gz" for i in range(len(files))]
    for src, dst in zip(files, targets):
        copy_file(spark, src, dst, first_bytes=12)
    run = {"suffixes": ("csv", "csv.gz"), "quarantine_path": apart}
    stream_alerts(spark, scores, store, cp, THRESHOLD, ALERT_TIME_1, **run)
    for src, dst in zip(files, targets):
        copy_file(spark, src, dst)
    stream_alerts(spark, scores, store, cp, THRESHOLD, ALERT_TIME_2, **run)
    noted = quarantine.entries(spark, apart).withColumn("SourceGroup", source_group("source_file")) \
        .groupBy("SourceGroup").agg(F.max("status").alias("file_status"), F.max("tries").alias("file_tries"))
    out = stored_out(read_alerts(spark, store)).join(noted, "SourceGroup", "left")
    return out.withColumn("file_status", F.coalesce("file_status", F.lit("read"))) \
        .withColumn("file_tries", F.coalesce("file_tries", F.lit(0).cast("long")))


@register("stream_ingest_audit", tv.with_views(
    "SELECT run, (SELECT count(*) FROM raw WHERE building_id IN ('bldg0', 'bldg1', 'bldg2') = (run = 'first')) AS rows_read, "
    f"(SELECT count(*) FROM ({SQL_CLEAN}) c WHERE building_id IN ('bldg0', 'bldg1', 'bldg2') = (run = 'first')) AS rows_written "
    "FROM (VALUES ('first'), ('second')) r(run)", "raw"))
def q_stream_ingest_audit(spark, sf_dir):
    """Rows read and written by two runs of many micro-batches each, one file at a time."""
    src, dest, cp, audit = (staging_path(spark, n) for n in ("raw-json", "meter", "meter-cp", "audit"))
    raw = tv.raw(spark, sf_dir).drop("extra_raw_col")
    first = F.col("building_id").isin("bldg0", "bldg1", "bldg2")
    names = {}
    for name, rows in (("first", raw.where(first)), ("second", raw.where(~first))):
        rows.repartition(3).write.json(f"{src}/{name}")
        names[ingest_batches(spark, src, dest, cp, audit, max_files_per_trigger=1)["run"]] = name
    run = F.coalesce(*[F.when(F.col("run") == k, F.lit(v)) for k, v in names.items()])
    return read_audit(spark, audit).groupBy(run.alias("run")).agg(F.sum("rows_read").alias("rows_read"), F.sum("rows_written").alias("rows_written"))


@register("meter_batch_replay", tv.with_views(
    SQL_CLEAN + " AND try_strptime(timestamp_str, '%Y-%m-%d %H:%M:%S') >= DATE '2024-01-10'"
                " AND try_strptime(timestamp_str, '%Y-%m-%d %H:%M:%S') < DATE '2024-01-21'", "raw"))
def q_meter_batch_replay(spark, sf_dir):
    """Three batches, one of them first with wrong rows; compacted, then two written again: one copy of each."""
    path = staging_path(spark, "meter-batches")
    clean = materialize(clean_meter(tv.raw(spark, sf_dir)), "meter-clean")
    part = F.coalesce(F.substring("building_id", 5, 9).cast("int"), F.lit(0)) % 3
    for batch, rows in (("0", clean.where(part == 0)), ("1", clean.where(part != 1)), ("2", clean.where(part == 2))):
        meter_batches.write_batch(spark, rows, path, batch)
    meter_batches.compact(spark, path)
    for batch in (1, 2):
        meter_batches.write_batch(spark, clean.where(part == batch), path, str(batch))
    return rounded(meter_batches.read_batches(spark, path, "2024-01-10", "2024-01-20").select(*METER_OUT))


@register("latest_features_incremental", ORACLE_SQL["latest_features"])
def q_latest_features_incremental(spark, sf_dir):
    """Two runs as deltas of the feature log: the first compacted, the second partly, the rest merged on reading."""
    path = staging_path(spark, "feature-log")
    run1 = _train_feats(spark, sf_dir, "2024-01-01", "2024-01-20", event_time=EVENT_TIME_1)
    run2 = _train_feats(spark, sf_dir, "2024-01-15", "2024-01-31", event_time=EVENT_TIME_2)
    feature_log.append_features(spark, run1, path, "first")
    feature_log.compact(spark, path)
    feature_log.append_features(spark, run2, path, "second")
    feature_log.compact(spark, path, [f"2024-01-{d}" for d in range(16, 25)])
    out = feature_log.latest(spark, path)
    return rounded(out.withColumn("event_time", F.date_format("event_time", "yyyy-MM-dd HH:mm:ss")))


@register("late_readings_features", tv.with_views(f"SELECT {FEATURE_OUT_SQL} FROM feat", "meter", "weather", extra=FEATURE_CTES))
def q_late_readings_features(spark, sf_dir):
    """Features kept up to date through three batches, two of them late (whole days of a building, and a quarter of one day's
    readings), one sent twice, with a compaction in between: equal to a full rebuild."""
    state, feats = staging_path(spark, "daily-state"), staging_path(spark, "feature-log")
    meter, weather = materialize(tv.meter(spark, sf_dir), "meter"), tv.weather(spark, sf_dir)
    day = F.dayofmonth("event_ts")
    batch = F.when((F.col("building_id") == "bldg1") & day.isin(5, 12), 1) \
        .when((day == 20) & (F.pmod(F.xxhash64("meter_id", "event_ts"), F.lit(4)) == 0), 2).otherwise(0)
    for i, n in enumerate((0, 1, 2, 2)):
        incremental.update_features(spark, meter.where(batch == n), weather, state, feats, f"batch-{n}",
                                    F.lit(f"2024-02-0{i + 1} 00:00:00").cast("timestamp"))
        if i == 1:
            incremental.compact_state(spark, state)
            feature_log.compact(spark, feats)
    return rounded(feature_log.latest(spark, feats).drop("event_time"))


@register("bucketed_windows", ORACLE_SQL["features_daily"])
def q_bucketed_windows(spark, sf_dir):
    """Daily rows stored in buckets by series; lags and rolling means read them without an exchange."""
    path = staging_path(spark, "daily-buckets")
    table = "daily_" + path.rsplit("-", 1)[-1]
    daily = join_weather(daily_consumption(tv.meter(spark, sf_dir)), prepare_weather(tv.weather(spark, sf_dir)))
    daily_table.write_daily(daily, table, path, buckets=16)
    out = rounded(add_lag_rolling(daily_table.read_daily(spark, table)).select(*DAILY_FEATURE_COLUMNS))
    spark.sql(f"DROP TABLE {table}")        # its name only: the files are the staged table's
    return out


@register("lof_global_approx")
def q_lof_global_approx(spark, sf_dir):
    """LOF of all rows on neighbours found by random-projection hash tables (no SQL: its recall is tested)."""
    z = scaled_features(spark, sf_dir)
    return rounded(lof_scores_approximate(z, ZCOLS, "id", k=20).select(*KEYS3, "lof"))


# ---------------------------------------------------------------- one model over all rows; rows without a score
@register("lof_novelty_global", novelty_sql(
    "SELECT zq.building_id, zq.apartment_id, zq.event_date, " + r6("gqlof.lof", "lof")
    + " FROM zq LEFT JOIN gqlof ON zq.id = gqlof.qid",
    extra=[("zrall", "SELECT * REPLACE ('all' AS building_id) FROM zr"), ("zqall", "SELECT * REPLACE ('all' AS building_id) FROM zq")]
    + sql_lof_ctes("zrall", prefix="g_") + sql_novelty_ctes("zqall", "g_", "gq")))
def q_lof_novelty_global(spark, sf_dir):
    """New rows against one model fitted on all rows."""
    zr, zq, _ = split_sets(spark, sf_dir)
    model = fit_lof(zr, ZCOLS, "id", k=20)
    return rounded(lof_novelty(model, zq, ZCOLS, "id").select(*KEYS3, "lof"))


@register("label_metrics_unscored", novelty_sql(
    "SELECT " + ", ".join(r6(c, c) for c in ("precision", "recall", "f1_score")) + " FROM metrics",
    extra=LABEL_CTE + [("partly", "SELECT * REPLACE (CASE WHEN building_id = 'bldg4' THEN NULL ELSE anomaly_score_combined END "
                                  "AS anomaly_score_combined) FROM scores")]
    + [(n, s.replace("FROM scores", "FROM partly")) for n, s in THR_CTE]
    + [("metrics", SQL_METRICS.replace("scores s", "partly s").replace(
        "s.anomaly_score_combined > t.thr AS pred", "coalesce(s.anomaly_score_combined > t.thr, false) AS pred"))],
    views=("meter", "weather", "labels_v")))
def q_label_metrics_unscored(spark, sf_dir):
    """One building's rows have no score: its labelled anomalies are misses."""
    s = scores_keyed(spark, sf_dir).withColumn(
        "anomaly_score_combined", F.when(F.col("building_id") != "bldg4", F.col("anomaly_score_combined")))
    s = materialize(s, "scores")
    return rounded(label_metrics(s, labels_for(spark, sf_dir), score_threshold(s, q=0.95)))


# ---------------------------------------------------------------- model metadata as string maps
from ..functions.maps import model_properties, text_map  # noqa: E402

PARAMS = {"lof_neighbors": "20", "lof_contamination": "auto"}


@register("model_properties", alert_sql(
    "SELECT building_id, unnest(map_entries(m)).key AS name, unnest(map_entries(m)).value AS value FROM (SELECT building_id, MAP {"
    "'CommitId': 'none', " + ", ".join(f"'Hyperparameter_{k}': '{v}'" for k, v in PARAMS.items())
    + ", 'Evaluation_num_records_evaluated': CAST(count(score) AS VARCHAR), "
    "'Evaluation_score_max': CAST(CAST(round(max(score), 3) AS DECIMAL(18, 3)) AS VARCHAR), "
    "'Evaluation_status': 'Success'} AS m FROM rs GROUP BY building_id) t"))
def q_model_properties(spark, sf_dir):
    """Parameters and evaluation of one model per building as prefixed string maps, through JSON text and back."""
    s = residual_scores(spark, sf_dir).select("building_id", F.col("score").alias("anomaly_score_combined"))
    stats = score_stats(s, group_cols=["building_id"])
    metrics = text_map({"num_records_evaluated": F.col("num_records_evaluated"), "status": F.lit("Success"), "f1_score": F.lit(None),
                        "score_max": F.round("score_max", 3).cast("decimal(18,3)")})
    props = model_properties(text_map({k: F.lit(v) for k, v in PARAMS.items()}), metrics, CommitId="none")
    back = F.from_json(F.to_json(props), "map<string,string>")
    return stats.select("building_id", F.explode(back).alias("name", "value"))
