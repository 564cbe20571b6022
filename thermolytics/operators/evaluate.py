"""Score evaluation: distribution statistics, label metrics, throughput, gate."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import safe_ratio
from ..functions.params import attach_row
from .quantile import approx_quantile, exact_quantile
from ..session import materialize

LABEL_KEYS = ["apartment_record_id", "event_date"]


def score_stats(scores: DataFrame, score_col: str = "anomaly_score_combined", group_cols=()) -> DataFrame:
    """mean, sample stddev, min, max, count of the score (one partial aggregate)."""
    s = F.col(score_col).cast("double")
    return scores.groupBy(*group_cols).agg(
        F.avg(s).alias("score_mean"), F.stddev_samp(s).alias("score_stddev"),
        F.min(s).alias("score_min"), F.max(s).alias("score_max"),
        F.count(s).alias("num_records_evaluated"))


def score_threshold(scores: DataFrame, score_col: str = "anomaly_score_combined", q: float = 0.95,
                    group_cols=(), exact: bool = True) -> DataFrame:
    """The q-quantile of the score, computed before any label join."""
    f = exact_quantile if exact else approx_quantile
    return f(scores, score_col, q, group_cols, alias="threshold_used")


def dedupe_labels(labels: DataFrame, keys=LABEL_KEYS) -> DataFrame:
    """One label per key (max) so the join cannot multiply score rows."""
    return labels.groupBy(*keys).agg(F.max(F.col("is_anomaly").cast("int")).alias("is_anomaly"))


def label_metrics(scores: DataFrame, labels: DataFrame, threshold: DataFrame,
                  score_col: str = "anomaly_score_combined", keys=LABEL_KEYS, group_cols=()) -> DataFrame:
    """precision, recall, F1 of ``score > threshold`` against labels.

    Unlabelled rows count as normal; a row without a score (null or NaN) is predicted normal, so a
    labelled anomaly that could not be scored is a miss. A zero denominator gives 0. With an empty
    label table there is nothing to measure: the metrics are null.
    """
    g = list(group_cols)
    j = scores.join(dedupe_labels(labels, keys), keys, "left")
    j = j.join(threshold, g, "left") if g else attach_row(j, threshold)
    actual = F.coalesce(F.col("is_anomaly"), F.lit(0)) == 1
    s = F.col(score_col).cast("double")
    pred = F.coalesce((s > F.col("threshold_used")) & ~F.isnan(s), F.lit(False))
    c = j.groupBy(*g).agg(
        F.count_if(pred & actual).alias("tp"), F.count_if(pred & ~actual).alias("fp"),
        F.count_if(~pred & actual).alias("fn"))
    p = safe_ratio(F.col("tp"), F.col("tp") + F.col("fp"))
    r = safe_ratio(F.col("tp"), F.col("tp") + F.col("fn"))
    f1 = safe_ratio(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn"))
    c = attach_row(c, labels.agg(F.count(F.lit(1)).alias("_labels")))
    known = [F.when(F.col("_labels") > 0, m).alias(n) for m, n in ((p, "precision"), (r, "recall"), (f1, "f1_score"))]
    return c.select(*g, *known)


def evaluate(scores: DataFrame, labels: DataFrame | None = None, score_col: str = "anomaly_score_combined",
             q: float = 0.95, group_cols=(), exact: bool = True) -> DataFrame:
    """Evaluation report, one row (per group): stats, threshold, label metrics, status.

    status = NoData when there are no scores, else Success. Without labels, or
    with an empty label table, the label metrics are null.
    """
    g = list(group_cols)
    # Scores feed three aggregates; write them once instead of recomputing the scoring three times.
    scores = materialize(scores, "eval-scores")
    stats = score_stats(scores, score_col, g)
    thr = score_threshold(scores, score_col, q, g, exact)
    # Without groups every part is a global aggregate: exactly one row, also on empty input.
    rep = stats.join(thr, g, "left") if g else attach_row(stats, thr)
    if labels is not None:
        m = label_metrics(scores, labels, thr, score_col, group_cols=g)
        rep = rep.join(m, g, "left") if g else attach_row(rep, m)
    else:
        rep = rep.select("*", *[F.lit(None).cast("double").alias(c) for c in ("precision", "recall", "f1_score")])
    status = F.when(F.col("num_records_evaluated") == 0, F.lit("NoData")).otherwise(F.lit("Success"))
    return rep.withColumn("status", status)


def throughput(records, seconds):
    """records / seconds; 0 records -> 0.0; 0 seconds -> +inf (Columns or numbers)."""
    if not hasattr(records, "alias") and not hasattr(seconds, "alias"):
        if records == 0:
            return 0.0
        if seconds == 0:
            return float("inf")
        return records / seconds
    r, s = F.lit(records) if not hasattr(records, "alias") else records, \
        F.lit(seconds) if not hasattr(seconds, "alias") else seconds
    return (F.when(r == 0, F.lit(0.0))
            .when(s == 0, F.lit(float("inf")))
            .otherwise(r.cast("double") / s.cast("double")))


def gate(reports: DataFrame, min_f1: float = 0.6, max_throughput_deviation: float = 0.2,
         group_cols=("model_group",), order_col: str = "run_id", throughput_col: str = "throughput") -> DataFrame:
    """Pass/fail per run: F1 at least ``min_f1`` (skipped when null) and a
    throughput within ``max_throughput_deviation`` (relative) of the previous
    run of the same group. The throughput test is skipped for the first run
    and when the previous throughput is 0 or infinite (no finite reference).
    """
    w = Window.partitionBy(*group_cols).orderBy(order_col)
    out = reports.withColumn("prev_throughput", F.lag(throughput_col, 1).over(w))
    prev, cur = F.col("prev_throughput"), F.col(throughput_col)
    inf = F.lit(float("inf"))
    comparable = prev.isNotNull() & (prev > 0) & (prev != inf)
    dev = F.when(comparable, F.abs(cur - prev) / prev)
    f1_ok = F.col("f1_score").isNull() | (F.col("f1_score") >= F.lit(min_f1))
    tp_ok = ~comparable | (dev <= F.lit(max_throughput_deviation))
    reasons = F.concat_ws("; ",
                          F.when(~f1_ok, F.lit("f1 below minimum")),
                          F.when(~tp_ok, F.lit("throughput deviation above maximum")))
    return (out.withColumn("throughput_deviation", dev)
            .withColumn("passed", f1_ok & tp_ok).withColumn("reasons", reasons))
