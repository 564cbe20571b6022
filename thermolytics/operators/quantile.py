"""Exact quantiles by selection, without sorting or gathering all values.

``percentile`` keeps every value of a group in one aggregation buffer, which does not scale for a global (or a
hot) group. Here a sketch of each group gives two values between which the wanted ranks lie; one more pass
counts what lies below and keeps the values between, equal ones as one with a count. With
``ACCURACY`` that is some ten-thousandth of a group. While more than ``LIMIT`` different values are left, they are
cut into intervals by sketched values, the intervals are counted, and only those that hold the wanted ranks stay.
Everything moved is a partial sum; all rows are read twice and never exchanged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.joins import same_keys
from ..functions.params import attach_row
from ..session import materialize

ACCURACY = 10_000       # of the sketch: a rank is off by at most this part of the rows
LIMIT = 100_000         # different values that a group is ranked by in the end
PIVOTS = 63
BROADCAST_ROWS = 1_000_000


def _bounds(base: DataFrame, g: list, qs: list) -> tuple[DataFrame, int]:
    """(G..., _q, _first, _last, _share, _low, _high, _few) per group and wanted quantile: the two ranks, counted from 0, the
    weight of the second, and values round them."""
    slack = 3 / ACCURACY
    probs = [p for q in qs for p in (max(0.0, q - slack), min(1.0, q + slack))]
    st = base.groupBy(*g).agg(F.count(F.lit(1)).alias("_n"), F.percentile_approx("_v", probs, ACCURACY).alias("_p")).where("_n > 0")
    each = F.explode(F.array(*[F.struct(F.lit(i).alias("_q"), F.lit(float(q)).alias("_share"), F.get("_p", F.lit(2 * i)).alias("_low"),
                                        F.get("_p", F.lit(2 * i + 1)).alias("_high")) for i, q in enumerate(qs)]))
    at = F.col("_share") * (F.col("_n") - 1)
    few = F.col("_n") <= LIMIT
    rows = st.select(*g, "_n", each.alias("_e")).select(*g, "_n", "_e.*").select(
        *g, "_q", F.floor(at).alias("_first"), F.ceil(at).alias("_last"), (at - F.floor(at)).alias("_share"),
        # NaN is the largest value in Spark's order.
        F.when(few, F.lit(float("-inf"))).otherwise(F.col("_low")).alias("_low"),
        F.when(few, F.lit(float("nan"))).otherwise(F.col("_high")).alias("_high"), few.alias("_few"))
    return materialize(rows, "quantile-bounds", count=True)


def _between(base: DataFrame, bounds: DataFrame, n: int, g: list) -> DataFrame:
    """(G..., _q, _v, _c): the different values from _low to _high with their counts; _v is null for all that lie below."""
    ends = bounds.select(*g, "_q", "_low", "_high")
    if g:
        both = same_keys(base, F.broadcast(ends) if n <= BROADCAST_ROWS else ends, g)
    else:       # one entry per wanted quantile
        one = ends.agg(F.collect_list(F.struct("_q", "_low", "_high")).alias("_ends"))
        both = attach_row(base, one).select("_v", F.explode("_ends").alias("_e")).select("_v", "_e.*")
    kept = both.where(F.col("_v") <= F.col("_high")).select(*g, "_q", F.when(F.col("_v") >= F.col("_low"), F.col("_v")).alias("_v"))
    return materialize(kept.groupBy(*g, "_q", "_v").agg(F.count(F.lit(1)).alias("_c")), "quantile-values")


def _refined(held: DataFrame, bounds: DataFrame, g: list) -> DataFrame:
    """``held`` with the intervals that cannot hold the wanted ranks taken out, for groups with too many values."""
    key = [*g, "_q"]
    probs = [i / (PIVOTS + 1) for i in range(1, PIVOTS + 1)]
    pivots = held.groupBy(*key).agg(F.count("_v").alias("_d"), F.percentile_approx("_v", probs, 1000).alias("_p"))
    pivots = pivots.withColumn("_p", F.when(F.col("_d") > LIMIT, F.col("_p")).otherwise(F.array().cast("array<double>"))).drop("_d")
    place = F.when(F.col("_v").isNull(), -1).otherwise(F.size(F.filter("_p", lambda p: p <= F.col("_v"))))
    placed = same_keys(held, pivots, key).withColumn("_i", place).drop("_p")
    upto = Window.partitionBy(*key).orderBy("_i")               # at most PIVOTS + 2 rows
    sums = placed.groupBy(*key, "_i").agg(F.sum("_c").alias("_c")).withColumn("_upto", F.sum("_c").over(upto))
    sums = same_keys(sums, bounds.select(*key, "_first", "_last"), key)
    wanted = sums.where((F.col("_i") >= 0) & (F.col("_upto") > F.col("_first")) & (F.col("_upto") - F.col("_c") <= F.col("_last")))
    below = wanted.groupBy(*key).agg(F.min(F.col("_upto") - F.col("_c")).alias("_c")) \
        .select(*key, F.lit(None).cast("double").alias("_v"), "_c")
    inside = same_keys(placed, wanted.select(*key, "_i"), [*key, "_i"], "left_semi").select(*key, "_v", "_c")
    return materialize(inside.unionByName(below), "quantile-refined")


def exact_quantiles(df: DataFrame, value_col: str, qs, group_cols=(), alias: str = "quantile") -> DataFrame:
    """(G..., q, alias): several linear-interpolated quantiles per group (pandas / ``quantile_cont`` semantics).

    position = q * (n - 1); result = v[floor] + (v[ceil] - v[floor]) * frac. Null values do not count; NaN is the
    largest. Without groups a table without values gives one null per quantile, with groups no rows.
    """
    g, qs = list(group_cols), [float(q) for q in qs]
    if not qs or not all(0.0 <= q <= 1.0 for q in qs):
        raise ValueError("q must be within [0, 1]")
    key = [*g, "_q"]
    base = materialize(df.select(*g, F.col(value_col).cast("double").alias("_v")).where(F.col("_v").isNotNull()), "quantile-input")
    bounds, n = _bounds(base, g, qs)
    held = _between(base, bounds, n, g)

    def state(held):
        """(quantiles whose ranks lie outside of their bounds, most values of one)"""
        sums = held.groupBy(*key).agg(F.sum(F.when(F.col("_v").isNull(), F.col("_c")).otherwise(0)).alias("_below"),
                                      F.sum("_c").alias("_upto"), F.count("_v").alias("_d"))
        missed = (F.col("_below") > F.col("_first")) | (F.col("_upto") <= F.col("_last"))
        got = same_keys(bounds.select(*key, "_first", "_last"), sums, key, "left")
        return got.agg(F.count_if(F.coalesce(missed, F.lit(True))), F.max("_d")).first()

    # Groups of few rows are held whole.
    missed, most = (0, 0) if bounds.where("not _few").isEmpty() else state(held)
    if missed:          # a sketch beyond its stated error: take all values
        bounds, n = materialize(bounds.withColumn("_low", F.lit(float("-inf"))).withColumn("_high", F.lit(float("nan"))),
                                "quantile-bounds", count=True)
        held = _between(base, bounds, n, g)
        _, most = state(held)
    while (most or 0) > LIMIT:
        held = _refined(held, bounds, g)
        _, most = state(held)
    upto = Window.partitionBy(*key).orderBy(F.col("_v").asc_nulls_first())      # at most LIMIT rows
    ranked = same_keys(held.withColumn("_upto", F.sum("_c").over(upto)), bounds.select(*key, "_first", "_last", "_share"), key) \
        .where("_v is not null")
    ends = ranked.groupBy(*key).agg(F.min(F.when(F.col("_upto") > F.col("_first"), F.col("_v"))).alias("_lo"),
                                    F.min(F.when(F.col("_upto") > F.col("_last"), F.col("_v"))).alias("_hi"),
                                    F.first("_share").alias("_share"))
    value = F.col("_lo") + (F.col("_hi") - F.col("_lo")) * F.col("_share")
    q = F.get(F.array(*[F.lit(x) for x in qs]), F.col("_q"))
    out = ends.select(*g, q.alias("q"), value.alias(alias))
    if g:
        return out
    wanted = df.sparkSession.range(len(qs)).select(F.get(F.array(*[F.lit(x) for x in qs]), F.col("id").cast("int")).alias("q"))
    return wanted.join(out, "q", "left")


def exact_quantile(df: DataFrame, value_col: str, q: float, group_cols=(), alias: str = "quantile") -> DataFrame:
    """(G..., alias): one quantile as ``exact_quantiles`` gives it; without groups exactly one row."""
    if not 0.0 <= q <= 1.0:
        raise ValueError("q must be within [0, 1]")
    out = exact_quantiles(df, value_col, [q], group_cols, alias).drop("q")
    return out if list(group_cols) else out.agg(F.max(alias).alias(alias))


def approx_quantile(df: DataFrame, value_col: str, q: float, group_cols=(), alias: str = "quantile",
                    accuracy: int = 10000) -> DataFrame:
    """Bounded-memory sketch (no interpolation); the option for very large groups."""
    g = list(group_cols)
    return df.groupBy(*g).agg(F.percentile_approx(F.col(value_col).cast("double"), q, accuracy).alias(alias))
