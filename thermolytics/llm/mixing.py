"""Mixing sources to target weights by hash-threshold histograms (DataFrame functions only).

Each document gets a 36-bit hash of its id and text. Sizes are summed by source and hash bucket
(the first 12 bits). A running sum over the buckets finds, for each budget, the bucket in which
that budget is used up; only this boundary bucket is summed again by the next 12 bits, and then
the next. The result is one threshold per source and epoch, so the sample is a filter
``hash < threshold``: no document is sorted, and reruns agree. Thresholds of later epochs
nest in those of earlier ones: with a target between one and two times the source's size every
document is taken once, and those below the second threshold twice.

Cases: null text has size 0. The null source is a source of its own, ordered last. Equal rows
have equal hashes, so they are taken alike. Sources of size 0 get target 0. An empty table gives
an empty result. Columns other than doc_id, text and source are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import materialize
from .common import WORD, free_name, row_key

WEIGHTS = (3.0, 1.0, 2.0)   # by rank of the source, repeating
SHARE = 1.5                 # of all sizes
EPOCHS = 2                  # most times a document is taken
DIGITS = 3                  # hexadecimal digits of the hash per level: 4,096 buckets
LEVELS = 3


def doc_size(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def doc_hash(doc_id: str = "doc_id", text: str = "text") -> Column:
    """First 36 bits of MD5 over id and text, as hexadecimal text."""
    key = F.concat(F.coalesce(F.col(doc_id).cast("string"), F.lit("")), F.lit(":"),
                   F.coalesce(F.col(text), F.lit("")))
    return F.substring(F.md5(key), 1, DIGITS * LEVELS)


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, epochs: float = EPOCHS) -> DataFrame:
    """(source, source_size, target) from (source, source_size), one row per source.

    Water filling: targets are min(cap, weight * level) with the level at which they add up to
    ``share`` of all sizes. With sources ordered by cap / weight, the first i are capped where
    the level left for the others is still above their ratio.
    """
    ranked = sizes.withColumn("_i", F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1)
    picks = F.array(*[F.lit(float(w)) for w in weights])
    ranked = ranked.withColumn("_w", F.element_at(picks, (F.col("_i") % len(weights) + 1).cast("int"))) \
                   .withColumn("_cap", F.col("source_size") * float(epochs)) \
                   .withColumn("_ratio", F.col("_cap") / F.col("_w"))
    upto = W.orderBy("_ratio", "_i").rowsBetween(W.unboundedPreceding, -1)
    everything = W.orderBy("_ratio", "_i").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    goal = F.lit(float(share)) * F.sum("source_size").over(everything)
    level = (goal - F.coalesce(F.sum("_cap").over(upto), F.lit(0.0))) \
        / (F.sum("_w").over(everything) - F.coalesce(F.sum("_w").over(upto), F.lit(0.0)))
    filled = ranked.withColumn("_level", level)
    # The level of the first source that it does not cap; where all are capped, none.
    final = F.min(F.when(F.col("_level") <= F.col("_ratio"), F.struct("_ratio", "_i", "_level"))).over(everything)
    return filled.withColumn("_final", final["_level"]) \
        .select("source", "source_size",
                F.coalesce(F.least(F.col("_cap"), F.col("_w") * F.col("_final")), F.col("_cap")).alias("target"))


def _null_safe(a: DataFrame, b: DataFrame, on: list[str]) -> DataFrame:
    """Inner join with null keys equal; the right side's copies of the keys go."""
    r = b.select(*[F.col(c).alias(f"_r_{c}") for c in on], *[c for c in b.columns if c not in on])
    cond = [F.col(c).eqNullSafe(F.col(f"_r_{c}")) for c in on]
    return a.join(r, cond).drop(*[f"_r_{c}" for c in on])


def thresholds(sized: DataFrame, budgets: DataFrame) -> DataFrame:
    """(source, epoch, threshold) so that the sizes of hashes below the threshold come nearest to the budget.

    ``sized`` has source, size, hash; ``budgets`` has source, epoch, budget. A threshold is a
    hexadecimal prefix, compared as text; documents with ``hash < threshold`` are taken.
    """
    spark = sized.sparkSession
    state = budgets.select("source", "epoch", F.col("budget").cast("double").alias("left"), F.lit("").alias("prefix"))
    for level in range(1, LEVELS + 1):
        width = DIGITS * level
        hashed = sized.withColumn("bucket", F.substring("hash", 1, width))
        if level > 1:
            edge = state.select("source", "prefix").distinct()
            hashed = hashed.withColumn("prefix", F.substring("hash", 1, width - DIGITS))
            hashed = _null_safe(hashed, edge, ["source", "prefix"])
        else:
            hashed = hashed.withColumn("prefix", F.lit(""))
        hist = hashed.groupBy("source", "prefix", "bucket").agg(F.sum("size").alias("n"))
        below = W.partitionBy("source", "prefix").orderBy("bucket")      # at most 4,096 rows
        hist = hist.withColumn("upto", F.sum("n").over(below)).withColumn("before", F.col("upto") - F.col("n"))
        joined = _null_safe(state, hist, ["source", "prefix"])
        # The bucket in which the budget is used up: the last whose start is within it.
        cut = joined.where(F.col("before") <= F.col("left")) \
            .groupBy("source", "epoch").agg(F.max("bucket").alias("bucket"),
                                            F.max("before").alias("before"), F.max("upto").alias("upto"),
                                            F.first("left").alias("left"))
        last = level == LEVELS
        # At the last level the boundary bucket goes in if that comes nearer to the budget.
        take = F.col("upto") - F.col("left") < F.col("left") - F.col("before")
        state = cut.select("source", "epoch", (F.col("left") - F.col("before")).alias("left"),
                           (F.when(take, F.concat("bucket", F.lit("~"))).otherwise(F.col("bucket"))
                            if last else F.col("bucket")).alias("prefix"))
        state = materialize(state, f"mix-level{level}")
    return state.select("source", "epoch", F.col("prefix").alias("threshold"))


def mix(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, epochs: int = EPOCHS,
        key: bool = False) -> DataFrame:
    """Per document: doc_id, source, size, source_size, target, taken (times the mix takes it, by its size).

    With ``key`` also the row's ``key`` (``row_key``).
    """
    ids = ["doc_id", *["key"][:key]]
    rows = docs.select("doc_id", "source", "text", *[row_key().alias("key")][:key])
    sized = materialize(rows.select(*ids, "source", doc_size().alias("size"), doc_hash().alias("hash")), "mix-sizes")
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = materialize(source_targets(sizes, weights, share, epochs), "mix-targets")
    budgets = targets.select("source", F.explode(F.sequence(F.lit(1), F.lit(int(epochs)))).alias("epoch"),
                             "source_size", "target") \
        .withColumn("budget", F.least(F.greatest(F.col("target") - (F.col("epoch") - 1) * F.col("source_size"),
                                                 F.lit(0.0)), F.col("source_size").cast("double")))
    cuts = thresholds(sized, budgets.select("source", "epoch", "budget"))
    wide = cuts.groupBy("source").agg(F.collect_list("threshold").alias("cuts"))    # one entry per epoch
    per_source = _null_safe(targets, wide, ["source"])
    times = F.size(F.filter("cuts", lambda c: F.col("hash") < c))
    return _null_safe(sized, per_source, ["source"]) \
        .select(*ids, "source", "size", "source_size", "target", (F.col("size") * times).cast("long").alias("taken"))


def sample(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, epochs: int = EPOCHS) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it (documents of size 0 not at all)."""
    key, n = free_name(docs, "_key"), free_name(docs, "_times")
    times = mix(docs, weights, share, epochs, key=True) \
        .where("taken > 0").select(F.col("key").alias(key), (F.col("taken") / F.col("size")).cast("int").alias(n)).distinct()
    return docs.withColumn(key, row_key()).join(times.hint("shuffle_hash"), key) \
        .withColumn(n, F.explode(F.sequence(F.lit(1), F.col(n)))).select(*docs.columns)
