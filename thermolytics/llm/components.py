"""Connected components of a link table, as joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..session import materialize, release


def components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(id, component) for every id in ``links`` (columns a, b): the smallest id it reaches.

    Each round gives every id the smallest label among itself and its neighbours, then the
    label of that label (pointer jumping), until nothing changes. A hub's links are reduced by
    partial minima, so no round gathers them in one task. Links need not be distinct; a null
    end or a loop adds nothing.
    """
    both = links.where("a is not null and b is not null").select("a", "b")
    both = materialize(both.union(both.select("b", "a")).distinct(), "links")
    labels = materialize(both.groupBy("a").agg(F.min("b").alias("low"))
                         .select(F.col("a").alias("id"), F.least("a", "low").alias("label")), "labels")
    for _ in range(max_rounds):
        near = both.join(labels.withColumnRenamed("id", "b"), "b").groupBy("a").agg(F.min("label").alias("low"))
        hooked = labels.join(near.withColumnRenamed("a", "id"), "id") \
            .select("id", F.col("label").alias("old"), F.least("label", "low").alias("label"))
        jump = hooked.select(F.col("id").alias("label"), F.col("label").alias("next"))
        changed = Observation()
        step = hooked.join(jump, "label").select("id", "old", F.col("next").alias("label")) \
            .observe(changed, F.count(F.when(F.col("old") != F.col("label"), 1)).alias("n"))
        new = materialize(step.select("id", "label"), "labels")
        release(labels)
        labels = new
        if not changed.get["n"]:
            release(both)
            return labels.withColumnRenamed("label", "component")
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
