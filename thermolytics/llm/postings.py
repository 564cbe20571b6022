"""Approximate nearest neighbours by balanced posting lists.

Centroids are fitted on a bounded sample and kept in memory, with a robust-pruned graph over them.
A vector is put on the list of its nearest centroid, found by greedy search on that graph, and a
boundary vector also on the lists of up to ``COPIES`` centroids that are nearly as close. Lists
above ``LIST`` vectors are dealt by hash into parts of about that size, so no task holds more than
a part, however many vectors are alike. A query searches the centroid graph, and takes the lists whose
distance is within a ratio of that of the nearest one (with nearer ones, of those that are first to be home
to more than ``k`` vectors); it is sent to every part of those lists. Each part scores its queries exactly and
returns their best ``k``; the results are merged per query. Queries that still have fewer than ``k``, though
there are more candidates, are scored against all vectors, in blocks.

The ratio is calibrated: on the bounded sample, the smallest at which an index of the sample finds
``RECALL`` of the true neighbours of some of its rows. ``recall`` measures the index against
brute force over all rows, in blocks.

Cases: null or zero vectors and those with null or non-finite components take no part, nor do
rows without an id. Vectors are compared with those of the same length only; each length is a search of
its own. Ties go to the smaller id. Rows that share
an id are one candidate each, but never their own id's. Fewer than ``k`` candidates are returned if
there are no more. An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import materialize
from .vectors import CLUSTER_MOST, beam_search, by_length, centroids, clean, matrix, padded, pruned_graph, sample, unit, with_reverse

PER_LIST = 250
LIST = 2000
COPIES = 4
CLOSE = 1.05            # distance to a further list against the nearest, for a copy
RECALL = 0.97
RATIOS = (1.0, 1.02, 1.04, 1.06, 1.08, 1.1, 1.13, 1.16, 1.2, 1.25, 1.3, 1.4, 1.6, 2.0, 4.0)


class Centres:
    """Centroids with a graph; ``near`` gives lists within a ratio of the nearest distance."""

    def __init__(self, c: np.ndarray):
        self.c = c
        self.graph = padded(with_reverse(pruned_graph(c)))
        self.start = np.array([(c @ c.mean(axis=0)).argmax()]) if len(c) else np.array([], np.int64)

    def near(self, x: np.ndarray, ratio: float, most: int | None = None, held: np.ndarray | None = None,
             need: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """(row, list) pairs, nearest first in each row. ``x`` has unit rows.

        With ``held``, the vectors whose nearest list is each, the ratio is to the distance up to which
        the lists hold ``need`` vectors.
        """
        seen = beam_search(x, self.c, self.graph, self.start, beam=16)
        dist = np.sqrt(np.maximum(0, 2 - 2 * seen))
        first = dist.min(axis=1, keepdims=True)
        if held is not None:
            few = np.flatnonzero(held[dist.argmin(axis=1)] < need)
            for i in range(0, len(few), 64):
                every = np.sqrt(np.maximum(0, 2 - 2 * (x[few[i:i + 64]] @ self.c.T)))
                order = np.argsort(every, axis=1, kind="stable")
                enough = np.minimum((np.cumsum(held[order], axis=1) < need).sum(axis=1), len(self.c) - 1)
                reach = np.take_along_axis(order, enough[:, None], axis=1)
                first[few[i:i + 64]] = np.maximum(first[few[i:i + 64]], np.take_along_axis(every, reach, axis=1))
        bar = np.maximum(first, 1e-6) * ratio
        if not most:        # lists in range may lie past the beam: widen over all of the range
            seen = beam_search(x, self.c, self.graph, self.start, beam=16, reach=float(1 - bar.max() ** 2 / 2))
            dist = np.sqrt(np.maximum(0, 2 - 2 * seen))
        fit = (dist <= bar) & (seen > -2)
        fit[np.arange(len(x)), dist.argmin(axis=1)] = True
        row, cell = np.nonzero(fit)
        order = np.lexsort((cell, dist[row, cell], row))
        row, cell = row[order], cell[order]
        if most:
            turn = np.arange(len(row)) - np.searchsorted(row, row)
            row, cell = row[turn < most], cell[turn < most]
        return row, cell


def calibrated(x: np.ndarray, centres: Centres, k: int, queries: int = 200) -> float:
    """Smallest of ``RATIOS`` that finds ``RECALL`` of the ``k`` nearest of sampled rows among the sample."""
    if len(x) <= k + 1:
        return RATIOS[-1]
    q = x[:queries]
    s = q @ x.T
    s[np.arange(len(q)), np.arange(len(q))] = -2
    true = np.argpartition(-s, k, axis=1)[:, :k]
    row, cell = centres.near(x, CLOSE, COPIES)
    held = np.zeros((len(x), len(centres.c)), bool)
    held[row, cell] = True
    for ratio in RATIOS:
        qr, qc = centres.near(q, ratio)
        asked = np.zeros((len(q), len(centres.c)), bool)
        asked[qr, qc] = True
        if np.mean([(held[t] & a).any(axis=1).mean() for t, a in zip(true, asked)]) >= RECALL:
            return ratio
    return RATIOS[-1]


def _spread(rows: DataFrame, centres: Centres, ratio: float, most: int | None, held: np.ndarray | None = None,
            need: int = 0) -> DataFrame:
    """(id, v, list, home): each vector on its lists; home is the nearest."""
    def put(batches):
        for b in batches:
            for i in range(0, b.num_rows, 256):
                part = b.slice(i, 256)
                row, cell = centres.near(unit(matrix(part.column("v"))), ratio, most, held, need)
                at = pa.array(row)
                yield pa.RecordBatch.from_arrays([part.column("id").take(at), part.column("v").take(at),
                                                  pa.array(cell.astype(np.int32)), pa.array(np.diff(row, prepend=-1) > 0)],
                                                 names=["id", "v", "list", "home"])

    kind = rows.schema["v"].dataType.simpleString()
    return rows.select("id", "v").mapInArrow(put, f"id long, v {kind}, list int, home boolean")


def _best(k: int):
    def score(t: pa.Table) -> pa.Table:
        asks = t.column("asks").to_numpy(zero_copy_only=False)
        x, ids = matrix(t.column("v")), t.column("id").to_numpy()
        q, p = np.flatnonzero(asks), np.flatnonzero(~asks)
        rows_q, rows_v, scores = [np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty(0)]
        big = np.abs(x).max(axis=1, keepdims=True)
        big = np.where((big > 1e-100) & (big < 1e100), 1.0, big)       # cosine as it is, unless squares overflow
        x = x / big
        norm = np.sqrt((x * x).sum(axis=1))
        rough = (x[q] / norm[q, None]) @ (x[p] / norm[p, None]).T if len(q) and len(p) else np.empty((len(q), 0))
        for i, one in enumerate(q):
            s = np.where(ids[p] == ids[one], -2, rough[i])
            n = min(k, len(p))
            if not n:
                continue
            at = np.flatnonzero((s >= np.partition(s, len(p) - n)[len(p) - n] - 1e-9) & (s > -2))
            cand = p[at]
            exact = (x[cand] * x[one]).sum(axis=1) / (norm[cand] * norm[one])
            order = np.lexsort((ids[cand], -exact))[:k]
            rows_q.append(np.full(len(order), ids[one]))
            rows_v.append(ids[cand[order]])
            scores.append(exact[order])
        return pa.table({"query_id": np.concatenate(rows_q), "vec_id": np.concatenate(rows_v), "score": np.concatenate(scores)})

    return score


def _scored(held: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    """(query_id, rank, vec_id, score): ``k`` best of the vectors in the parts that a query is sent to."""
    cols = ["list", "part", "id", "v"]
    both = held.select(*cols, F.lit(False).alias("asks")).union(asked.select(*cols, F.lit(True).alias("asks")))
    found = both.groupBy("list", "part").applyInArrow(_best(k), "query_id long, vec_id long, score double").distinct()
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k) \
        .select("query_id", "rank", "vec_id", "score")


def search(vectors: DataFrame, queries: Column | str, k: int = 5) -> DataFrame:
    """(query_id, rank, vec_id, score): ``k`` nearest of the rows of ``vectors`` (id, v) that satisfy ``queries``."""
    vectors = materialize(vectors.distinct(), "ann-vectors")        # equal rows are one candidate
    x = sample(vectors)
    if not len(x):
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    n = vectors.count()
    centres = Centres(centroids(x, min(CLUSTER_MOST, max(1, n // PER_LIST))))
    ratio = calibrated(x, centres, k)
    lists = materialize(_spread(vectors, centres, CLOSE, COPIES), "ann-lists")
    parts = lists.groupBy("list").agg(F.ceil(F.count("*") / LIST).cast("int").alias("parts"), F.count_if("home").alias("home"))
    parts = materialize(parts, "ann-parts")
    home = np.zeros(len(centres.c), np.int64)
    for r in parts.collect():                                       # one row per centroid
        home[r["list"]] = r["home"]
    parts = parts.drop("home")
    asked = _spread(vectors.where(queries), centres, ratio, None, home, k + 1)
    deal = F.pmod(F.xxhash64("id", "v"), F.col("parts")).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    found = _scored(lists.join(parts, "list").withColumn("part", deal), asked.join(parts, "list").withColumn("part", every), k)
    found = materialize(found, "ann-found")

    # A query has all of its k, or else all there are.
    whole = found.where(F.col("rank") == k).select(F.col("query_id").alias("id"))
    short = materialize(vectors.where(queries).join(whole, "id", "left_anti"), "ann-short")
    if not short.take(1) or vectors.select("id").distinct().count() < 2:
        return found
    block = [F.lit(0).alias("list"), F.lit(-(-n // LIST)).alias("parts")]
    rest = _scored(vectors.select("*", *block).withColumn("part", deal), short.select("*", *block).withColumn("part", every), k)
    return found.join(short, found["query_id"] == short["id"], "left_anti").union(rest)


def nearest(df: DataFrame, every: int = 50, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``search`` with the rows whose id is divisible by ``every`` as queries, against all rows."""
    found = [search(vectors, F.col("id") % every == 0, k) for vectors in by_length(clean(df, id_col, vec_col))]
    return reduce(DataFrame.unionByName, found)


def recall(df: DataFrame, result: DataFrame, queries: int = 200, every: int = 50, k: int = 5, id_col: str = "vec_id",
           vec_col: str = "embedding") -> float:
    """Share of the true ``k`` nearest of a bounded sample of the queries that ``result`` holds; brute force in blocks.
    Of vectors of the most frequent length."""
    vectors = by_length(clean(df, id_col, vec_col))[0]
    picked = vectors.where(F.col("id") % every == 0).orderBy(F.xxhash64("id"), "id").limit(queries) \
        .withColumn("asks", F.lit(True)).toArrow().select(["id", "v", "asks"])

    def brute(batches):
        for b in batches:
            for i in range(0, b.num_rows, 2048):
                part = pa.Table.from_batches([b.slice(i, 2048)])
                part = part.append_column("asks", pa.array([False] * part.num_rows))
                yield from score(pa.concat_tables([part.select(["id", "v", "asks"]), picked.cast(part.select(["id", "v", "asks"]).schema)])
                                 ).to_batches()

    score = _best(k)
    true = vectors.select("id", "v").mapInArrow(brute, "query_id long, vec_id long, score double").distinct()
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    true = true.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    hit = true.join(result.select("query_id", "vec_id").withColumn("hit", F.lit(1)), ["query_id", "vec_id"], "left") \
        .agg(F.count("hit").alias("hit"), F.count("*").alias("n")).first()
    return hit["hit"] / hit["n"] if hit["n"] else 1.0
