"""Hard-negative mining by Strassen multiplication of anchor and candidate tiles.

Components become integers (floor of ``SCALE`` times the double), so scores are exact inner products.
Anchors and candidates are dealt by hash into a grid of tiles. In each cell the tile of anchors is
multiplied with that of candidates by Strassen's recursion on int64 matrices, padded with zeros to
even sizes; its additions wrap round, which leaves every score that fits 64 bits exact. The first pass
multiplies the rows of one label with each other and keeps each anchor's best as its heap of positives;
heaps of all cells merge into the anchor's first positives. The second pass takes anchors with their
positives, multiplies whole tiles and keeps, per anchor and positive, a heap of the best candidates of
another label inside the window that the positive's score sets; these heaps merge likewise.

Tiles hold at most about ``TILE_VALUES`` numbers (``ANCHOR_VALUES`` of anchors), whatever the labels, so
a label with a third of all rows makes no task larger. Order everywhere: higher score, then smaller id.
The search is exhaustive, as its contract asks: a candidate is sent once to each tile of anchors, which hold
some 16,000 anchors of 64 components.

Cases: rows with a null id, label or vector or a null or non-finite component take no part. Neither do
those whose squared length in integers is over 2^62, as their scores might not fit 64 bits. Zero
vectors take part. Vectors are compared with those of the same length only. Equal rows count once; a
row is never its anchor's positive or negative if it has the anchor's id. Rows that share an id but
differ are candidates each (once where their scores agree), and as anchors each its own. Anchors without a positive, and positives
without a negative in the window, give no rows. An empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import materialize
from .common import slots
from .vectors import matrix

SCALE = 256
LEAF = 16               # matrices with a side of at most this are multiplied directly
SLAB = 512              # anchors, and eight times as many candidates, multiplied at a time
ANCHOR_VALUES = 1 << 20
TILE_VALUES = 1 << 21
LEAST_VALUES = 1 << 15  # of a tile that is made smaller to keep all task slots busy
POSITIVES = 5
NEGATIVES = 3
LOW, HIGH = 50, 95      # percent of the positive's score


def _direct(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Product modulo 2^64. Through doubles where every partial sum is exact in them."""
    x, y = a.astype(np.float64), b.astype(np.float64)
    exact = np.abs(x).max(initial=0) * np.abs(y).max(initial=0) * a.shape[1] < 2.0 ** 53
    return (x @ y).astype(np.int64) if exact else a @ b


def strassen(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``a @ b`` of int64 matrices modulo 2^64, by seven products of half the sides."""
    m, k, n = a.shape[0], a.shape[1], b.shape[1]
    if min(m, k, n) <= LEAF:
        return _direct(a, b)
    a = np.pad(a, ((0, m % 2), (0, k % 2)))
    b = np.pad(b, ((0, k % 2), (0, n % 2)))
    i, j, l = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2
    a11, a12, a21, a22 = a[:i, :j], a[:i, j:], a[i:, :j], a[i:, j:]
    b11, b12, b21, b22 = b[:j, :l], b[:j, l:], b[j:, :l], b[j:, l:]
    p1 = strassen(a11 + a22, b11 + b22)
    p2 = strassen(a21 + a22, b11)
    p3 = strassen(a11, b12 - b22)
    p4 = strassen(a22, b21 - b11)
    p5 = strassen(a11 + a12, b22)
    p6 = strassen(a21 - a11, b11 + b12)
    p7 = strassen(a12 - a22, b21 + b22)
    out = np.empty((2 * i, 2 * l), np.int64)
    out[:i, :l] = p1 + p4 - p5 + p7
    out[:i, l:] = p3 + p5
    out[i:, :l] = p2 + p4
    out[i:, l:] = p1 - p2 + p3 + p6
    return out[:m, :n]


def heap(scores: np.ndarray, ids: np.ndarray, fit: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` first of the entries that ``fit``: higher score, then smaller id."""
    at = np.flatnonzero(fit)
    if len(at) > k:     # all that tie with the k-th stay until the ids are looked at
        bar = np.partition(scores[at], len(at) - k)[len(at) - k]
        at = at[scores[at] >= bar]
    return at[np.lexsort((ids[at], -scores[at]))][:k]


def prepared(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label: Column | str = "label") -> DataFrame:
    """(id, label, v): the rows that take part, once each, with integer components."""
    label = F.col(label) if isinstance(label, str) else label
    fine = "v is not null and id is not null and label is not null and " \
           "forall(v, x -> x is not null and not isnan(x) and abs(x) < double('inf'))"
    rows = df.select(F.col(id_col).cast("long").alias("id"), label.cast("long").alias("label"),
                     F.transform(vec_col, lambda x: F.floor(F.lit(float(SCALE)) * x.cast("double")).cast("double")).alias("d"),
                     F.transform(vec_col, lambda x: x.cast("double")).alias("v")).where(fine)
    square = F.aggregate("d", F.lit(0.0), lambda s, x: s + x * x)
    return rows.where(square <= 2.0 ** 62).select("id", "label", F.transform("d", lambda x: x.cast("long")).alias("v")).distinct()


def _tiles(t: pa.Table) -> tuple:
    asks = t.column("asks").to_numpy(zero_copy_only=False)
    x = matrix(t.column("v"), np.int64)
    return asks, x, t.column("id").to_numpy(), t.column("label").to_numpy()


def _positives(k: int):
    def best(t: pa.Table) -> pa.Table:
        asks, x, ids, labels = _tiles(t)
        out = []
        for label in np.unique(labels[asks]):
            q, p = np.flatnonzero(asks & (labels == label)), np.flatnonzero(~asks & (labels == label))
            for i, j, scores in _products(x, q, p):
                for row, one in enumerate(i):
                    first = heap(scores[row], ids[j], ids[j] != ids[one], k)
                    out += [(ids[one], label, one, ids[j[c]], scores[row, c]) for c in first]
        return _table(out, t, ["anchor_id", "label", "positive_id", "positive_score"])

    return best


def _products(x: np.ndarray, q: np.ndarray, p: np.ndarray):
    """Slabs (anchor places, candidate places, scores) of the product of rows ``q`` with rows ``p``."""
    for i in range(0, len(q), SLAB):
        for j in range(0, len(p), 8 * SLAB):
            a, b = q[i:i + SLAB], p[j:j + 8 * SLAB]
            yield a, b, strassen(x[a], np.ascontiguousarray(x[b].T))


def _table(out: list[tuple], t: pa.Table, names: list[str]) -> pa.Table:
    """Rows (anchor_id, label, place, numbers...) as a table with the anchor's vector key."""
    cols = list(zip(*out)) if out else [()] * (len(names) + 1)
    key = t.column("key").to_numpy()
    cols = [cols[0], cols[1], key[np.array(cols[2], np.int64)] if out else (), *cols[3:]]
    return pa.table({n: pa.array(np.array(c, np.int64)) for n, c in zip(["anchor_id", "label", "key", *names[2:]], cols)})


def _negatives(k: int):
    def best(t: pa.Table) -> pa.Table:
        asks, x, ids, labels = _tiles(t)
        q, p = np.flatnonzero(asks), np.flatnonzero(~asks)
        held = t.column("positives").to_pylist() if len(q) and len(p) else []
        out = []
        for i, j, scores in _products(x, q, p):
            for row, one in enumerate(i):
                s = scores[row]
                other = (labels[j] != labels[one]) & (ids[j] != ids[one])
                for pos in held[one]:
                    # 50 p <= 100 s <= 95 p, in bounds on s that cannot overflow
                    low, high = -(-LOW * pos["score"] // 100), HIGH * pos["score"] // 100
                    first = heap(s, ids[j], other & (s >= low) & (s <= high), k)
                    out += [(ids[one], labels[one], one, pos["id"], pos["score"], ids[j[c]], s[c]) for c in first]
        return _table(out, t, ["anchor_id", "label", "positive_id", "positive_score", "negative_id", "negative_score"])

    return best


def _grid(anchors: DataFrame, rows: DataFrame, n_anchors: int, n_rows: int) -> DataFrame:
    """Anchors (asks) and candidates by cell (i, j) of ``n_anchors`` x ``n_rows`` tiles."""
    deal = lambda n: F.pmod(F.col("key"), F.lit(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    asked = anchors.select("*", F.lit(True).alias("asks"), deal(n_anchors).alias("i")).withColumn("j", each(n_rows))
    held = rows.select("*", F.lit(False).alias("asks"), deal(n_rows).alias("j")).withColumn("i", each(n_anchors))
    return asked.unionByName(held, allowMissingColumns=True)


def _merged(found: DataFrame, by: list[str], score: str, other: str, k: int) -> DataFrame:
    """The ``k`` first rows of each ``by``, from the heaps of all cells, with their ``rank``."""
    order = W.partitionBy(*by).orderBy(F.desc(score), other)        # k rows per cell
    return found.distinct().withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine(rows: DataFrame, anchors: Column | str, positives: int = POSITIVES, negatives: int = NEGATIVES) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for the rows (id, label, v) that
    satisfy ``anchors``, against all rows. ``rank`` counts the negatives of one anchor and positive from 1."""
    spark = rows.sparkSession
    rows = materialize(rows.withColumn("key", F.xxhash64("id", "label", "v")).withColumn("size", F.size("v")), "mine-rows")
    asked = rows.where(anchors)
    values, asked_values = rows.agg(F.sum("size"), F.sum(F.when(anchors, F.col("size")))).first()
    n_anchors = max(1, -(-(asked_values or 0) // ANCHOR_VALUES))
    small = min(3 * slots(spark) // n_anchors, (values or 0) // LEAST_VALUES)
    n_rows = max(1, small, -(-(values or 0) // TILE_VALUES))
    cells = n_anchors * n_rows
    cell = ["size", "i", "j"]
    grid = _grid(asked, rows, n_anchors, n_rows).repartition(min(cells, 100_000), *cell)
    kind = "anchor_id long, label long, key long, positive_id long, positive_score long"
    found = grid.groupBy(*cell).applyInArrow(_positives(positives), kind)
    found = _merged(found, ["anchor_id", "key"], "positive_score", "positive_id", positives)
    held = found.groupBy("anchor_id", "key").agg(F.collect_list(F.struct(
        F.col("positive_id").alias("id"), F.col("positive_score").alias("score"))).alias("positives"))
    asked = materialize(asked.join(held.select(F.col("anchor_id").alias("id"), "key", "positives"), ["id", "key"]), "mine-anchors")
    grid = _grid(asked, rows, n_anchors, n_rows).repartition(min(cells, 100_000), *cell)
    kind += ", negative_id long, negative_score long"
    found = grid.groupBy(*cell).applyInArrow(_negatives(negatives), kind)
    return _merged(found, ["anchor_id", "key", "positive_id", "positive_score"], "negative_score", "negative_id", negatives) \
        .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def hard_negatives(df: DataFrame, every: int = 50, id_col: str = "vec_id", vec_col: str = "embedding",
                   label: Column | str = "label") -> DataFrame:
    """``mine`` with the rows whose id is divisible by ``every`` as anchors."""
    return mine(prepared(df, id_col, vec_col, label), F.col("id") % every == 0)
