"""Local outlier factor (Breunig et al., SIGMOD 2000) on the exact kNN of ``knn``.

For each point p with k nearest neighbours N(p):
  k-distance(p)    = distance of the k-th neighbour
  reach(p, o)      = max(d(p, o), k-distance(o))
  lrd(p)           = 1 / (mean over N(p) of reach(p, o) + 1e-10)
  LOF(p)           = mean over N(p) of lrd(o) / lrd(p)
  score            = -LOF (higher = more normal)
k is clipped to (points in the group - 1). Identical rows are one vector
with a count; its copies are each other's neighbours at distance 0.
Neighbours stay in one list per vector; k-distance, lrd and LOF are means
over a cell's lists, joined with the values of the neighbours they name.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .knn import CELL_COLS, LEAF, KdTree, _apart, _near_rows, _search_partitions, build_tree, descend, entries, \
    packed_approximate_lists, packed_lists
from .quantile import exact_quantile
from ..functions.params import attach_row
from ..session import materialize, release

EPS = 1e-10
AUTO_OFFSET = -1.5
GLOBAL = "_g"
ENTRIES = 1 << 22         # neighbours that the lists of a leaf hold, about: with a large k the leaves are smaller


@dataclass
class LofModel:
    tree: KdTree
    ref: DataFrame          # G..., vid, dims..., cnt, leaf, kdist, lrd, lof, _k (k clipped to the group)
    groups: list
    dims: list
    within: str | None
    k: int


def _groups(df: DataFrame, within):
    if within:
        return df, [within]
    return df.withColumn(GLOBAL, F.lit(0)), [GLOBAL]


def distinct_vectors(df: DataFrame, groups, dims, id_col: str) -> DataFrame:
    """(G..., dims..., vid = smallest row id, cnt) per distinct vector; partial aggregation
    makes a hot vector cost one row per task before the shuffle."""
    x = [F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in dims]
    return (df.select(*groups, F.col(id_col).cast("long").alias("_id"), *x)
            .groupBy(*groups, *dims).agg(F.min("_id").alias("vid"), F.count(F.lit(1)).alias("cnt")))


def _means(g, columns):
    """Cogroup function: a cell's neighbour lists and the values of the neighbours in them -> per list the local
    reachability density (``_lrd``, from ``_ckd``) and the neighbours' mean density (``_mlrd``, from ``_clrd``)."""
    far = any(source == "_ckd" for _, source in columns)       # distances are needed

    def fn(lists: pa.Table, values: pa.Table) -> pa.Table:
        n = len(lists)
        if far:
            rows, cid, w, dist = _near_rows(lists, "cid", "w", "dist")
        else:
            rows, cid, w = _near_rows(lists, "cid", "w")
        ids = values.column("cid").to_numpy()
        by = np.argsort(ids, kind="stable")
        at = np.minimum(np.searchsorted(ids[by], cid), max(len(ids) - 1, 0))
        known = np.flatnonzero(ids[by[at]] == cid) if len(ids) else np.zeros(0, np.int64)
        rows, w, at = rows[known], w[known], by[at[known]] if len(ids) else at[known]
        total = np.bincount(rows, weights=w, minlength=n)
        out = {c: lists.column(c) for c in [*g, "qid"]}
        for name, source in columns:
            v = values.column(source).to_numpy()[at].astype(np.float64)
            v = np.maximum(dist[known], v) if source == "_ckd" else v
            with np.errstate(divide="ignore", invalid="ignore"):
                mean = np.bincount(rows, weights=w * v, minlength=n) / total
                out[name] = pa.array(1.0 / (mean + EPS) if source == "_ckd" else mean, pa.float64(), mask=total == 0)
        return pa.table(out)
    return fn


def _averaged(lists: DataFrame, needs: DataFrame, values: DataFrame, g, columns, leaves: int = 0) -> DataFrame:
    """(G..., qid, columns) of the ``lists`` from ``values`` (G..., cid, ...) of the neighbours they name. A cell's lists
    come together with one row per neighbour they need; the lists themselves are not taken apart."""
    key = [*g, *CELL_COLS]
    n = _search_partitions(lists.sparkSession, leaves)
    schema = T.StructType([lists.schema[c] for c in [*g, "qid"]] + [T.StructField(c, T.DoubleType()) for c, _ in columns])
    found = needs.join(values, [*g, "cid"]).repartition(n, *key)
    fields = ["cid", "w", *["dist"][:any(source == "_ckd" for _, source in columns)]]
    return lists.select(*key, "qid", *_apart(*fields)).repartition(n, *key).groupBy(*key).cogroup(found.groupBy(*key)) \
        .applyInArrow(_means(g, columns), schema)


def _needs(lists: DataFrame, g) -> DataFrame:
    """(G..., leaf, _chunk, cid): the neighbours that each cell's lists name, once each."""
    if "names" in lists.columns:        # the merge of the lists has found them
        return lists.where("names is not null").select(*g, *CELL_COLS, F.explode("names").alias("cid"))
    return entries(lists, g, *CELL_COLS).select(*g, *CELL_COLS, "cid").distinct()


def _spent(lists: DataFrame) -> list:
    return lists.__dict__.get("spent", [])


def _factors(lists: DataFrame, g, leaves: int = 0) -> tuple[DataFrame, list]:
    """(G..., vid, kdist, lrd, lof, _k) of every vector from its neighbours in ``lists``, and the tables staged for it."""
    needs = materialize(_needs(lists, g), "lof-needs")
    # The neighbours' multiplicities add up to k, or to all the others of a smaller group.
    lists = lists.where(F.col("_got") > 0)
    kd = lists.select(*g, F.col("qid").alias("vid"), F.col("_far").alias("kdist"), F.col("_got").alias("_k"))
    lrd = _averaged(lists, needs, kd.select(*g, F.col("vid").alias("cid"), F.col("kdist").alias("_ckd")), g, [("lrd", "_ckd")], leaves)
    lrd = materialize(lrd.withColumnRenamed("qid", "vid"), "lof-lrd")
    mean_n = _averaged(lists, needs, lrd.select(*g, F.col("vid").alias("cid"), F.col("lrd").alias("_clrd")), g, [("_mlrd", "_clrd")], leaves)
    return kd.join(lrd, [*g, "vid"]).join(mean_n.withColumnRenamed("qid", "vid"), [*g, "vid"]) \
             .select(*g, "vid", "kdist", "lrd", (F.col("_mlrd") / F.col("lrd")).alias("lof"), "_k"), [needs, lrd]


def fit_lof(df: DataFrame, dims, id_col: str, k: int = 20, within: str | None = None,
            leaf_size: int = LEAF) -> LofModel:
    """Fit LOF on rows of ``df`` (features ``dims`` already scaled; nulls count as 0).

    Runs the index build and neighbour search eagerly; intermediate tables
    are staged in the shared checkpoint folder and deleted as soon as they are spent.
    """
    if k < 1:
        raise ValueError("k must be at least 1")
    df, g = _groups(df, within)
    x = list(dims)
    vec, n = materialize(distinct_vectors(df, g, x, id_col), "lof-vectors", count=True)
    tree = build_tree(vec, g, x, leaf_size=max(min(leaf_size, ENTRIES // k), 4 * k), n_vectors=n)
    release(vec)
    nb = packed_lists(tree, tree.vectors, k, self_mode=True)
    stats, staged = _factors(nb, g, tree.leaves)
    ref = materialize(tree.vectors.join(stats, [*g, "vid"], "left"), "lof-ref")
    release(nb, *_spent(nb), *staged)
    return LofModel(_reference(tree, ref), ref, g, x, within, k)


def _reference(tree: KdTree, ref: DataFrame) -> KdTree:
    """The fitted tree over the reference vectors, each with its group's k (a group of one row has none)."""
    vectors = ref.where(F.col("_k") >= 1).select(*tree.groups, "vid", *tree.dims, "cnt", "leaf", "_k")
    return KdTree(vectors, tree.splits, tree.boxes, tree.groups, tree.dims, tree.depth, tree.leaf_size, tree.least, tree.leaves)


def _attach(df: DataFrame, g, x, scored: DataFrame, cols) -> DataFrame:
    """Join per-vector results back to the rows on (G..., feature values)."""
    keyed = df.select("*", *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(f"_key_{c}") for c in x])
    s = scored.select(*g, *[F.col(c).alias(f"_key_{c}") for c in x], *cols)
    return keyed.join(s, [*g, *[f"_key_{c}" for c in x]], "left").drop(*[f"_key_{c}" for c in x])


def lof_scores(df: DataFrame, dims, id_col: str, k: int = 20, within: str | None = None,
               leaf_size: int = LEAF, model: LofModel | None = None) -> DataFrame:
    """Rows of ``df`` with ``lof`` and ``lof_score`` (= -lof) of their own fit."""
    # The rows are used twice (fit and join-back): cut their lineage once.
    df = materialize(df, "lof-rows")
    m = model or fit_lof(df, dims, id_col, k, within, leaf_size)
    d2, g = _groups(df, within)
    out = _attach(d2, g, m.dims, m.ref, ["lof"]).withColumn("lof_score", -F.col("lof"))
    return out.drop(GLOBAL) if not within else out


def lof_scores_approximate(df: DataFrame, dims, id_col: str, k: int = 20, within: str | None = None, leaf_size: int = 1024,
                           tables: int = 4) -> DataFrame:
    """As ``lof_scores``, on neighbours found by random-projection hash tables (``knn.approximate_knn``): for groups so
    large that the exact search is not wanted. Its recall is a matter of ``tables``; measure it against ``knn``."""
    if k < 1:
        raise ValueError("k must be at least 1")
    df = materialize(df, "lof-rows")
    d2, g = _groups(df, within)
    x = list(dims)
    vec, n = materialize(distinct_vectors(d2, g, x, id_col), "lof-vectors", count=True)
    nb = packed_approximate_lists(vec, g, x, k, tables, max(leaf_size, 4 * k), n_vectors=n)
    stats, staged = _factors(nb, g)
    scored = materialize(vec.join(stats.select(*g, "vid", "lof"), [*g, "vid"], "left"), "lof-approximate")
    release(nb, vec, *staged)
    out = _attach(d2, g, x, scored, ["lof"]).withColumn("lof_score", -F.col("lof"))
    return out.drop(GLOBAL) if not within else out


def lof_novelty(model: LofModel, df: DataFrame, dims, id_col: str) -> DataFrame:
    """Score new rows against the fitted reference set without adding them to it.

    ``lof_score`` is the negated novelty LOF: the rows' neighbours are taken
    from the reference (identical reference rows count in full), with the
    reference's k-distances and lrd.
    """
    d2, g = _groups(materialize(df, "novelty-rows"), model.within)
    x = list(dims)
    if x != model.dims:
        d2 = d2.select("*", *[F.col(a).alias(b) for a, b in zip(x, model.dims) if a != b])
        x = model.dims
    q = materialize(descend(model.tree, distinct_vectors(d2, g, x, id_col)), "novelty-vectors")
    nb = packed_lists(model.tree, q, most_k=model.k)
    ref = model.ref.select(*g, F.col("vid").alias("cid"), F.col("kdist").alias("_ckd"), F.col("lrd").alias("_clrd"))
    needs = materialize(_needs(nb, g), "novelty-needs")
    agg = _averaged(nb, needs, ref, g, [("_lrd", "_ckd"), ("_mlrd", "_clrd")], model.tree.leaves)
    scored = q.join(agg.withColumnRenamed("qid", "vid"), [*g, "vid"], "left") \
              .select(*g, *x, (F.col("_mlrd") / F.col("_lrd")).alias("lof"))
    scored = materialize(scored, "novelty-scores")
    release(q, nb, *_spent(nb), needs)
    out = _attach(d2, g, x, scored, ["lof"]).withColumn("lof_score", -F.col("lof"))
    return out.drop(GLOBAL) if not model.within else out


def _fraction(contamination) -> float | None:
    if contamination in (None, "auto"):
        return None
    c = float(contamination)
    if not 0.0 < c <= 0.5:
        raise ValueError("contamination must be 'auto' or in (0, 0.5]")
    return c


def contamination_offset(scored: DataFrame, contamination="auto", score_col: str = "lof_score") -> DataFrame:
    """One-row table with ``offset``: -1.5 for 'auto', else the contamination
    quantile of the scores (linear interpolation, exact)."""
    c = _fraction(contamination)
    if c is None:
        return scored.sparkSession.range(1).select(F.lit(AUTO_OFFSET).alias("offset"))
    return exact_quantile(scored, score_col, c, alias="offset")


def lof_flag(scored: DataFrame, contamination="auto", score_col: str = "lof_score") -> DataFrame:
    """Adds ``is_outlier`` = score below the offset (1 = outlier)."""
    if _fraction(contamination) is not None:
        scored = materialize(scored, "lof-scored")      # read for the quantile and again for the flags
    off = contamination_offset(scored, contamination, score_col)
    return attach_row(scored, off).withColumn(
        "is_outlier", (F.col(score_col) < F.col("offset")).cast("int")).drop("offset")
