"""Exact k-nearest-neighbour search on Spark with a distributed kd-tree.

Points are distinct feature vectors with a multiplicity (``cnt``): identical
rows are collapsed first, so any number of equal rows costs one vector.

Build: a group (or part of one) of up to ``CELL`` vectors is cut in one task, each node with more than
``leaf_size`` vectors at the quartiles of its widest dimension. Larger ones are first cut into up to
``FANOUT ** BUILD_LEVELS`` parts per pass, at the quantiles of their widest dimension from one sketch per
dimension; a vector descends the levels of a pass in one join, lineage cut by a staged table. Leaves
hold about ``leaf_size`` vectors whatever the data skew, because a dense region simply gets more,
smaller leaves.

Search: a leaf is one task, whose queries look at small blocks of its vectors by their boxes. (1) exact top-k of
each query inside its own leaf gives a radius bound r (where that holds too few vectors, together with a node near it that holds enough); (2) the tree is walked top-down keeping only nodes whose bounding
box is within r of the query (one join per level), which yields the few
other leaves that can hold a closer point; (3) exact top-k inside each of
those leaves; (4) merge, cell by cell. A query's neighbours stay one list in one row. Distances are computed with
numpy inside ``applyInArrow`` tasks whose size is bounded by the leaf size and a query
chunk size, never by a group or by the data size.

Neighbour order is (distance rounded to 9 decimals, vector id), the same
rule the SQL oracle uses, so ties are deterministic.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize, release

TIE_DECIMALS = 9
FANOUT = 4                # children per cut (quartiles of the widest dimension)
LOG2_FANOUT = 2
BOX_SLACK = 1e-9          # boxes within r + slack are searched (covers rounding ties)
QUERY_CHUNK = 1 << 16     # queries per search task
LEAF = 1 << 17            # vectors of a leaf, which one task searches by small blocks
BLOCK = 128               # vectors of a block within a search task
QUERY_BLOCK = 128         # queries that look at the same blocks
FIRST = 384               # vectors in the blocks that give a first bound
PANEL = 16                # blocks whose distances from a query block are estimated at once: what fits a core's cache
SINGLE = 4e-6             # bound of the relative error of squared distances estimated in single precision
CELL = 1 << 18            # vectors that one task cuts into leaves
BUILD_LEVELS = 1          # levels per pass above that: several along one dimension would make thin slabs
PASS_LEVELS = 3           # levels per join of the walk
SLOT_PARTITIONS = 4       # partitions per task slot, at least


@dataclass
class KdTree:
    vectors: DataFrame    # G..., vid, x..., cnt, leaf
    splits: DataFrame     # G..., node, dim, cuts, strict
    boxes: DataFrame      # G..., node, lo_i..., hi_i..., is_leaf, n and vectors (rows and vectors below)
    groups: list
    dims: list
    depth: int
    leaf_size: int
    least: int            # rows in the smallest leaf of a group that was cut
    leaves: int = 0       # leaves of all groups (0: not known)


def _pick(idx_col, values):
    """Column holding values[idx] for an integer column idx."""
    expr = None
    for i, v in enumerate(values):
        expr = F.when(idx_col == i, v) if expr is None else expr.when(idx_col == i, v)
    return expr


def _child(dims) -> F.Column:
    """Child node id under the stored cuts: node * FANOUT + number of cuts passed."""
    xv = _pick(F.col("dim"), [F.col(c) for c in dims])
    passed = F.filter("cuts", lambda c: F.when(F.col("strict"), xv > c).otherwise(xv >= c))
    return F.col("node") * FANOUT + F.size(passed)


def _depth(node) -> F.Column:
    """Depth of a node id: ids of depth d lie in [FANOUT^d, FANOUT^(d+1)). Counted in bits,
    because a floating logarithm rounds up at the end of deep levels."""
    return F.floor((F.length(F.bin(node)) - 1) / LOG2_FANOUT).cast("int")


def _spread(rows: DataFrame, table: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Both with a salt ``_s``, the small per-group ``table`` repeated for each of its values.

    At the root every row of a group has the same node: without the salt, a join there would bring a
    group together by its key alone.
    """
    n = _search_partitions(rows.sparkSession)
    return (rows.withColumn("_s", F.pmod(F.xxhash64(key), F.lit(n)).cast("int")),
            table.withColumn("_s", F.explode(F.sequence(F.lit(0), F.lit(n - 1)))))


def _nested(node: int, dim: int, cuts: list, levels: int) -> tuple[list[tuple], list[int]]:
    """(node, dim, cuts) per node of the subtree that makes sorted ``cuts`` in ``levels`` levels, and its leaf per interval."""
    if not cuts or not levels:
        return [], [node] * (len(cuts) + 1)
    at = range(len(cuts)) if len(cuts) < FANOUT else [(i * (len(cuts) + 1)) // FANOUT - 1 for i in range(1, FANOUT)]
    rows, leaves, begin = [(node, dim, [cuts[i] for i in at])], [], 0
    for child, end in enumerate([*at, len(cuts)]):
        below, ends = _nested(node * FANOUT + child, dim, cuts[begin:end], levels - 1)
        rows += below
        leaves += ends
        begin = end + 1
    return rows, leaves


def _coarse_cuts(groups, cuts_schema):
    """mapInPandas function: (G..., node, dim, low, quantiles) -> the subtree of one pass."""
    def fn(frames):
        for pdf in frames:
            out = []
            for r in pdf.to_dict("records"):
                cuts = sorted({c for c in r["qs"] if c > r["low"]})
                strict = not cuts
                nested, leaves = _nested(int(r["node"]), int(r["dim"]), cuts or [r["low"]], BUILD_LEVELS)
                out.append({**{c: r[c] for c in groups}, "node": r["node"], "dim": r["dim"], "cuts": cuts or [r["low"]],
                            "strict": strict, "leaves": leaves,
                            "nested": [{"node": n, "dim": d, "cuts": c, "strict": strict} for n, d, c in nested]})
            yield pd.DataFrame(out, columns=[f.name for f in cuts_schema])
    return fn


def _other_leaves(x: np.ndarray, start: np.ndarray, made: list[tuple]) -> np.ndarray:
    """The leaf below each row's node ``start`` by the cuts ``made``; -1 stays."""
    cut = {node: (dim, np.array(cuts), "left" if strict else "right") for node, dim, cuts, strict in made}
    out = start.copy()
    todo = {n: np.flatnonzero(out == n) for n in np.unique(out).tolist() if n in cut}
    while todo:
        node, at = todo.popitem()
        dim, cuts, side = cut[node]
        out[at] = node * FANOUT + np.searchsorted(cuts, x[at, dim], side=side)
        todo |= {n: at[out[at] == n] for n in np.unique(out[at]).tolist() if n in cut}
    return out


def _finer(dims, groups, leaf_size: int, max_depth: int):
    """applyInArrow function: vectors of one node -> the same with their leaf, the leaf beyond the nearest cut on their
    way (``beyond``, -1 if there was no cut), and the cuts made (rows without vid)."""
    def fn(t: pa.Table) -> pa.Table:
        x = np.column_stack([t.column(c).to_numpy() for c in dims])
        root = t.column("node")[0].as_py()
        leaf = np.full(len(x), root, np.int64)
        margin, beyond = np.full(len(x), np.inf), np.full(len(x), -1, np.int64)
        made, todo = [], [(root, np.arange(len(x)))]
        while todo:
            node, at = todo.pop()
            n = len(at)
            if n <= leaf_size or (node.bit_length() - 1) // LOG2_FANOUT >= max_depth:
                leaf[at] = node
                continue
            low, high = x[at].min(axis=0), x[at].max(axis=0)
            dim = int((high - low).argmax())
            v = x[at, dim]
            # Cuts at the quartiles above the minimum (each is a data value, so every cut has data on both sides).
            # If all equal the minimum, one cut just above it ("strict").
            places = [i * n // FANOUT for i in range(1, FANOUT)]
            quartiles = np.partition(v, places)[places]
            cuts = np.unique(quartiles[quartiles > low[dim]])
            strict = not len(cuts)
            cuts = low[dim:dim + 1] if strict else cuts
            child = np.searchsorted(cuts, v, side="left" if strict else "right")
            made.append((node, dim, cuts.tolist(), strict))
            walls = np.concatenate([[-np.inf], cuts, [np.inf]])
            down, up = v - walls[child], walls[child + 1] - v
            near = np.minimum(down, up)
            closer = near < margin[at]
            margin[at[closer]] = near[closer]
            beyond[at[closer]] = (node * FANOUT + child + np.where(down < up, -1, 1))[closer]
            todo += [(node * FANOUT + c, at[child == c]) for c in range(len(cuts) + 1)]
        cols = {c: t.column(c) for c in [*groups, "vid", *dims, "cnt"]} | {"leaf": pa.array(leaf), "beyond": pa.array(_other_leaves(x, beyond, made))}
        out = pa.table(cols | {"dim": pa.nulls(len(x), pa.int32()), "cuts": pa.nulls(len(x), pa.list_(pa.float64())),
                               "strict": pa.nulls(len(x), pa.bool_())})
        node, dim, cuts, strict = zip(*made) if made else ((),) * 4
        m = len(node)
        rows = pa.table({c: pa.array([t.column(c)[0].as_py()] * m, t.schema.field(c).type) for c in groups}
                        | {c: pa.nulls(m, t.schema.field(c).type) for c in ["vid", *dims, "cnt"]}
                        | {"leaf": pa.array(node, pa.int64()), "beyond": pa.nulls(m, pa.int64()), "dim": pa.array(dim, pa.int32()),
                           "cuts": pa.array(cuts, pa.list_(pa.float64())), "strict": pa.array(strict, pa.bool_())})
        return pa.concat_tables([out, rows.select(out.column_names)])
    return fn


def build_tree(vectors: DataFrame, groups, dims, leaf_size: int = 1024, max_depth: int = 28, cell: int = CELL,
               n_vectors: int | None = None, beyond: bool = False) -> KdTree:
    """Partition distinct vectors (G..., vid, dims..., cnt) into kd-tree leaves per group.

    ``n_vectors``, if known, is their number: no group of a smaller table needs a look at its size. With ``beyond``
    the tree's vectors also have the leaf beyond the nearest cut that their cell was given (-1: none).
    """
    g, x = list(groups), list(dims)
    spark = vectors.sparkSession
    gfields = [vectors.schema[c] for c in g]
    one = [T.StructField("node", T.LongType()), T.StructField("dim", T.IntegerType()),
           T.StructField("cuts", T.ArrayType(T.DoubleType())), T.StructField("strict", T.BooleanType())]
    coarse = T.StructType([*gfields, *one, T.StructField("leaves", T.ArrayType(T.LongType())),
                           T.StructField("nested", T.ArrayType(T.StructType(one)))])
    cell = max(cell, leaf_size)
    cur = vectors.select(*g, "vid", *x, "cnt", F.lit(1).cast("long").alias("node"))
    split_tables, levels, cur_staged = [], 0, []
    probs = [i / FANOUT ** BUILD_LEVELS for i in range(1, FANOUT ** BUILD_LEVELS)]
    while n_vectors is None or n_vectors > cell:
        aggs = [F.count(F.lit(1)).alias("_n")]
        for i, c in enumerate(x):
            aggs += [F.min(c).alias(f"_mn{i}"), F.max(c).alias(f"_mx{i}"), F.percentile_approx(c, probs, 10_000).alias(f"_q{i}")]
        st = cur.groupBy(*g, "node").agg(*aggs).where(F.col("_n") > cell)
        spread = [F.col(f"_mx{i}") - F.col(f"_mn{i}") for i in range(len(x))]
        best = F.greatest(*spread) if len(x) > 1 else spread[0]
        dim = F.coalesce(*[F.when(s == best, F.lit(i)) for i, s in enumerate(spread)])
        st = st.select(*g, "node", dim.alias("dim"), *[c for c in st.columns if c not in (*g, "node")])
        st = st.select(*g, "node", "dim", _pick(F.col("dim"), [F.col(f"_q{i}") for i in range(len(x))]).alias("qs"),
                       _pick(F.col("dim"), [F.col(f"_mn{i}") for i in range(len(x))]).alias("low"))
        cuts, n_split = materialize(st.mapInPandas(_coarse_cuts(g, coarse), coarse), "kd-cuts", count=True)
        if n_split == 0:
            break
        if levels >= max_depth:
            raise RuntimeError(f"{n_split} nodes still hold more than {cell} vectors at depth {levels}")
        levels += BUILD_LEVELS
        split_tables.append(cuts.select(*g, F.explode("nested").alias("s")).select(*g, "s.*"))
        salted, table = _spread(cur, cuts.drop("nested"), "vid")
        xv = _pick(F.col("dim"), [F.col(c) for c in x])
        passed = F.size(F.filter("cuts", lambda c: F.when(F.col("strict"), xv > c).otherwise(xv >= c)))
        cur = salted.join(table, [*g, "node", "_s"], "left") \
            .select(*g, "vid", *x, "cnt", F.coalesce(F.get("leaves", passed), "node").alias("node"))
        cur, spent = materialize(cur, "kd-cells"), cur_staged
        release(*spent)
        cur_staged = [cur]
    fine = T.StructType([*gfields, *[T.StructField(c, vectors.schema[c].dataType) for c in ("vid", *x)], T.StructField("cnt", T.LongType()),
                         T.StructField("leaf", T.LongType()), T.StructField("beyond", T.LongType()), *one[1:]])
    cut = cur.withColumn("cnt", F.col("cnt").cast("long")).groupBy(*g, "node").applyInArrow(_finer(x, g, leaf_size, max_depth), fine)
    cut = materialize(cut, "kd-leaves")
    release(*cur_staged)
    vec = cut.where("vid is not null").select(*g, "vid", *x, "cnt", "leaf", *["beyond"][:beyond])
    all_splits = cut.where("vid is null").select(*g, F.col("leaf").alias("node"), "dim", "cuts", "strict")
    for s in split_tables:
        all_splits = all_splits.unionByName(s)
    leaf_box = vec.groupBy(*g, "leaf").agg(F.sum("cnt").alias("n"), F.count(F.lit(1)).alias("vectors"), *[F.min(c).alias(f"lo{i}") for i, c in enumerate(x)],
                                           *[F.max(c).alias(f"hi{i}") for i, c in enumerate(x)])
    # Every node's box = union of its leaves' boxes: explode each leaf into its ancestors.
    lvl = _depth(F.col("leaf"))
    anc = leaf_box.select("*", F.explode(F.sequence(F.lit(0), lvl)).alias("_up"))
    anc = anc.select(*g, F.expr(f"shiftright(leaf, _up * {LOG2_FANOUT})").alias("node"),
                     (F.col("_up") == 0).alias("_isleaf"), "n", "vectors",
                     *[f"lo{i}" for i in range(len(x))], *[f"hi{i}" for i in range(len(x))])
    boxes = anc.groupBy(*g, "node").agg(*[F.min(f"lo{i}").alias(f"lo{i}") for i in range(len(x))],
                                        *[F.max(f"hi{i}").alias(f"hi{i}") for i in range(len(x))],
                                        F.max(F.col("_isleaf").cast("int")).cast("boolean").alias("is_leaf"),
                                        F.sum("n").alias("n"), F.sum("vectors").alias("vectors"))
    boxes = materialize(boxes, "kd-boxes")
    depth, least, large, leaves = boxes.where("is_leaf").agg(
        F.max(_depth(F.col("node"))), F.min(F.when(F.col("node") > 1, F.col("n"))), F.count_if(F.col("vectors") > leaf_size),
        F.count(F.lit(1))).first()
    if large:
        raise RuntimeError(f"{large} nodes still hold more than {leaf_size} vectors at depth {max_depth}")
    return KdTree(vec, all_splits, boxes, g, x, depth or 0, leaf_size, least or leaf_size, leaves)


def descend(tree: KdTree, queries: DataFrame) -> DataFrame:
    """Leaf of each query (G..., qid, dims...) by following the stored cuts; adds ``leaf``."""
    g, x = tree.groups, tree.dims
    cur = queries.withColumn("leaf", F.lit(1).cast("long"))
    # They lie among the vectors: find them once, not once per level.
    splits = materialize(tree.splits, "kd-splits") if tree.depth else None
    for level in range(tree.depth):
        # Only this depth's cuts.
        s = splits.where(_depth(F.col("node")) == level).withColumnRenamed("node", "leaf")
        if level == 0:
            salted, roots = _spread(cur, s, "vid")
            j = salted.join(roots, [*g, "leaf", "_s"], "left").withColumnRenamed("leaf", "node")
        else:
            j = cur.join(s, [*g, "leaf"], "left").withColumnRenamed("leaf", "node")
        cur = j.select(*queries.columns,
                       F.when(F.col("dim").isNull(), F.col("node")).otherwise(_child(x)).alias("leaf"))
    return cur


NEAR = T.ArrayType(T.StructType([T.StructField("cid", T.LongType()), T.StructField("dist", T.DoubleType()),
                                 T.StructField("w", T.LongType())]))


#: A list moves as three binary columns, the values' bytes one after the other: Spark copies them whole.
PACKED = {"cid": np.dtype("<i8"), "dist": np.dtype("<f8"), "w": np.dtype("<i8")}
LIST_COLS = [*[T.StructField(f"_{f}", T.BinaryType()) for f in PACKED], T.StructField("_far", T.DoubleType()),
             T.StructField("_got", T.LongType())]


def _list_schema(queries: DataFrame, key_cols, carry) -> T.StructType:
    """One row per query: its task's key, id and carried columns, the nearest found (``PACKED``), the distance of the
    farthest of them and their rows, the distance of the k-th (``_r``, null where fewer rows were found) and k."""
    return T.StructType([*[queries.schema[c] for c in key_cols], T.StructField("qid", T.LongType()),
                         *[queries.schema[c] for c in carry], *LIST_COLS,
                         T.StructField("_r", T.DoubleType()), T.StructField("_k", T.LongType())])


def _near_column(cid, dist, w, counts) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    fields = [pa.field("cid", pa.int64()), pa.field("dist", pa.float64()), pa.field("w", pa.int64())]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays(
        [pa.array(cid, pa.int64()), pa.array(dist, pa.float64()), pa.array(w, pa.int64())], fields=fields))


def _packed(values: np.ndarray, counts: np.ndarray, kind: np.dtype) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(counts)]) * kind.itemsize
    if offsets[-1] >= 1 << 31:
        raise RuntimeError(f"neighbour lists of one task hold {offsets[-1]} bytes: fewer queries or a smaller k are needed")
    return pa.Array.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(offsets.astype(np.int32)),
                                                            pa.py_buffer(np.ascontiguousarray(values, kind))])


def _apart(*fields):
    """The columns of the lists that hold these fields."""
    return [f"_{f}" for f in fields]


def _near_rows(t: pa.Table, *fields) -> tuple[np.ndarray, ...]:
    """(list number, the fields) of the packed lists."""
    out, counts = [], [np.zeros(0, np.int64)]
    for f in fields:
        parts = [np.zeros(0, PACKED[f])]
        for a in t.column(f"_{f}").chunks:
            _, at, data = a.buffers()
            at = np.frombuffer(at, np.int32, len(a) + 1, 4 * a.offset) if len(a) else np.zeros(1, np.int32)
            if f == fields[0]:
                counts.append(np.diff(at) // PACKED[f].itemsize)
            if at[-1] > at[0]:
                parts.append(np.frombuffer(data, PACKED[f], (at[-1] - at[0]) // PACKED[f].itemsize, at[0]))
        out.append(np.concatenate(parts))
    return (np.repeat(np.arange(len(t)), np.concatenate(counts)), *out)


def _ids(t: pa.Table, name: str) -> np.ndarray:
    """An id column; a null id is the smallest long, which no vector of a tree has."""
    return t.column(name).fill_null(-1 << 63).to_numpy()


def _blocks(x: np.ndarray, size: int) -> list[np.ndarray]:
    """Row numbers in blocks of at most ``size`` near each other: halved at the median of the widest dimension."""
    todo, out = [np.arange(len(x))], []
    while todo:
        at = todo.pop()
        if len(at) <= size:
            out.append(at)
            continue
        v, half = x[at], len(at) // 2
        order = np.argpartition(v[:, int((v.max(axis=0) - v.min(axis=0)).argmax())], half)
        todo += [at[order[:half]], at[order[half:]]]
    return out


def _squared(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Squared distances of broadcast rows; the same summation order as the SQL oracle."""
    acc = 0.0
    for j in range(q.shape[-1]):
        d = q[..., j] - c[..., j]
        acc = acc + d * d
    return acc


def _kth(acc: np.ndarray, wts: np.ndarray, k: int) -> np.ndarray:
    """Per row of squared distances: the distance at which the rows' multiplicities reach k (inf: they do not)."""
    if acc.shape[1] > k + 1:
        at = np.argpartition(acc, k, axis=1)[:, :k + 1]
        acc, wts = np.take_along_axis(acc, at, 1), np.take_along_axis(wts, at, 1)
    order = np.argsort(acc, axis=1, kind="stable")
    acc, wts = np.take_along_axis(acc, order, 1), np.take_along_axis(wts, order, 1)
    enough = np.cumsum(wts, axis=1) >= k
    first = enough.argmax(axis=1)
    return np.where(enough.any(axis=1), np.sqrt(acc[np.arange(len(acc)), first]), np.inf)


def _top(rows, cid, dist, w, k):
    """The entries of each row in (rounded distance, id) order until their multiplicities add up to ``k``."""
    order = np.lexsort((cid, np.round(dist, TIE_DECIMALS), rows))
    rows, cid, dist, w = rows[order], cid[order], dist[order], w[order]
    before = np.cumsum(w) - w
    if len(rows):
        before -= before[np.searchsorted(rows, rows)]
    take = np.flatnonzero(before < k)
    return rows[take], cid[take], dist[take], np.minimum(w[take], k - before[take])


def _maybe_within(q: np.ndarray, c: np.ndarray, lim: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(query, candidate) row numbers of all pairs whose squared distance is at most ``lim`` of the query, and a few more.

    One product of matrices, in single precision where its error is small against the bounds.
    """
    qq, cc = (q * q).sum(axis=1), (c * c).sum(axis=1)
    most = qq.max() + cc.max()
    single = most < 1e30 and SINGLE * most <= lim.min() / 8
    over = qq - lim - (SINGLE if single else 1e-13) * (qq + cc.max())
    left = np.column_stack([-2 * q, np.ones(len(q)), over])
    right = np.vstack([c.T, cc, np.ones(len(c))])
    if single:
        left, right = left.astype(np.float32), right.astype(np.float32)
    with np.errstate(invalid="ignore"):
        far = left @ right > 0
    return np.divmod(np.flatnonzero(~far.ravel()), len(c))


def _nearest(C, cid, ccnt, Q, qid, qcnt, bound, k: int, self_mode: bool, skip=None):
    """(query row, cid, dist, w): each query's nearest candidates in (rounded distance, id) order until their
    multiplicities add up to k. In self mode a query's own vector counts cnt - 1 times (its other copies). ``bound``:
    farther candidates cannot enter a query's top k. ``skip``: (query rows, candidate rows) -> pairs to leave out.

    Candidates lie in small blocks, queries too: a block of queries looks at the candidate blocks whose boxes are within
    the bounds, which come from the nearest such blocks where there are none.
    """
    blocks = _blocks(C, BLOCK)
    sizes = np.array([len(b) for b in blocks])
    lo, hi = np.array([C[b].min(axis=0) for b in blocks]), np.array([C[b].max(axis=0) for b in blocks])
    out = []
    for at in _blocks(Q, QUERY_BLOCK):
        q, r = Q[at], bound[at].copy()
        free = np.flatnonzero(~np.isfinite(r))
        if len(free):
            low, high = q[free].min(axis=0), q[free].max(axis=0)
            gap = (np.maximum(0, np.maximum(lo - high, low - hi)) ** 2).sum(axis=1)
            apart = (((lo + hi) - (low + high)) ** 2).sum(axis=1)
            by = np.lexsort((apart, gap))
            near = np.concatenate([blocks[i] for i in by[:1 + np.searchsorted(np.cumsum(sizes[by]), max(k + 1, FIRST))]])
            wts = np.broadcast_to(ccnt[near], (len(free), len(near)))
            if self_mode:
                wts = wts - (qid[at[free]][:, None] == cid[near])
            r[free] = _kth(_squared(q[free][:, None], C[near][None]), wts, k)
        lim = (r + 2 * BOX_SLACK) ** 2
        # Blocks beyond the widest bound of the whole query block are ruled out first, by one box against each.
        apart = (np.maximum(0, np.maximum(lo - q.max(axis=0), q.min(axis=0) - hi)) ** 2).sum(axis=1)
        some = np.flatnonzero(~(apart > lim.max()))
        least = np.zeros((len(q), len(some)))
        for j in range(q.shape[1]):
            gap = lo[some, j] - q[:, j, None]
            np.maximum(gap, q[:, j, None] - hi[some, j], out=gap)
            np.maximum(gap, 0, out=gap)
            least += np.multiply(gap, gap, out=gap)
        meets = ~(least > lim[:, None])
        some, meets = some[meets.any(axis=0)], meets[:, meets.any(axis=0)]
        if not len(some):
            continue
        mid = q.mean(axis=0)
        pairs = []
        for b in range(0, len(some), PANEL):
            who = np.flatnonzero(meets[:, b:b + PANEL].any(axis=1))
            near = np.concatenate([blocks[i] for i in some[b:b + PANEL]])
            rows, c = _maybe_within(q[who] - mid, C[near] - mid, lim[who])
            pairs.append((who[rows], near[c]))
        rows, c = (np.concatenate(p) for p in zip(*pairs))
        dist = np.sqrt(_squared(q[rows], C[c]))
        wts = ccnt[c]
        if self_mode:
            wts = wts - (qid[at[rows]] == cid[c])
        keep = (wts > 0) & (dist <= r[rows] + 2 * BOX_SLACK)
        if skip:
            keep &= ~skip(at[rows], c)
        keep = np.flatnonzero(keep)
        rows, found, dist, wts = _top(rows[keep], cid[c[keep]], dist[keep], wts[keep], k)
        out.append((at[rows], found, dist, wts))
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64)
    rows, found, dist, wts = (np.concatenate(x) for x in zip(*out))
    order = np.argsort(rows, kind="stable")
    return rows[order], found[order], dist[order], wts[order]


def _lists(rows, cid, dist, w, n: int, k: int) -> dict:
    """``LIST_COLS`` and ``_r`` of ``n`` queries from entries sorted by query row."""
    counts = np.bincount(rows, minlength=n)
    most, got = np.full(n, -np.inf), np.bincount(rows, weights=w, minlength=n)
    np.maximum.at(most, rows, dist)
    return {f"_{f}": _packed(v, counts, kind) for (f, kind), v in zip(PACKED.items(), (cid, dist, w))} \
        | {"_far": pa.array(most, pa.float64(), mask=counts == 0), "_got": pa.array(got.astype(np.int64)),
           "_r": pa.array(most, pa.float64(), mask=got < k)}


def _search_kernel(dims, key_cols, carry, self_mode: bool, tables: int = 0):
    """applyInArrow function: rows with _role 0 = candidate, 1 = query, 2 = both -> a row per query (``_list_schema``).

    With ``tables``, rows have their buckets in all hash tables (``own``, ``beyond``), and a pair that met in a table
    before this one is left out.
    """
    def fn(t: pa.Table) -> pa.Table:
        role = t.column("_role").to_numpy()
        cand, qry = np.flatnonzero(role != 1), np.flatnonzero(role != 0)
        x = np.column_stack([t.column(c).to_numpy() for c in dims])
        ids, cnt = _ids(t, "vid"), t.column("cnt").to_numpy()
        n, k = len(qry), 0
        entries = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64)]
        if len(cand) and n:
            k = int(t.column("_k")[int(cand[0])].as_py())
            bound = t.column("_r").to_numpy()[qry].astype(np.float64)
            bound = np.where(np.isnan(bound), np.inf, bound)
            skip = None
            if tables:
                own, far = (t.column(c).combine_chunks().flatten().to_numpy().reshape(len(t), tables) for c in ("own", "far"))
                now = t.column("_t")[0].as_py()

                def skip(q, c):
                    a, b, met = own[cand[c], :now], qry[q], np.zeros(len(q), bool)
                    return met | (a == own[b, :now]).any(axis=1) | (a == far[b, :now]).any(axis=1)
            entries = _nearest(x[cand], ids[cand], cnt[cand], x[qry], ids[qry], cnt[qry], bound, k, self_mode, skip)
        found = _lists(*entries, n, k or 1)
        r = found.pop("_r")
        picked = t.take(pa.array(qry))
        return pa.table({c: picked.column(c) for c in key_cols} | {"qid": pa.array(ids[qry], pa.int64())}
                        | {c: picked.column(c) for c in carry} | found | {"_r": r, "_k": pa.array(np.full(n, k), pa.int64())})
    return fn


def _search_partitions(spark, cells: int = 0) -> int:
    """Partitions for the distance kernels: the work is CPU-bound and the rows are few,
    so size by task slots rather than by bytes (AQE would merge the small shuffle
    partitions into one task). An explicit count is never coalesced.

    A few per slot will do, and one per cell (leaf) where there are more: a partition without a cell still costs a
    Python worker's start and a file. No more than shuffles have."""
    slots = spark.sparkContext.defaultParallelism
    return min(max(slots, int(spark.conf.get("spark.sql.shuffle.partitions"))), max(SLOT_PARTITIONS * slots, cells))


def _search(tasks: DataFrame, key_cols, tree: KdTree, self_mode: bool, carry=(), tables: int = 0) -> DataFrame:
    fn = _search_kernel(tree.dims, key_cols, carry, self_mode, tables)
    n = _search_partitions(tasks.sparkSession, 2 * tree.leaves or QUERY_CHUNK)      # twice: fewer cells share a partition
    return tasks.repartition(n, *key_cols).groupBy(*key_cols).applyInArrow(fn, _list_schema(tasks, key_cols, carry))


def _merge_kernel(groups, cell_cols):
    """Cogroup function: the rows of a cell's queries and what other leaves found for them -> the merged lists."""
    def fn(own: pa.Table, other: pa.Table) -> pa.Table:
        qid = own.column("qid").to_numpy()
        k = int(own.column("_k")[0].as_py()) if len(own) else 0
        rows, cid, dist, w = _near_rows(own, "cid", "dist", "w")
        if len(other) and len(own):
            by = np.argsort(qid, kind="stable")
            theirs = by[np.searchsorted(qid[by], other.column("qid").to_numpy())]
            at, *more = _near_rows(other, "cid", "dist", "w")
            rows = np.concatenate([rows, theirs[at]])
            cid, dist, w = (np.concatenate(p) for p in zip((cid, dist, w), more))
            rows, cid, dist, w = _top(rows, cid, dist, w, k)
        found = _lists(rows, cid, dist, w, len(own), 1)
        found.pop("_r")
        return pa.table({c: own.column(c) for c in (*groups, *cell_cols, "qid")} | found
                        | {"names": pa.array([np.unique(cid)] + [None] * (len(own) - 1), pa.list_(pa.int64()))[:len(own)]})
    return fn


CELL_COLS = ["leaf", "_chunk"]       # with the group: the task that a query's list belongs to


def _merged(own: DataFrame, other: DataFrame, tree: KdTree, g) -> DataFrame:
    """(G..., leaf, _chunk, qid, LIST_COLS, names): lists of one row per query and cell, with what was found elsewhere. One row
    of each cell has the ids that the cell's lists name, once each (``names``, null on the others). The lists are staged,
    and what ``own`` was read from (a staged table) is released."""
    schema = T.StructType([*[own.schema[c] for c in (*g, *CELL_COLS, "qid")], *LIST_COLS, T.StructField("names", T.ArrayType(T.LongType()))])
    n = _search_partitions(own.sparkSession, tree.leaves)
    key = [*g, *CELL_COLS]
    a = own.select(*key, "qid", *_apart("cid", "dist", "w"), "_k").repartition(n, *key)
    b = other.where(F.col("_got") > 0).select(*g, F.col("_own").alias("leaf"), F.col("_ownchunk").alias("_chunk"), "qid",
                                               *_apart("cid", "dist", "w")).repartition(n, *key)
    lists = materialize(a.groupBy(*key).cogroup(b.groupBy(*key)).applyInArrow(_merge_kernel(g, CELL_COLS), schema), "knn-lists")
    release(own)
    return lists


def entries(lists: DataFrame, g, *cols) -> DataFrame:
    """The packed lists as neighbour rows (G..., qid, cols, cid, dist, w)."""
    own = [*g, "qid", *cols]
    out = T.StructType([*[lists.schema[c] for c in own], *NEAR.elementType.fields])

    def fn(batches):
        for b in batches:
            t = pa.Table.from_batches([b])
            rows, *found = _near_rows(t, *PACKED)
            picked = t.select(own).take(pa.array(rows))
            yield from pa.table({c: picked.column(c) for c in own} | dict(zip(PACKED, map(pa.array, found)))).to_batches()

    return lists.select(*own, *_apart(*PACKED)).mapInArrow(fn, out)


def _unpacked(lists: DataFrame) -> DataFrame:
    """The lists with ``near``, an array of (cid, dist, w), for their packed columns."""
    own = [c for c in lists.columns if c not in [f.name for f in LIST_COLS]]

    def fn(batches):
        for b in batches:
            t = pa.Table.from_batches([b])
            rows, *found = _near_rows(t, *PACKED)
            yield from pa.table({c: t.column(c) for c in own} | {"near": _near_column(*found, np.bincount(rows, minlength=len(t)))}).to_batches()

    out = lists.select(*own, *_apart(*PACKED)).mapInArrow(fn, T.StructType([*[lists.schema[c] for c in own], T.StructField("near", NEAR)]))
    out.spent = [lists, *lists.__dict__.get("spent", [])]
    return out


def _landings(tree: KdTree, need: int) -> DataFrame:
    """(G..., _own, leaf): for each leaf with fewer than ``need`` rows, the other leaves of a node near it that holds so
    many: from the nearest ancestor that does, down by the nearest child that still does. Small tables: a few rows per
    such leaf."""
    g, d = tree.groups, range(len(tree.dims))
    boxes = tree.boxes
    corner = [f"{e}{i}" for i in d for e in ("lo", "hi")]
    own = boxes.where(F.col("is_leaf") & (F.col("node") > 1) & (F.col("n") < need)) \
        .select(*g, F.col("node").alias("_own"), *[F.col(c).alias(f"own_{c}") for c in corner])
    up = own.withColumn("_up", F.explode(F.sequence(F.lit(1), _depth(F.col("_own"))))) \
        .withColumn("node", F.expr(f"shiftright(_own, _up * {LOG2_FANOUT})"))
    held = up.join(boxes.where(F.col("n") >= need).select(*g, "node"), [*g, "node"])
    # Node ids grow with depth. A group that was cut holds more than a leaf, so its root qualifies.
    cur = held.groupBy(*g, "_own", *[f"own_{c}" for c in corner]).agg(F.max("node").alias("node"))
    kids = boxes.where((F.col("n") >= need) & (F.col("node") > 1)) \
        .select(*g, F.shiftright("node", LOG2_FANOUT).alias("node"), F.col("node").alias("_kid"), *corner)
    gaps = [F.greatest(F.lit(0.0), F.col(f"lo{i}") - F.col(f"own_hi{i}"), F.col(f"own_lo{i}") - F.col(f"hi{i}")) for i in d]
    gap = sum((x * x for x in gaps[1:]), gaps[0] * gaps[0])
    for _ in range(tree.depth):
        nearest = F.min_by("_kid", F.struct(gap, "_kid"))
        cur = cur.join(kids, [*g, "node"], "left").groupBy(*g, "_own", "node", *[f"own_{c}" for c in corner]) \
            .agg(nearest.alias("_kid")) \
            .select(*g, "_own", F.coalesce("_kid", "node").alias("node"), *[f"own_{c}" for c in corner])
    below = boxes.where("is_leaf").select(*g, F.col("node").alias("leaf"), F.explode(F.sequence(F.lit(0), _depth(F.col("node")))).alias("_up")) \
        .withColumn("node", F.expr(f"shiftright(leaf, _up * {LOG2_FANOUT})"))
    return cur.select(*g, "_own", "node").join(below, [*g, "node"]).where(F.col("leaf") != F.col("_own")).select(*g, "_own", "leaf")


def _mindist(dims) -> F.Column:
    acc = None
    for i, c in enumerate(dims):
        gap = F.greatest(F.lit(0.0), F.col(f"lo{i}") - F.col(c), F.col(c) - F.col(f"hi{i}"))
        acc = gap * gap if acc is None else acc + gap * gap
    return F.sqrt(acc)


def merge_topk(rows: DataFrame, groups, k_col: str = "_k", keep_k: bool = False) -> DataFrame:
    """Global top-k per query from partial lists: the same (rounded dist, id) order."""
    from pyspark.sql import Window
    w = Window.partitionBy(*groups, "qid").orderBy(F.round("dist", TIE_DECIMALS), "cid")
    before = F.coalesce(F.sum("w").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    r = rows.withColumn("_before", before)
    r = r.where(F.col("_before") < F.col(k_col))
    return r.select(*groups, "qid", "cid", "dist",
                    F.least(F.col("w"), F.col(k_col) - F.col("_before")).cast("long").alias("w"),
                    *[k_col][:keep_k])


def knn(tree: KdTree, queries: DataFrame, k: int | None = None, self_mode: bool = False, most_k: int = 1 << 30) -> DataFrame:
    """Neighbour rows (G..., qid, cid, dist, w) of ``knn_lists``."""
    return entries(packed_lists(tree, queries, k, self_mode, most_k), tree.groups)


def knn_lists(tree: KdTree, queries: DataFrame, k: int | None = None, self_mode: bool = False, most_k: int = 1 << 30) -> DataFrame:
    """``packed_lists`` with each list as one array ``near`` of (cid, dist, w)."""
    return _unpacked(packed_lists(tree, queries, k, self_mode, most_k))


def packed_lists(tree: KdTree, queries: DataFrame, k: int | None = None, self_mode: bool = False, most_k: int = 1 << 30) -> DataFrame:
    """One row (G..., leaf, _chunk, qid, LIST_COLS[, names]) per query (G..., vid, dims..., cnt[, leaf]) with its
    neighbours, nearest first; leaf and chunk name the task that searched it. A staged table, which the caller may
    release, as the staged tables in its ``spent`` (if there was a walk).

    In self mode the queries are the tree's own vectors (their copies count as
    neighbours, themselves not) and a group of at most ``k`` rows gives all its others. Without
    ``k`` the tree's vectors carry their group's own ``_k``, at most ``most_k``, as a fitted reference does. Either
    way the rows bring k along, so nothing is joined by the group alone.
    """
    g, x = tree.groups, tree.dims
    cands = tree.vectors if k is None else tree.vectors.withColumn("_k", F.lit(k).cast("long"))
    placed = []
    if self_mode:
        first = cands.withColumn("_role", F.lit(2)).withColumn("_r", F.lit(None).cast("double")).withColumn("_chunk", F.lit(0))
        r1 = _search(first, [*g, *CELL_COLS], tree, True, [*x, "cnt"])
    else:
        if "leaf" not in queries.columns:
            queries = materialize(descend(tree, queries), "knn-queries")
            placed = [queries]
        r1 = _search_chunked(cands, queries, tree, carry=[*x, "cnt"])
    # Used by the bound, the walk and the final merge: materialise once.
    r1 = materialize(r1, "knn-r1")
    release(*placed)
    # Radius bound per query: the k-th distance in its own leaf, if that holds enough.
    qb = r1.select(*g, "qid", *x, "cnt", F.col("leaf").alias("_own"), F.col("_chunk").alias("_ownchunk"), "_r")
    most = most_k if k is None else k
    if tree.least <= most:
        # Where it does not, the leaves near it are searched for a bound as well.
        short = qb.where("_r is null").join(_landings(tree, most + 1), [*g, "_own"])
        near = _search_chunked(cands, short.select(*g, F.col("qid").alias("vid"), *x, "cnt", "leaf"), tree)
        both = entries(near, g, "_k").unionByName(entries(r1.where("_r is null"), g, "_k"))
        wide = merge_topk(both, g, keep_k=True).groupBy(*g, "qid") \
            .agg(F.max("dist").alias("_wide"), F.sum("w").alias("_got"), F.first("_k").alias("_k")) \
            .where("_got >= _k").drop("_got", "_k")
        qb = qb.join(wide, [*g, "qid"], "left").withColumn("_r", F.coalesce("_r", "_wide")).drop("_wide")
    # A group that was not cut has no other leaf to search.
    qb = qb.withColumn("_r", F.coalesce("_r", F.lit(float("inf"))))
    # Walk the tree from the root, PASS_LEVELS levels per join, keeping nodes whose box is within the bound. A
    # leaf also has itself as a "child", so reached leaves ride along and every step is exactly one join of
    # the previous frontier (a linear plan, no branch re-use).
    boxes = tree.boxes.withColumn("_depth", _depth(F.col("node"))) \
        .withColumn("_from", (F.floor((F.col("_depth") - 1) / PASS_LEVELS) * PASS_LEVELS).cast("int"))
    kids = boxes.where((F.col("node") > 1) & (F.col("is_leaf") | (F.col("_depth") % PASS_LEVELS == 0))) \
        .withColumn("_parent", F.expr(f"shiftright(node, (_depth - _from) * {LOG2_FANOUT})")) \
        .unionByName(boxes.where(F.col("is_leaf")).withColumn("_parent", F.col("node")))
    # Queries whose own leaf is the root have nowhere else to look.
    frontier = qb.where(F.col("_own") != 1).withColumn("node", F.lit(1).cast("long")).withColumn("is_leaf", F.lit(False))
    # The box table is small and joined by broadcast, so the walk keeps the frontier's
    # partitioning: spread the queries over all task slots first.
    frontier = frontier.repartition(_search_partitions(queries.sparkSession, tree.leaves), *g, "qid")
    for level in range(0, tree.depth, PASS_LEVELS):
        # Nodes of this step plus leaves already reached: at the top this table is tiny while every query
        # shares the same node key.
        lk = kids.where(((F.col("_parent") != F.col("node")) & (F.col("_from") == level))
                        | ((F.col("_parent") == F.col("node")) & (F.col("_depth") <= level)))
        if level == 0:
            f, b = (d.alias(a) for d, a in zip(_spread(frontier, lk, "qid"), "fb"))
        else:
            f, b = frontier.alias("f"), lk.alias("b")
        cond = [F.col(f"f.{c}") == F.col(f"b.{c}") for c in g] + [F.col("f.node") == F.col("b._parent")]
        cond += [F.col("f._s") == F.col("b._s")] if level == 0 else []
        j = f.join(b, cond, "inner")
        j = j.select(*[F.col(f"f.{c}").alias(c) for c in g], "f.qid", *[F.col(f"f.{c}") for c in x], "f.cnt",
                     "f._own", "f._ownchunk", "f._r", F.col("b.node").alias("node"), "b.is_leaf",
                     *[F.col(f"b.lo{i}") for i in range(len(x))], *[F.col(f"b.hi{i}") for i in range(len(x))])
        j = j.where(_mindist(x) <= F.col("_r") + F.lit(BOX_SLACK))
        frontier = j.select(*g, "qid", *x, "cnt", "_own", "_ownchunk", "_r", "node", "is_leaf")
    if tree.depth == 0:
        return r1.select(*g, *CELL_COLS, "qid", *[f.name for f in LIST_COLS])
    # Each query's vector goes along: (query, leaf) pairs are what the search reads.
    other = frontier.where(F.col("is_leaf") & (F.col("node") != F.col("_own"))) \
        .select(*g, F.col("qid").alias("vid"), *x, "cnt", "_own", "_ownchunk", F.col("node").alias("leaf"), "_r")
    other = materialize(other, "knn-walk")
    lists = _merged(r1, _search_chunked(cands, other, tree, known=True, carry=["_own", "_ownchunk"]), tree, g)
    lists.spent = [other]
    return lists


def _search_chunked(cands: DataFrame, queries: DataFrame, tree: KdTree, known: bool = False, carry=(), tables: int = 0) -> DataFrame:
    """Search task per (G, leaf, chunk): the leaf's vectors and at most QUERY_CHUNK queries. ``known``: the tree has all
    of the queries' leaves. ``carry``: columns of the queries that stay on their rows."""
    g, x = tree.groups, tree.dims
    qcount = queries.groupBy(*g, "leaf").agg(F.count(F.lit(1)).alias("_nq"))
    nchunks = F.greatest(F.lit(1), F.ceil(F.col("_nq") / F.lit(QUERY_CHUNK))).cast("int")
    # Queries of a group that the tree does not have meet no vectors: they get no rows.
    held = qcount if known else qcount.join(cands.select(*g, "leaf").distinct(), [*g, "leaf"])
    chunks = held.select(*g, "leaf", nchunks.alias("_nc"))
    q = queries.join(chunks, [*g, "leaf"]).withColumn(
        "_chunk", F.pmod(F.xxhash64("vid"), F.col("_nc").cast("long")).cast("int"))
    c = cands.join(chunks, [*g, "leaf"]).withColumn(
        "_chunk", F.explode(F.sequence(F.lit(0), F.col("_nc") - 1)))
    cols = [*g, *CELL_COLS, "vid", *x, "cnt", *["own", "far"][:2 * bool(tables)]]
    rest = [n for n in carry if n not in cols]
    qr = F.col("_r") if "_r" in q.columns else F.lit(None).cast("double")
    tasks = c.select(*cols, *[F.lit(None).cast(q.schema[n].dataType).alias(n) for n in rest], "_k",
                     F.lit(None).cast("double").alias("_r"), F.lit(0).alias("_role")) \
             .unionByName(q.select(*cols, *rest, F.lit(None).cast("long").alias("_k"), qr.alias("_r"), F.lit(1).alias("_role")))
    return _search(tasks, [*g, *CELL_COLS], tree, False, carry, tables)


def approximate_knn(vectors: DataFrame, groups, dims, k: int, tables: int = 4, leaf_size: int = 1024, seed: int = 17,
                    n_vectors: int | None = None) -> DataFrame:
    """Neighbour rows (G..., qid, cid, dist, w) of ``approximate_knn_lists``."""
    return entries(packed_approximate_lists(vectors, groups, dims, k, tables, leaf_size, seed, n_vectors), list(groups))


def approximate_knn_lists(vectors: DataFrame, groups, dims, k: int, tables: int = 4, leaf_size: int = 1024, seed: int = 17,
                          n_vectors: int | None = None) -> DataFrame:
    """``packed_approximate_lists`` with each list as one array ``near`` of (cid, dist, w)."""
    return _unpacked(packed_approximate_lists(vectors, groups, dims, k, tables, leaf_size, seed, n_vectors))


def packed_approximate_lists(vectors: DataFrame, groups, dims, k: int, tables: int = 4, leaf_size: int = 1024, seed: int = 17,
                             n_vectors: int | None = None) -> DataFrame:
    """Rows as ``packed_lists`` gives in self mode, found by random-projection hash tables.

    A table projects the vectors on a random orthonormal basis (the first on their own axes) and cuts them at medians,
    so a bucket is a leaf and holds at most ``leaf_size`` vectors whatever the skew. Each vector searches, in each
    table, its own bucket and the one beyond the nearest cut on its way (its second probe). Its own bucket of the first
    table comes first and bounds all the others, which are searched in one pass and give only pairs that have not met
    in a table before: what is moved stays near one list per vector. There is no walk. A vector may get fewer than
    ``k`` neighbours where its buckets hold fewer.
    """
    g, x = list(groups), list(dims)
    rng = np.random.default_rng(seed)
    bases = [np.eye(len(x)), *[np.linalg.qr(rng.normal(size=(len(x), len(x))))[0] for _ in range(tables - 1)]]
    y = [f"_y{i}" for i in range(len(x))]

    def along(axis):
        parts = [F.col(c) * float(a) for c, a in zip(x, axis)]
        return sum(parts[1:], parts[0])

    turned = F.explode(F.array(*[F.struct(F.lit(i).alias("_t"), *[along(b[:, j]).alias(y[j]) for j in range(len(x))])
                                 for i, b in enumerate(bases)]))
    spread = vectors.select(*g, "vid", "cnt", turned.alias("_s")).select(*g, "_s.*", "vid", "cnt")
    tg = [*g, "_t"]
    tree = build_tree(spread, tg, y, leaf_size, n_vectors=n_vectors and n_vectors * tables, beyond=True)
    # A row per vector with its buckets in all tables; distances are taken in the original coordinates.
    spots = tree.vectors.groupBy(*g, "vid").agg(F.sort_array(F.collect_list(F.struct("_t", "leaf", "beyond"))).alias("_b"))
    placed = spots.select(*g, "vid", F.col("_b.leaf").alias("own"), F.col("_b.beyond").alias("far")) \
        .join(vectors.select(*g, "vid", *x, "cnt"), [*g, "vid"])
    placed = materialize(placed.withColumn("_k", F.lit(k).cast("long")), "knn-buckets")
    tree = KdTree(placed, tree.splits, tree.boxes, tg, x, tree.depth, leaf_size, tree.least, tree.leaves)
    rows = [*g, "vid", *x, "cnt", "own", "far"]
    first = placed.select(*rows, "_k", F.lit(0).alias("_t"), F.get("own", F.lit(0)).alias("leaf"), F.lit(0).alias("_chunk"),
                          F.lit(2).alias("_role"), F.lit(None).cast("double").alias("_r"))
    r1 = materialize(_search(first, [*g, *CELL_COLS], tree, True, [*x, "cnt", "own", "far"]), "knn-r1")
    visits = F.filter(F.flatten(F.array(*[F.array(*[F.struct(F.lit(i).alias("_t"), F.get(c, F.lit(i)).alias("leaf"))
                                                    for c in ("own", "far")[i == 0:]]) for i in range(tables)])), lambda v: v["leaf"] >= 0)
    probes = r1.select(*g, F.col("qid").alias("vid"), *x, "cnt", "own", "far", "_r", F.col("leaf").alias("_own"),
                       F.col("_chunk").alias("_ownchunk"), F.explode(visits).alias("_v")) \
        .select("*", "_v._t", "_v.leaf").drop("_v")
    buckets = placed.select(*rows, "_k", F.posexplode("own").alias("_t", "leaf"))
    found = _search_chunked(buckets, probes, tree, known=True, carry=["_own", "_ownchunk"], tables=tables)
    lists = _merged(r1, found, tree, g)
    release(placed)
    return lists
