"""Parts shared by the two vector operators: clean vectors, sampled centroids, pruned graphs, beam search."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SAMPLE_VALUES = 2_000_000       # most numbers of the sample that centroids are fitted on
SAMPLE_ROWS = 20_000
CLUSTER_MOST = 2_000
DEGREE = 24
ALPHA = 1.2


def clean(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(id, v): rows with an id whose vector has no null or non-finite component and is not all zero."""
    fine = "forall(v, x -> x is not null and not isnan(x) and abs(x) < double('inf')) and exists(v, x -> x <> 0)"
    return df.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("v")) \
        .where("id is not null and v is not null").where(fine)


def by_length(vectors: DataFrame) -> list[DataFrame]:
    """``vectors`` in one frame per length, the most frequent one first (an empty frame if there is none). A cosine is
    defined between vectors of one length only, so each length is a table of its own."""
    counts = vectors.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).collect()   # one row per length
    return [vectors.where(F.size("v") == r["n"]) for r in counts] or [vectors]


def matrix(column, kind=np.float64) -> np.ndarray:
    """Rows of an Arrow list column, all of one length, as numbers of ``kind``."""
    flat = column.combine_chunks() if hasattr(column, "combine_chunks") else column
    values = np.asarray(flat.flatten(), kind)
    return values.reshape(len(flat), len(values) // max(1, len(flat)))


def unit(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1 (through their largest component, so that squares stay finite)."""
    if not x.size:
        return x
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def sample(vectors: DataFrame, seed: int = 7) -> np.ndarray:
    """Unit vectors of the rows with the smallest hashes: ``SAMPLE_ROWS`` or ``SAMPLE_VALUES`` numbers at most."""
    first = vectors.select(F.size("v").alias("n")).first()
    if not first:
        return np.empty((0, 1))
    most = max(1, min(SAMPLE_ROWS, SAMPLE_VALUES // max(1, first["n"])))
    got = vectors.select(F.xxhash64(F.lit(seed), "id").alias("h"), "id", "v").orderBy("h", "id").limit(most).toArrow()
    return unit(matrix(got.column("v")))


def centroids(x: np.ndarray, k: int, rounds: int = 8, seed: int = 7) -> np.ndarray:
    """Spherical k-means; a cluster that runs empty restarts at the vector worst served."""
    if not len(x):
        return x
    k = max(1, min(k, len(x)))
    c = x[np.random.default_rng(seed).permutation(len(x))[:k]]
    for _ in range(rounds):
        best, near = np.empty(len(x)), np.empty(len(x), np.int64)
        for i in range(0, len(x), 4096):
            s = x[i:i + 4096] @ c.T
            near[i:i + 4096], best[i:i + 4096] = s.argmax(axis=1), s.max(axis=1)
        total = np.zeros_like(c)
        np.add.at(total, near, x)
        empty = np.flatnonzero(np.bincount(near, minlength=k) == 0)
        total[empty] = x[np.argsort(best, kind="stable")[:len(empty)]]
        norm = np.sqrt((total * total).sum(axis=1, keepdims=True))
        c = np.where(norm > 1e-12, total / np.maximum(norm, 1e-12), c)
    return c


def pruned_graph(x: np.ndarray, degree: int = DEGREE, alpha: float = ALPHA, pool: int = 64) -> np.ndarray:
    """(rows, degree) neighbour numbers, -1 where there are fewer.

    Robust pruning: take the nearest candidate, then drop the candidates that it is nearer to
    than the node by a factor of ``alpha``, and so on.
    """
    n = len(x)
    graph = np.full((n, degree), -1, np.int64)
    pool = min(pool, n - 1)
    if pool <= 0:
        return graph
    for i in range(0, n, 512):
        own = np.arange(i, min(n, i + 512))
        s = x[own] @ x.T
        s[np.arange(len(own)), own] = -2
        cand = np.argpartition(-s, pool - 1, axis=1)[:, :pool]
        near = np.take_along_axis(s, cand, axis=1)
        order = np.argsort(-near, axis=1, kind="stable")
        cand, near = np.take_along_axis(cand, order, axis=1), np.take_along_axis(near, order, axis=1)
        dist = np.sqrt(np.maximum(0, 2 - 2 * near))
        live = np.ones(cand.shape, bool)
        vec = x[cand]
        for slot in range(degree):
            some = live.any(axis=1)
            if not some.any():
                break
            first = live.argmax(axis=1)
            row = np.arange(len(own))
            pick = cand[row, first]
            graph[own[some], slot] = pick[some]
            between = np.sqrt(np.maximum(0, 2 - 2 * np.einsum("rcd,rd->rc", vec, x[pick])))
            live &= alpha * between > dist
            live[row, first] = False
    return graph


def with_reverse(graph: np.ndarray) -> list[np.ndarray]:
    """Neighbours of each row, links in both directions."""
    a, slot = np.nonzero(graph >= 0)
    b = graph[a, slot]
    both = np.unique(np.concatenate([a * len(graph) + b, b * len(graph) + a]))
    return np.split(both % len(graph), np.searchsorted(both // len(graph), np.arange(1, len(graph))))


def padded(neighbours: list[np.ndarray]) -> np.ndarray:
    width = max(1, max(map(len, neighbours), default=1))
    out = np.full((len(neighbours), width), -1, np.int64)
    for i, v in enumerate(neighbours):
        out[i, :len(v)] = v
    return out


def beam_search(queries: np.ndarray, x: np.ndarray, graph: np.ndarray, starts: np.ndarray, beam: int = 32,
                reach: float = 2.0, step: int = 4) -> np.ndarray:
    """(queries, rows) similarities of the nodes visited, -2 for the others.

    Greedy search from ``starts``: of the ``beam`` nearest nodes seen, the nearest not yet
    expanded are expanded until none is left. Nodes at least ``reach`` similar are expanded as well,
    however many: the search widens over the whole range.
    """
    q, n = len(queries), len(x)
    seen = np.full((q, n), -2.0)
    todo = np.zeros((q, n), bool)           # seen, not expanded
    if not q or not n:
        return seen
    seen[:, starts] = queries @ x[starts].T
    todo[:, starts] = True
    beam = min(beam, n)
    while True:
        bar = np.partition(seen, n - beam, axis=1)[:, n - beam]
        open_ = np.where(todo & (seen >= bar[:, None]), seen, -3.0)
        best = np.argpartition(-open_, min(step, n) - 1, axis=1)[:, :step]
        rows, slot = np.nonzero(np.take_along_axis(open_, best, axis=1) > -3)
        node = best[rows, slot]
        in_range = np.nonzero(todo & (seen >= reach))
        rows, node = np.concatenate([rows, in_range[0]]), np.concatenate([node, in_range[1]])
        if not len(rows):
            return seen
        todo[rows, node] = False
        for i in range(0, len(rows), 1 << 15):
            r = np.repeat(rows[i:i + (1 << 15)], graph.shape[1])
            v = graph[node[i:i + (1 << 15)]].reshape(-1)
            fresh = v >= 0
            r, v = r[fresh], v[fresh]
            fresh = seen[r, v] == -2
            pair = np.unique(r[fresh] * n + v[fresh])
            r, v = pair // n, pair % n
            for j in range(0, len(r), 1 << 15):
                a, b = r[j:j + (1 << 15)], v[j:j + (1 << 15)]
                seen[a, b] = np.maximum((queries[a] * x[b]).sum(axis=1), -1.5)
                todo[a, b] = True
