"""Embedding near-dedup on a robust-pruned flat graph, built on overlapping cluster shards.

1. Equal vectors become one node with a weight. Centroids are fitted on a bounded sample, and
   every node joins the shards of its ``OVERLAP`` nearest centroids. A cluster above
   ``SHARD`` nodes is dealt by hash into blocks, so no task holds more than two blocks.
2. Each block builds a robust-pruned graph over its nodes. A node's adjacency lists from all its
   blocks are united.
3. Each node is searched from the medoid of every shard that it is in, on the united graph: greedy beam
   search that goes on over every node at or above the threshold, so a group of any size is found
   whole. Blocks of one cluster are searched two by two.
4. What the search visits is verified by cosine in double precision. A pair that meets in
   several shards counts in the first one that both are in. Each task returns one row per node:
   how many links it has there and its component within the task, so links are counted and
   joined without being listed.
5. ``audit`` compares the links found with brute force for a sample of vectors against all. Below
   ``RECALL`` the index is built again with twice the overlap.

Cases: null or zero vectors and those with null or non-finite components link with nothing. Vectors link with
those of their own length only; each length has an index of its own. Rows with equal ids are one vector each. A null id has
component null and is kept. Equal vectors are linked with each other. An empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize, release
from .components import components
from .vectors import CLUSTER_MOST, beam_search, by_length, centroids, clean, matrix, padded, pruned_graph, sample, unit

THRESHOLD = 0.95
OVERLAP = 4
PER_CLUSTER = 250
SHARD = 1500
BEAM = 24
RECALL = 0.97
AUDITED = 200           # vectors


def nodes_of(vectors: DataFrame) -> DataFrame:
    """(node, v, weight): distinct vectors, named by their smallest id."""
    return vectors.groupBy("v").agg(F.min("id").alias("node"), F.count("*").alias("weight"))


def dealt(nodes: DataFrame, overlap: int = OVERLAP) -> DataFrame:
    """(cluster, part, parts, node, weight, v, homes): each node in each of its shards."""
    n = nodes.count()
    centre = centroids(sample(nodes.withColumnRenamed("node", "id")), min(CLUSTER_MOST, max(1, n // PER_CLUSTER)))
    if not len(centre):
        centre = np.zeros((1, 1))       # no vectors, nothing to assign
    most = min(overlap, len(centre))

    def assign(batches):
        for b in batches:
            near = np.empty((b.num_rows, most), np.int32)
            for i in range(0, b.num_rows, 1024):
                part = b.slice(i, 1024)
                s = unit(matrix(part.column("v"))) @ centre.T
                near[i:i + 1024] = np.sort(np.argpartition(-s, most - 1, axis=1)[:, :most], axis=1)
            homes = pa.ListArray.from_arrays(np.arange(0, near.size + 1, most, dtype=np.int32), pa.array(near.reshape(-1)))
            yield pa.RecordBatch.from_arrays([b.column("node"), b.column("weight"), b.column("v"), homes],
                                             names=["node", "weight", "v", "homes"])

    kind = nodes.schema["v"].dataType.simpleString()
    homes = nodes.select("node", "weight", "v").mapInArrow(assign, f"node long, weight long, v {kind}, homes array<int>")
    homes = materialize(homes, "graph-homes")
    sizes = homes.select(F.explode("homes").alias("cluster")).groupBy("cluster") \
        .agg(F.ceil(F.count("*") / SHARD).cast("int").alias("parts"))
    return homes.withColumn("cluster", F.explode("homes")).join(sizes, "cluster") \
        .withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))


def adjacency(shards: DataFrame) -> DataFrame:
    """(node, near): united neighbour lists, at most degree times overlap long."""
    def build(t: pa.Table) -> pa.Table:
        order = np.argsort(t.column("node").to_numpy(), kind="stable")
        node = t.column("node").to_numpy()[order]
        graph = pruned_graph(unit(matrix(t.column("v")))[order])
        a, slot = np.nonzero(graph >= 0)
        b = graph[a, slot]
        both = np.unique(np.stack([np.r_[a, b], np.r_[b, a]], axis=1), axis=0)
        cuts = np.searchsorted(both[:, 0], np.arange(len(node) + 1)).astype(np.int32)
        return pa.table({"node": node, "near": pa.ListArray.from_arrays(cuts, pa.array(node[both[:, 1]]))})

    lists = shards.select("cluster", "part", "node", "v").groupBy("cluster", "part").applyInArrow(build, "node long, near array<long>")
    return lists.groupBy("node").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near"))


def _local_components(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest reachable number for each of ``n`` numbers."""
    label = np.arange(n)
    while True:
        new = label.copy()
        np.minimum.at(new, a, label[b])
        np.minimum.at(new, b, label[a])
        new = new[new]
        if (new == label).all():
            return label
        label = new


def linked(shards: DataFrame, near: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(node, n, root): links found in each task (weights of the other ends), component within it."""
    def search(t: pa.Table) -> pa.Table:
        i, j, cluster = (t.column(c)[0].as_py() for c in ("i", "j", "cluster"))
        order = np.argsort(t.column("node").to_numpy(), kind="stable")
        t = t.take(pa.array(order))
        node, part, weight = (t.column(c).to_numpy() for c in ("node", "part", "weight"))
        x = unit(matrix(t.column("v")))
        homes = [set(h) for h in t.column("homes").to_pylist()]
        lists = t.column("near").combine_chunks()
        flat = lists.flatten().to_numpy()
        at = np.searchsorted(node, flat)
        at[at == len(node)] = 0
        at = np.where(node[at] == flat, at, -1)
        cuts = np.r_[0, np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))]
        left, right = np.flatnonzero(part == i), np.flatnonzero(part == j)
        if not len(left) or not len(right):
            return pa.table({"node": pa.array([], pa.int64()), "n": pa.array([], pa.int64()), "root": pa.array([], pa.int64())})
        place = np.full(len(node), -1)
        place[right] = np.arange(len(right))
        graph = []
        for r in right:
            v = at[cuts[r]:cuts[r + 1]]
            v = place[v[v >= 0]]
            graph.append(v[v >= 0])
        medoid = np.array([(x[right] @ x[right].mean(axis=0)).argmax()])
        n, ends = np.zeros(len(node), np.int64), []
        graph = padded(graph)
        for k in range(0, len(left), 512):
            own = left[k:k + 512]
            found = beam_search(x[own], x[right], graph, medoid, BEAM, reach=threshold - 1e-9)
            a, b = np.nonzero(found >= threshold)
            ends.append(np.stack([own[a], right[b]]))
        a, b = np.concatenate(ends, axis=1)
        a, b = a[a != b], b[a != b]
        key = np.unique(np.minimum(a, b) * len(node) + np.maximum(a, b))       # found from either end
        a, b = key // len(node), key % len(node)
        first = np.array([min(homes[p] & homes[q]) == cluster for p, q in zip(a.tolist(), b.tolist())], bool)
        a, b = a[first], b[first]
        np.add.at(n, a, weight[b])
        np.add.at(n, b, weight[a])
        label = _local_components(len(node), a, b)
        keep = np.flatnonzero(n)
        return pa.table({"node": node[keep], "n": n[keep], "root": node[label[keep]]})

    rows = shards.join(near, "node").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))) \
        .select("cluster", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"),
                "part", "node", "weight", "v", "homes", "near")
    return rows.groupBy("cluster", "i", "j").applyInArrow(search, "node long, n long, root long")


def near_duplicates(df: DataFrame, threshold: float = THRESHOLD, id_col: str = "vec_id", vec_col: str = "embedding",
                    overlap: int = OVERLAP) -> DataFrame:
    """(vec_id, n_links, component_id, kept) per row of ``df``."""
    parts = [_members(vectors, threshold, overlap) for vectors in by_length(clean(df, id_col, vec_col))]
    members = parts[0]
    if len(parts) > 1:      # an id may have rows of several lengths
        members = reduce(DataFrame.unionByName, parts).groupBy("id") \
            .agg(F.max("n_links").alias("n_links"), F.min("component").alias("component"))
    return df.select(F.col(id_col).cast("long").alias("id")).join(members, "id", "left") \
        .select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                F.coalesce("component", "id").alias("component_id")) \
        .withColumn("kept", F.coalesce(F.col(id_col) == F.col("component_id"), F.lit(True)))


def _members(vectors: DataFrame, threshold: float, overlap: int) -> DataFrame:
    """(id, n_links, component) of vectors of one length, staged."""
    nodes = materialize(nodes_of(vectors), "graph-nodes")
    while True:
        shards = materialize(dealt(nodes, overlap), "graph-shards")
        near = materialize(adjacency(shards), "graph-near")
        found = materialize(linked(shards, near, threshold), "graph-links")
        counts = materialize(found.groupBy("node").agg(F.sum("n").alias("n")), "graph-counts")
        clusters = shards.select("cluster").distinct().count()
        release(shards, near)
        if overlap >= clusters or audit(nodes, counts, threshold) >= RECALL:
            break
        release(found, counts)
        overlap *= 2
    comp = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    members = vectors.join(nodes, "v").select("id", "node", "weight")
    members = members.join(counts, "node", "left") \
        .join(comp.withColumnRenamed("id", "node"), "node", "left") \
        .groupBy("id").agg(F.max(F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
                           F.min(F.coalesce("component", "node")).alias("component"))
    members = materialize(members, "graph-members")
    release(nodes, found, counts)
    return members


def audit(nodes: DataFrame, counts: DataFrame, threshold: float = THRESHOLD, queries: int = AUDITED) -> float:
    """Share of the true links of a bounded sample of nodes that ``counts`` (node, n) has, by brute force in blocks.

    ``nodes`` has node, v, weight; links are counted by the weight of their other end.
    """
    picked = nodes.orderBy(F.xxhash64(F.lit(3), "node"), "node").limit(queries).select("node", "v").toArrow()
    if not picked.num_rows:
        return 1.0
    ids, q = picked.column("node").to_numpy(), unit(matrix(picked.column("v")))

    def count(batches):
        for b in batches:
            for k in range(0, b.num_rows, 2048):
                part = b.slice(k, 2048)
                node, weight = part.column("node").to_numpy(), part.column("weight").to_numpy()
                s = (q @ unit(matrix(part.column("v"))).T >= threshold) & (node != ids[:, None])
                yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array((s * weight).sum(axis=1))], names=["node", "true"])

    true = nodes.select("node", "weight", "v").mapInArrow(count, "node long, true long").groupBy("node").agg(F.sum("true").alias("true"))
    got = true.join(counts, "node", "left") \
        .agg(F.sum(F.least("true", F.coalesce("n", F.lit(0)))).alias("found"), F.sum("true").alias("true")).first()
    return got["found"] / got["true"] if got["true"] else 1.0
