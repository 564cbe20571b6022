"""Exact LOF on the distributed kd-tree vs a brute-force implementation."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.lof_brute import lof as brute_lof
from tests.lof_brute import novelty as brute_novelty
from thermolytics.operators.lof import fit_lof, lof_flag, lof_novelty, lof_scores


def make_points(seed=7, n=260, dims=3, dup=25):
    rng = np.random.default_rng(seed)
    X = np.round(rng.normal(size=(n, dims)) * 2, 1)        # coarse grid: ties and duplicates
    X[:dup] = X[0]                                         # a hot group of identical rows
    X[dup:dup + 40] = X[dup] + rng.normal(size=(40, dims)) * 1e-3   # dense near-duplicates
    grp = np.where(np.arange(n) % 3 == 0, "g1", "g2")
    ids = rng.permutation(n) + 1000
    return X, ids, grp


def frame(spark, X, ids, grp):
    rows = [(str(g), int(i), *map(float, x)) for x, i, g in zip(X, ids, grp)]
    cols = ["grp", "id"] + [f"x{j}" for j in range(X.shape[1])]
    return spark.createDataFrame(rows, cols), cols[2:]


@pytest.mark.parametrize("within", ["grp", None])
def test_lof_matches_brute_force(spark, within):
    X, ids, grp = make_points()
    df, dims = frame(spark, X, ids, grp)
    got = {r.id: r.lof for r in lof_scores(df, dims, "id", k=6, within=within, leaf_size=8).collect()}
    exp, _, _ = brute_lof(X, ids, 6, grp if within else None)
    assert len(got) == len(ids)
    for i, e in zip(ids, exp):
        assert got[int(i)] == pytest.approx(e, rel=1e-9, abs=1e-9)


def test_lof_is_row_order_invariant(spark):
    X, ids, grp = make_points(seed=3, n=120)
    df, dims = frame(spark, X, ids, grp)
    a = {r.id: r.lof for r in lof_scores(df, dims, "id", k=5, within="grp").collect()}
    b = {r.id: r.lof for r in lof_scores(df.orderBy("x1").repartition(3), dims, "id", k=5, within="grp").collect()}
    assert a.keys() == b.keys() and all(a[i] == pytest.approx(b[i], rel=1e-12) for i in a)


def test_k_clipped_and_singleton_group(spark):
    df = spark.createDataFrame([("a", 1, 0.0), ("a", 2, 1.0), ("a", 3, 3.0), ("b", 4, 5.0)], ["grp", "id", "x"])
    got = {r.id: r.lof for r in lof_scores(df, ["x"], "id", k=20, within="grp").collect()}
    exp, _, _ = brute_lof(np.array([[0.0], [1.0], [3.0]]), np.array([1, 2, 3]), 2)
    assert [got[1], got[2], got[3]] == pytest.approx(list(exp))
    assert got[4] is None


def test_adding_a_group_leaves_others_unchanged(spark):
    X, ids, grp = make_points(seed=11, n=150)
    df, dims = frame(spark, X, ids, grp)
    a = {r.id: r.lof for r in lof_scores(df.where("grp = 'g1'"), dims, "id", k=5, within="grp").collect()}
    b = {r.id: r.lof for r in lof_scores(df, dims, "id", k=5, within="grp").collect() if r.grp == "g1"}
    assert a.keys() == b.keys() and all(a[i] == pytest.approx(b[i], rel=1e-12) for i in a)


def test_novelty_matches_brute_force(spark):
    X, ids, grp = make_points(seed=5, n=200)
    ref, qry = np.arange(200) < 140, np.arange(200) >= 140
    df, dims = frame(spark, X, ids, grp)
    dref = df.where(df.id.isin([int(i) for i in ids[ref]]))
    dq = df.where(df.id.isin([int(i) for i in ids[qry]]))
    model = fit_lof(dref, dims, "id", k=5, within="grp", leaf_size=8)
    got = {r.id: r.lof for r in lof_novelty(model, dq, dims, "id").collect()}
    exp = brute_novelty(X[ref], ids[ref], X[qry], 5, grp[ref], grp[qry])
    for i, e in zip(ids[qry], exp):
        assert got[int(i)] == pytest.approx(e, rel=1e-9, abs=1e-9)


def test_flag_auto_and_contamination(spark):
    X, ids, grp = make_points(seed=9, n=100)
    df, dims = frame(spark, X, ids, grp)
    s = lof_scores(df, dims, "id", k=5)
    auto = lof_flag(s, "auto").collect()
    assert all(r.is_outlier == int(r.lof > 1.5) for r in auto)
    c = lof_flag(s, 0.1).collect()
    scores = np.array([r.lof_score for r in c])
    off = np.percentile(scores, 10)
    assert all(r.is_outlier == int(r.lof_score < off) for r in c)


def test_no_join_by_group_alone(spark):
    """With broadcasts off, no step of the fit or the search joins rows by their group."""
    from thermolytics.operators import knn, lof
    X, ids, grp = make_points(n=200)
    df, dims = frame(spark, X, ids, grp)
    plans = []
    keep = knn.materialize, lof.materialize

    def spy(d, name, count=False):
        plans.append(d._jdf.queryExecution().executedPlan().toString())
        return keep[0](d, name, count)

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    knn.materialize = lof.materialize = spy
    try:
        model = fit_lof(df, dims, "id", k=5, within="grp", leaf_size=20)
        out = lof_novelty(model, df, dims, "id")
        plans.append(out._jdf.queryExecution().executedPlan().toString())
        assert out.count() == 200
    finally:
        knn.materialize, lof.materialize = keep
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    import re
    joins = [m for p in plans for m in re.findall(r"Join \[([^\]]*)\]", p)]
    assert joins and not [j for j in joins if re.fullmatch(r"grp#\d+L?", j)]


def test_depth_of_deep_nodes(spark):
    from thermolytics.operators.knn import _depth
    from pyspark.sql import functions as F
    ids = [4 ** d + x for d in range(0, 30) for x in (0, 3 * 4 ** d - 1)]
    got = spark.createDataFrame([(i,) for i in ids], "n long").select("n", _depth(F.col("n")).alias("d")).collect()
    assert all(4 ** r.d <= r.n < 4 ** (r.d + 1) for r in got)


def test_nodes_too_large_at_the_deepest_level_raise(spark):
    from thermolytics.operators.knn import build_tree
    rows = [("g", i, float(i), 1) for i in range(200)]
    vec = spark.createDataFrame(rows, "g string, vid long, x double, cnt long")
    with pytest.raises(RuntimeError, match="depth 1"):
        build_tree(vec, ["g"], ["x"], leaf_size=4, max_depth=1)


def test_rows_of_unseen_groups_have_no_score(spark):
    X, ids, grp = make_points(n=90)
    df, dims = frame(spark, X, ids, grp)
    model = fit_lof(df.where("grp = 'g1'"), dims, "id", k=5, within="grp")
    got = {r.grp for r in lof_novelty(model, df, dims, "id").where("lof is null").collect()}
    assert got == {"g2"}
    everywhere = fit_lof(df.where("grp = 'g1'"), dims, "id", k=5)
    assert lof_novelty(everywhere, df, dims, "id").where("lof is null").count() == 0


def brute_neighbours(X, ids, Q, k):
    """Ids of each query's k nearest, nearest first, by (distance rounded to 9 decimals, id); Q holds (id, vector)."""
    out = {}
    for i, v in Q:
        d = np.round(np.sqrt(((X - v) ** 2).sum(axis=1)), 9)
        order = [int(ids[j]) for j in np.lexsort((ids, d)) if ids[j] != i]
        out[int(i)] = order[:k]
    return out


def neighbours(df):
    out = {}
    for r in df.orderBy("qid", "dist", "cid").collect():
        out.setdefault(r.qid, []).append((round(r.dist, 9), r.cid))
    return {q: [c for _, c in sorted(v)] for q, v in out.items()}


def vectors(spark, X, ids):
    return spark.createDataFrame([("g", int(i), *map(float, x), 1) for i, x in zip(ids, X)],
                                 ["grp", "vid", *[f"x{j}" for j in range(X.shape[1])], "cnt"])


def test_parts_cut_in_passes_give_the_same_neighbours(spark):
    """Cells of 40 vectors: several sketched passes before the cells are cut into leaves."""
    from thermolytics.operators.knn import build_tree, descend, knn
    rng = np.random.default_rng(12)
    X = np.round(np.concatenate([rng.normal(size=(700, 3)), rng.exponential(size=(300, 3)) * [50, 1, 0.01]]), 2)
    X = np.unique(X, axis=0)
    ids = np.arange(len(X))
    vec = vectors(spark, X, ids)
    tree = build_tree(vec, ["grp"], ["x0", "x1", "x2"], leaf_size=16, cell=40)
    sizes = tree.vectors.groupBy("leaf").count().toPandas()["count"]
    assert sizes.max() <= 16 and sizes.sum() == len(X)
    assert neighbours(knn(tree, tree.vectors, 4, True)) == brute_neighbours(X, ids, zip(ids, X), 4)
    # Stored cuts lead each vector to its own leaf.
    down = descend(tree, vec).select("vid", "leaf").exceptAll(tree.vectors.select("vid", "leaf"))
    assert down.count() == 0


@pytest.mark.parametrize("shape", ["even", "far"])
def test_leaves_with_fewer_than_k_vectors_have_a_finite_bound(spark, monkeypatch, shape):
    """Leaves of 6 or 7 vectors and k = 7: no own leaf is enough, in the fit and for new points."""
    from pyspark.sql import functions as F
    from thermolytics.operators import knn as K
    rng = np.random.default_rng(21)
    X = rng.normal(size=(1600, 3))
    if shape == "far":                      # parts far from each other, of two points each at the ends
        X[:, 0] = np.where(np.arange(1600) < 20, np.arange(1600) // 2 * 50.0 + 100, X[:, 0])
    ids = np.arange(len(X))
    walked = []
    keep = K.materialize

    def spy(df, name, count=False):
        out = keep(df, name, count)
        if name == "knn-walk":
            walked.append(out)
        return out

    monkeypatch.setattr(K, "materialize", spy)
    tree = K.build_tree(vectors(spark, X, ids), ["grp"], ["x0", "x1", "x2"], leaf_size=24)
    rows = tree.vectors.groupBy("leaf").count()
    assert tree.least <= 6 and rows.where("count > 7").count() <= 20
    assert neighbours(K.knn(tree, tree.vectors, 7, True)) == brute_neighbours(X, ids, zip(ids, X), 7)
    K.knn(tree, tree.vectors, 5, True).count()                  # own leaves suffice
    short, normal = (w.count() / len(X) for w in walked)
    assert walked[0].where("_r = double('inf')").count() == 0 and short <= 2 * normal

    new = tree.vectors.select("grp", (F.col("vid") + 10_000).alias("vid"), (F.col("x0") + 0.01).alias("x0"), "x1", "x2", F.lit(1).alias("cnt"))
    for k in (8, 5):
        fitted = K.KdTree(tree.vectors.withColumn("_k", F.lit(k).cast("long")), tree.splits, tree.boxes, tree.groups, tree.dims,
                          tree.depth, tree.leaf_size, tree.least)
        got = neighbours(K.knn(fitted, new, most_k=k))
        Q = [(r.vid, np.array([r.x0, r.x1, r.x2])) for r in new.collect()]
        assert got == brute_neighbours(X, ids, Q, k)
    short, normal = (w.count() / len(X) for w in walked[2:])
    assert walked[2].where("_r = double('inf')").count() == 0 and short <= 2 * normal


def test_a_group_smaller_than_k_beside_a_cut_one(spark):
    rows = [("a", i, float(i * i % 97), float(i)) for i in range(300)] + [("b", 1000 + i, float(i), 0.0) for i in range(4)]
    df = spark.createDataFrame(rows, ["grp", "id", "x", "y"])
    got = {r.id: r.lof for r in lof_scores(df, ["x", "y"], "id", k=10, within="grp", leaf_size=40).collect()}
    X, ids, grp = np.array([r[2:] for r in rows]), np.array([r[1] for r in rows]), np.array([r[0] for r in rows])
    exp, _, _ = brute_lof(X, ids, 10, grp)
    assert all(got[int(i)] == pytest.approx(e, rel=1e-9) for i, e in zip(ids, exp))


@pytest.mark.parametrize("within", ["grp", None])
def test_approximate_neighbours_by_projection_tables(spark, within):
    """Recall of at least 0.9 at leaves far smaller than the data; equal rows and ties included."""
    from thermolytics.operators.knn import approximate_knn
    from thermolytics.operators.lof import lof_scores_approximate
    rng = np.random.default_rng(31)
    X = np.concatenate([rng.normal(size=(1200, 5)), rng.normal(size=(800, 5)) * 0.1 + 3, np.round(rng.normal(size=(400, 5)), 0)])
    ids = np.arange(len(X))
    grp = np.where(ids % 4 == 0, "g1", "g2")
    df, dims = frame(spark, X, ids, grp)
    scored = {r.id: r.lof for r in lof_scores_approximate(df, dims, "id", k=10, within=within, leaf_size=100).collect()}
    exact, _, _ = brute_lof(X, ids, 10, grp if within else None)
    assert len(scored) == len(X) and all(v is not None for v in scored.values())
    off = np.array([abs(scored[int(i)] - e) / e for i, e in zip(ids, exact)])
    assert np.median(off) < 0.01 and (off < 0.1).mean() > 0.9

    vec = vectors(spark, X[:2000], ids[:2000])
    got = neighbours(approximate_knn(vec, ["grp"], ["x0", "x1", "x2", "x3", "x4"], 10, leaf_size=100))
    want = brute_neighbours(X[:2000], ids[:2000], zip(ids[:2000], X[:2000]), 10)
    recall = np.mean([len(set(got[i]) & set(want[i])) / 10 for i in want])
    fewer = neighbours(approximate_knn(vec, ["grp"], ["x0", "x1", "x2", "x3", "x4"], 10, leaf_size=100, tables=1))
    assert recall >= 0.9 > np.mean([len(set(fewer[i]) & set(want[i])) / 10 for i in want])
    assert all(len(v) == 10 for v in got.values()) and len(got) == 2000


def test_approximate_search_of_small_groups_is_exact(spark):
    from thermolytics.operators.lof import lof_scores_approximate
    X, ids, grp = make_points(seed=3, n=160)
    df, dims = frame(spark, X, ids, grp)
    got = {r.id: r.lof for r in lof_scores_approximate(df, dims, "id", k=6, within="grp").collect()}
    exp, _, _ = brute_lof(X, ids, 6, grp)
    assert all(got[int(i)] == pytest.approx(e, rel=1e-9, abs=1e-9) for i, e in zip(ids, exp))


def test_passes_cut_along_several_dimensions(spark):
    """Parts above the cells are no slabs along one dimension: a ball would cross nearly all of them."""
    from thermolytics.operators.knn import _depth, build_tree
    X = np.random.default_rng(8).uniform(size=(2000, 3))
    tree = build_tree(vectors(spark, X, np.arange(2000)), ["grp"], ["x0", "x1", "x2"], leaf_size=30, cell=30)
    dims = {r.dim for r in tree.splits.where(_depth("node") < 3).collect()}
    assert dims == {0, 1, 2}


def test_one_list_per_query(spark):
    """Neighbours move as one row per vector, exact and approximate, with no neighbour twice."""
    from thermolytics.operators.knn import approximate_knn_lists, build_tree, knn_lists
    X = np.random.default_rng(9).normal(size=(600, 3))
    vec = vectors(spark, X, np.arange(600))
    tree = build_tree(vec, ["grp"], ["x0", "x1", "x2"], leaf_size=40)
    for lists in (knn_lists(tree, tree.vectors, 5, True), approximate_knn_lists(vec, ["grp"], ["x0", "x1", "x2"], 5, leaf_size=40)):
        rows = lists.collect()
        assert sorted(r.qid for r in rows) == list(range(600))
        assert all(len({n.cid for n in r.near}) == len(r.near) == 5 for r in rows)


def _stages(path):
    return sorted({p.name.rsplit("-", 1)[0] for p in path.glob("stage-*")})


def test_spent_tables_are_deleted(spark, tmp_path, monkeypatch):
    """Of a fit, its novelty scores and its flags only the tables stay that their results still read."""
    X, ids, grp = make_points(n=200)
    df, dims = frame(spark, X, ids, grp)
    monkeypatch.setattr("thermolytics.session.checkpoint_root", lambda spark: str(tmp_path))
    model = fit_lof(df, dims, "id", k=5, within="grp", leaf_size=20)
    assert set(_stages(tmp_path)) == {"stage-kd-boxes", "stage-kd-leaves", "stage-lof-ref"}
    out = lof_novelty(model, df, dims, "id")
    left = set(_stages(tmp_path)) - {"stage-kd-boxes", "stage-kd-leaves", "stage-kd-splits", "stage-lof-ref"}
    assert left == {"stage-novelty-rows", "stage-novelty-scores"}
    assert out.count() == 200 and out.where("lof is null").count() == 0
    flagged = lof_flag(lof_scores(df, dims, "id", k=5), 0.1)
    # The scores are read, not joined a second time.
    assert {f.rsplit("/", 2)[1].rsplit("-", 1)[0] for f in flagged.inputFiles()} == {"stage-lof-scored"}
    assert flagged.count() == 200


def test_cells_name_their_neighbours_once(spark):
    from thermolytics.operators.knn import build_tree, knn_lists
    from thermolytics.operators.lof import _needs, distinct_vectors
    X, ids, grp = make_points(n=300)
    df, dims = frame(spark, X, ids, grp)
    vec = distinct_vectors(df, ["grp"], dims, "id")
    tree = build_tree(vec, ["grp"], dims, leaf_size=30)
    lists = knn_lists(tree, tree.vectors, 5, True)
    needs = _needs(lists, ["grp"])
    assert "Exchange" not in needs._jdf.queryExecution().executedPlan().toString()
    expected = {(r.grp, r.leaf, r._chunk, n.cid) for r in lists.collect() for n in r.near}
    got = [tuple(r) for r in needs.collect()]
    assert len(got) == len(set(got)) and set(got) == expected


def test_lists_move_as_bytes(spark):
    """Neighbour lists are binary columns, and are read the same from any slice of a batch."""
    import pyarrow as pa
    from thermolytics.operators.knn import _lists, _near_rows, build_tree, packed_lists
    vec = vectors(spark, np.random.default_rng(9).normal(size=(200, 3)), np.arange(200))
    tree = build_tree(vec, ["grp"], ["x0", "x1", "x2"], leaf_size=40)
    types = dict(packed_lists(tree, tree.vectors, 5, True).dtypes)
    assert {types[c] for c in ("_cid", "_dist", "_w")} == {"binary"} and "near" not in types
    cols = _lists(np.array([1, 1, 3]), np.array([7, 8, 9]), np.array([0.5, 1.5, 2.5]), np.array([1, 2, 1]), 4, 3)
    assert cols["_far"].to_pylist() == [None, 1.5, None, 2.5] and cols["_r"].to_pylist() == [None, 1.5, None, None]
    t = pa.table(cols)
    for part, expected in ((t, [(1, 7, 1), (1, 8, 2), (3, 9, 1)]), (t.slice(2), [(1, 9, 1)]), (t.slice(0, 1), []),
                           (pa.concat_tables([t.slice(1, 1), t.slice(3)]), [(0, 7, 1), (0, 8, 2), (1, 9, 1)])):
        assert list(zip(*(a.tolist() for a in _near_rows(part, "cid", "w")))) == expected


def test_partitions_follow_leaves(spark):
    """A small tree is not dealt over as many partitions as shuffles have: most would be empty."""
    from thermolytics.operators.knn import SLOT_PARTITIONS, _search_partitions
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2000")
    try:
        few = SLOT_PARTITIONS * spark.sparkContext.defaultParallelism
        assert [_search_partitions(spark, n) for n in (0, few, 500, 5000)] == [few, few, 500, 2000]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_middle_sized_group_is_one_leaf(spark):
    """Leaves of 32,768 vectors cut such a group in four: a third of the queries and more had to visit other leaves."""
    from thermolytics.operators.knn import LEAF, build_tree
    rows = spark.range(40_000).select(F.lit(0).alias("g"), F.col("id").alias("vid"), F.rand(1).alias("x0"), F.rand(2).alias("x1"), F.lit(1).alias("cnt"))
    tree = build_tree(rows, ["g"], ["x0", "x1"], LEAF, n_vectors=40_000)
    assert tree.leaves == 1 and tree.depth == 0 and tree.boxes.first().vectors == 40_000


def test_large_k_makes_smaller_leaves(spark, monkeypatch):
    from thermolytics.operators import lof
    monkeypatch.setattr(lof, "ENTRIES", 400)
    X, ids, grp = make_points(seed=13, n=200)
    df, dims = frame(spark, X, ids, grp)
    model = fit_lof(df, dims, "id", k=5)
    assert model.tree.leaf_size == 80 and model.tree.leaves > 1
    exp, _, _ = brute_lof(X, ids, 5, None)
    got = {r.id: r.lof for r in lof_scores(df, dims, "id", k=5, model=model).collect()}
    assert all(got[int(i)] == pytest.approx(e, rel=1e-9, abs=1e-9) for i, e in zip(ids, exp))


@pytest.mark.parametrize("scale,shift", [(1.0, 0.0), (1e-7, 3.0), (1e17, 0.0), (1e-3, 1e6)])
def test_estimates_in_single_precision_lose_no_pair(scale, shift):
    from thermolytics.operators.knn import _maybe_within, _squared
    rng = np.random.default_rng(3)
    q = np.vstack([rng.normal(size=(60, 6)), rng.normal(size=(4, 6)) * 1e-4, rng.normal(size=(2, 6)) * 50]) * scale + shift
    c = np.vstack([q[::2], rng.normal(size=(500, 6)) * scale + shift])
    d = _squared(q[:, None], c[None])
    for lim in (np.sort(d, axis=1)[:, 20], np.full(len(q), np.inf), np.full(len(q), 1e-24)):
        mid = q.mean(axis=0)
        found = set(zip(*(a.tolist() for a in _maybe_within(q - mid, c - mid, lim))))
        assert found >= set(zip(*(a.tolist() for a in np.nonzero(d <= lim[:, None] * (1 - 1e-9)))))
    # The bounds are kept: not every pair is let through.
    if shift == 0.0:
        assert len(_maybe_within(q - mid, c - mid, np.sort(d, axis=1)[:, 20])[0]) < d.size / 3
