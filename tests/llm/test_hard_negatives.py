"""Hard negatives against brute force in Python integers, and against their SQL."""

import math

import duckdb
import numpy as np
import pytest

from thermolytics.llm import hard_negatives
from thermolytics.llm.queries import ORACLE_SQL, op12_hard_negatives

from .cases import CLASH
from ..conftest import SF

SCHEMA = "vec_id long, embedding array<double>, label int"
COLS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def frame(spark, rows, extra=False):
    df = spark.createDataFrame([(i, v if v is None else [None if x is None else float(x) for x in v], g) for i, v, g in rows], SCHEMA)
    if extra:
        from pyspark.sql import functions as F
        df = df.select("*", *[F.lit(i).alias(c) for i, c in enumerate((*CLASH, "id", "v", "asks", "i", "j", "positives"))])
    return df


def brute(rows, every=50, positives=5, negatives=3):
    """Rows of the result, in plain Python."""
    ok = {(i, g, tuple(math.floor(256 * x) for x in v)) for i, v, g in rows
          if i is not None and g is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    ok = [r for r in ok if sum(x * x for x in r[2]) <= 2 ** 62]
    out = []
    for i, g, v in ok:
        if i % every:
            continue
        scored = [(-sum(a * b for a, b in zip(v, w)), j, h) for j, h, w in ok if j != i and len(w) == len(v)]
        for p, pid in sorted({(s, j) for s, j, h in scored if h == g})[:positives]:
            window = sorted({(s, j) for s, j, h in scored if h != g and 50 * -p <= 100 * -s <= 95 * -p})
            out += [(i, pid, r + 1, j, -p, -s) for r, (s, j) in enumerate(window[:negatives])]
    return sorted(out)


def mined(df, **kw):
    return sorted(tuple(r) for r in hard_negatives.hard_negatives(df, **kw).select(*COLS).collect())


def clustered(n, dim, seed=0, labels=4):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, dim))
    x = centres[rng.integers(0, 6, n)] + rng.normal(size=(n, dim)) * 0.7
    return [(int(i), list(map(float, v)), int(g)) for i, v, g in zip(range(n), np.round(x, 2), rng.integers(0, labels, n))]


@pytest.mark.parametrize("m, k, n", [(1, 1, 1), (17, 33, 65), (40, 64, 100), (0, 5, 3), (3, 0, 4), (129, 70, 31)])
def test_strassen_is_exact(m, k, n):
    rng = np.random.default_rng(m * k + n)
    for top in (1000, 2 ** 28):
        a, b = rng.integers(-top, top, (m, k)), rng.integers(-top, top, (k, n))
        want = np.array(a.astype(object) @ b.astype(object), dtype=object).reshape(m, n)
        assert (hard_negatives.strassen(a, b) == want.astype(np.int64)).all()


def test_strassen_wraps_round():
    rng = np.random.default_rng(3)
    a, b = rng.integers(-2 ** 62, 2 ** 62, (40, 40)), rng.integers(-2 ** 62, 2 ** 62, (40, 40))
    assert (hard_negatives.strassen(a, b) == a @ b).all()


@pytest.mark.parametrize("n, dim, every", [(400, 20, 50), (301, 7, 10)])
def test_against_brute_force(spark, n, dim, every):
    rows = clustered(n, dim, n)
    want = brute(rows, every)
    assert want and mined(frame(spark, rows), every=every) == want


def test_many_small_tiles(spark, monkeypatch):
    for name, value in (("ANCHOR_VALUES", 90), ("TILE_VALUES", 500), ("SLAB", 4)):
        monkeypatch.setattr(hard_negatives, name, value)
    rows = clustered(220, 9, 5)
    assert mined(frame(spark, rows), every=10) == brute(rows, 10)


def test_one_label_and_equal_vectors_hold_a_third(spark):
    rows = [(i, v, 0 if i % 3 == 0 else g) for i, v, g in clustered(300, 8, 2)]
    rows = [(i, rows[3][1] if i % 3 == 0 else v, g) for i, v, g in rows]
    assert mined(frame(spark, rows), every=25) == brute(rows, 25)


def awkward():
    nan, inf = float("nan"), float("inf")
    return [(0, [1, 1, 0], 1), (0, [1, 1, 0], 1), (50, [0.5, 1, 0], 1), (50, [1, 0.9, 0], 2), (1, [1, 1, 0], 1), (2, [1, 0.9, 0], 1),
            (3, [0.7, 0.7, 0], 2), (4, [0.7, 0.7, 0], 3), (5, [0, 0, 0], 2), (6, None, 1), (7, [nan, 1, 0], 1), (8, [inf, 0, 0], 2),
            (9, [None, 1, 0], 2), (10, [1, 0], 1), (100, [1, 0.5], 1), (11, [0.6, 0.3], 2), (12, [], 1), (150, [], 1), (13, [], 2),
            (None, [1, 1, 0], 2), (14, [1, 1, 0], None), (200, [-1, -1, 0], 4), (15, [1, 1, 0], 4), (16, [1e30, 0, 0], 1),
            (17, [-0.001, 0.6, 0], 5), (250, [0, 0, 0], 6), (18, [1, 2, 3], 6), (19, [0.5, 0.5, 0], 3), (19, [0.5, 0.5, 0], 3),
            (300, [1e6, 1e6, 0], 8), (20, [1e6, 1e6, 1], 8), (21, [9e5, 8e5, 0], 9)]


def test_awkward_rows_and_clashing_columns(spark):
    want = brute(awkward())
    assert {r[0] for r in want} >= {0, 50, 100, 150, 250, 300}
    assert mined(frame(spark, awkward(), extra=True)) == want


def test_empty_and_single_row_tables(spark):
    assert mined(frame(spark, [])) == [] and mined(frame(spark, [(0, [1.0], 1)])) == []
    assert mined(frame(spark, [(1, [1.0], 1), (2, [1.0], 1)])) == []


def test_whole_table_against_sql(spark):
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from '{SF}/embeddings.parquet'")
    want = sorted(con.execute(f"select {', '.join(COLS)} from ({ORACLE_SQL['op12_hard_negatives']})").fetchall())
    got = sorted(tuple(r) for r in op12_hard_negatives(spark, SF).select(*COLS).collect())
    assert want and got == want
