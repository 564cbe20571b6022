import random

import numpy as np

from thermolytics.llm import superminhash as S
from thermolytics.llm.components import components

from .cases import awkward, collected, documents, frame, words
from ..conftest import SF


def brute(docs, percent):
    """doc_id -> smallest doc_id reachable, comparing all pairs of (doc_id, text)."""
    sets = {}
    for d, t in docs:
        w = (t or "").encode().lower().split()
        sets[d] = {tuple(w)} if 0 < len(w) < 5 else {tuple(w[i:i + 5]) for i in range(len(w) - 4)}
    ids = sorted(sets)
    comp = {d: d for d in ids}
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]) and comp[a] != comp[b]:
                lo, hi = sorted((comp[a], comp[b]))
                comp = {d: lo if c == hi else c for d, c in comp.items()}
    return [(d, len(sets[d]), comp[d], comp[d] == d) for d in ids]


def run(df, percent=85):
    return [tuple(r) for r in S.near_duplicates(df, percent).orderBy("doc_id").collect()]


def test_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert run(docs) == brute([(r["doc_id"], r["text"]) for r in docs.collect()], 85)


def test_two_families_that_share_buckets(spark):
    """Copies edited at random: hubs link some of them only, others by way of third documents, and some not at all."""
    rng = random.Random(3)
    base, texts = words(1, 120), []
    for i in range(120):
        w = list(base)
        for _ in range(rng.randint(0, 4)):
            w[rng.randrange(120)] = f"new{i}"
        if i % 2:
            w[10:25] = words(77, 15)
        texts.append(" ".join(w))
    assert run(documents(spark, texts)) == brute(list(enumerate(texts)), 85)


def test_blocks_of_one_bucket(spark, monkeypatch):
    monkeypatch.setattr(S, "BLOCK", 4)
    test_two_families_that_share_buckets(spark)


def test_estimates_have_low_variance():
    """SuperMinHash: unbiased, and with a smaller error than independent hashes have for small sets."""
    rng = np.random.default_rng(0)
    errors = []
    for _ in range(200):
        x = rng.integers(0, 1 << 62, 60).astype(np.uint64)
        a, b = np.unique(x[:50]), np.unique(x[10:])
        sig = S.signatures([a, b])
        errors.append((sig[0] == sig[1]).mean() - 40 / 60)
    assert abs(np.mean(errors)) < 0.01
    assert np.mean(np.square(errors)) < (40 / 60) * (20 / 60) / S.SLOTS


def test_large_sets_in_parts(monkeypatch):
    sets = [np.unique(np.random.default_rng(i).integers(0, 1 << 62, 900).astype(np.uint64)) for i in range(3)]
    whole = S.signatures(sets)
    monkeypatch.setattr(S, "PART", 100)
    assert (S.signatures(sets) == whole).all()


def test_awkward_rows(spark):
    got = S.near_duplicates(frame(spark, extra=True), 85).collect()
    assert len(got) == len(awkward())
    by_id = {r["doc_id"]: r for r in got}
    assert [by_id[i]["component_id"] for i in (1, 2, 3)] == [1, 1, 1]
    assert all((by_id[i]["n_shingles"], by_id[i]["component_id"], by_id[i]["kept"]) == (0, i, True) for i in (4, 5, 6))
    assert all(r["component_id"] is None and r["kept"] for r in got if r["doc_id"] is None)
    assert by_id[8]["n_shingles"] > 29000 and by_id[10]["n_shingles"] == 1
    assert {r["component_id"] for r in got if r["doc_id"] == 14} == {14}


def test_rows_with_one_id_connect_their_groups(spark):
    a, b = " ".join(words(5, 50)), " ".join(words(6, 50))
    rows = [(1, a, None, None, 0), (7, a, None, None, 0), (7, b, None, None, 0), (9, b, None, None, 0)]
    assert {r["doc_id"]: r["component_id"] for r in S.near_duplicates(frame(spark, rows)).collect()} == {1: 1, 7: 1, 9: 1}


def test_drop_keeps_one_of_each_group(spark):
    docs = frame(spark, extra=True)
    got = S.drop_near_duplicates(docs)
    assert got.columns == docs.columns
    ids = sorted(r["doc_id"] for r in got.collect() if r["doc_id"] is not None)
    assert ids == [0, 1, 4, 5, 6, 7, 8, 9, 10, 11, 12, 13, 14, 14]
    assert got.where("doc_id is null").count() == 2
    assert collected(S.near_duplicates(frame(spark, []))) == []


def test_components_of_chains_and_hubs(spark):
    rng = random.Random(2)
    chain = list(range(100, 160))
    rng.shuffle(chain)
    links = list(zip(chain, chain[1:])) + [(0, i) for i in range(1, 90)] + [(200, 200), (None, 3), (300, 301), (301, 300)]
    got = dict(collected(components(spark.createDataFrame(links, "a long, b long"))))
    want = {i: 100 for i in chain} | {i: 0 for i in range(90)} | {200: 200, 300: 300, 301: 300}
    assert got == want
