import random

import pytest

from thermolytics.llm import token_tree as T

from .cases import awkward, collected, frame
from ..conftest import SF

PARTS = ["a", "b", "'", "s", "r", "e", " ", "  ", "\n", "1", "23", "é", "!", ",", "日本", "\t", "'ll", "x ", "<|endoftext|>"]


@pytest.fixture(scope="module")
def encoder():
    return T.Encoder()


def changed(text, edits):
    for s, e, r in reversed(edits):
        text = text[:s] + r + text[e:]
    return text


@pytest.mark.parametrize("seed", range(4))
def test_edits_against_encoding_anew(encoder, seed):
    rng = random.Random(seed)
    for turn in range(800):
        text = "".join(rng.choice(PARTS) for _ in range(rng.randint(0, 60) if turn % 10 else 900))
        tree = T.build(text, encoder)
        for _ in range(2):                              # edits on an edited tree
            edits = [(s, s + rng.randint(0, 6), "".join(rng.choice(PARTS) for _ in range(rng.randint(0, 4))))
                     for s in (rng.randint(0, len(text) + 2) for _ in range(rng.randint(0, 6)))]
            edits = T.in_order(edits, len(text))
            want = changed(text, edits)
            text, n = T.apply(text, tree, edits, encoder)
            assert text == want
            assert tree.tokens == len(encoder.encoding.encode_ordinary(text))
            assert [x for c in tree.sizes for x in c] == [len(p) for p in encoder.pattern.findall(text)]
            for i in range(1, tree.leaves):
                assert tree.sums[i] == [a + b for a, b in zip(tree.sums[2 * i], tree.sums[2 * i + 1])]


def test_only_touched_regions_are_encoded(encoder):
    text = " ".join(f"word{i}" for i in range(5000))
    tree = T.build(text, encoder)
    at = text.index("word2500")
    assert T.apply(text, tree, [(at, at + 4, "term")], encoder)[1] <= 6


def test_recount_whole_table(spark, encoder):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    rows = T.recount(docs).collect()
    assert len(rows) == len(texts) and sum(r["n_edits"] for r in rows) > 0
    for r in rows:
        text = texts[r["doc_id"]]
        edits = T.in_order(T.scrub(text), len(text))
        assert r["n_tokens"] == len(encoder.encoding.encode_ordinary(text)) and r["n_edits"] == len(edits)
        assert r["n_tokens_after"] == len(encoder.encoding.encode_ordinary(changed(text, edits)))
        assert r["n_pretokens"] == len(encoder.pattern.findall(text))


def test_table_of_edits(spark, encoder):
    docs = frame(spark, [(1, "call 555 now", None, None, 0), (2, "left alone", None, None, 0), (3, None, None, None, 0),
                         (4, "", None, None, 0), (None, "no id", None, None, 0)])
    edits = spark.createDataFrame([(1, 5, 8, "0"), (1, 6, 9, "lost"), (1, 99, 120, "!"), (3, 0, 1, "x"), (4, -5, 0, "new"),
                                   (2, 0, 4, None), (9, 0, 1, "no such row"), (None, 0, 1, "x"), (2, None, 4, "x")],
                                  "doc_id long, start int, end int, replacement string")
    got = {r["doc_id"]: r for r in T.edited(T.trees(docs), edits).collect()}
    assert {i: r["text"] for i, r in got.items()} == {1: "call 0 now!", 2: " alone", 3: None, 4: "new", None: "no id"}
    for r in got.values():
        assert r["n_tokens"] == sum(r["counts"]) == len(encoder.encoding.encode_ordinary(r["text"] or ""))
        assert sum(r["sizes"]) == len(r["text"] or "")
    assert got[3]["n_encoded"] == got[None]["n_encoded"] == 0


def test_awkward_rows(spark):
    rows = T.recount(frame(spark, extra=True)).collect()
    assert len(rows) == len(awkward())
    by_id = {r["doc_id"]: r for r in rows}
    assert tuple(by_id[4])[1:] == (0, 0, 0, 0, 0) == tuple(by_id[5])[1:]
    assert by_id[13]["n_edits"] == 2 and by_id[8]["n_pretokens"] >= 30000
    assert collected(T.recount(frame(spark, []))) == []
