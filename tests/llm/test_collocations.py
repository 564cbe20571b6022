"""Collocations against plain counting, and against their SQL."""

import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from thermolytics.llm import collocations as C
from thermolytics.llm.queries import ORACLE_SQL, op11_collocations

from .cases import awkward, frame
from ..conftest import SF

COLS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def plain(rows, longest=3, least=10, covered=50, top=2000):
    f, n = Counter(), Counter()
    for _, text, lang, *_ in rows:
        lang = lang or "und"
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for m in range(1, longest + 1):
                f.update((lang, tuple(w[i:i + m])) for i in range(len(w) - m + 1))
    found = defaultdict(list)
    often = {k for k in f if len(k[1]) > 1 and f[k] >= least}
    gone = set()
    for lang, p in often:
        for i in range(len(p)):
            for j in range(i + 2, len(p) + 1):
                if j - i < len(p) and 100 * f[lang, p] >= covered * f[lang, p[i:j]]:
                    gone.add((lang, p[i:j]))
    for lang, p in often - gone:
        a = f[lang, p]
        cuts = [(1_000_000 * a * a // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p))]
        score, k = min(cuts)
        found[lang].append((-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
    return sorted((lang, i + 1, p.decode(), -a, l, r, n[lang], -s)
                  for lang, some in found.items() for i, (s, a, p, l, r) in enumerate(sorted(some)[:top]))


def mined(df, **kw):
    return sorted(tuple(r) for r in C.collocations(df, **kw).select(*COLS).collect())


def corpus(seed=0, n=60):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(30)] + ["Ünï", "The", "OF", "İx", "a\x00b", "naïve"]
    fixed = ["New York City", "of the", "in spite of", "a b a b a b", "The End"]
    rows = []
    for i in range(n):
        parts = [rng.choice(fixed) if rng.random() < 0.3 else rng.choice(vocabulary) for _ in range(rng.randint(0, 90))]
        text = "".join(p + rng.choice([" ", " ", " ", "  ", "\t", ", ", ". ", "\n", "\r\n", "  "]) for p in parts)
        rows.append((i, text, rng.choice(["en", "en", "de", None, "und"]), "s", 0))
    return rows


@pytest.mark.parametrize("seed, kw", [(0, {}), (1, {"least": 3, "longest": 4}), (2, {"least": 2, "covered": 80, "top": 7}),
                                      (3, {"longest": 2})])
def test_against_plain_counting(spark, seed, kw):
    rows = corpus(seed)
    want = plain(rows, **kw)
    assert want and mined(frame(spark, rows), **kw) == want


def test_small_blocks_groups_and_tiles(spark, monkeypatch):
    for name, value in (("BLOCK_TOKENS", 40), ("GROUP_PAIRS", 100), ("SIDE", 2), ("DENSE", 3)):
        monkeypatch.setattr(C, name, value)
    rows = corpus(5)
    assert mined(frame(spark, rows).repartition(3), least=3) == plain(rows, least=3)


def test_one_text_and_one_phrase_hold_a_third(spark):
    rows = corpus(6) + [(100 + i, "the same line again and again", "en", "s", 0) for i in range(40)]
    rows += [(200, "la la la " * 4000, "en", "s", 0)]
    assert mined(frame(spark, rows)) == plain(rows)


def test_awkward_rows_and_clashing_columns(spark):
    rows = awkward() * 4
    assert mined(frame(spark, rows, extra=True)) == plain(rows)


def test_tables_without_phrases(spark):
    assert mined(frame(spark, [])) == [] and mined(frame(spark, [(1, None, None, "s", 0), (2, "a. b. c", "en", "s", 0)])) == []
    assert mined(frame(spark, [(1, "one " * 9, "en", "s", 0)])) == []


def test_scores_are_exact_beyond_64_bits(spark):
    f = [(0, "en", "x y", 12_345_678_901_234, [98_765_432_109_877], [12_345_678_901_239]), (1, "en", "u v", 10, [10], [10])]
    df = spark.createDataFrame(f, "id long, lang string, phrase string, f long, pre array<long>, suf array<long>")
    got = {r["phrase"]: r["score"] for r in C.scored(df, 2).collect()}
    assert got == {p: 1_000_000 * a * a // (l[0] * r[0]) for _, _, p, a, l, r in f}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2 ** 62), max_size=50))
def test_packing_round_trip(values):
    assert C.unpack(C.pack(np.array(values, np.int64))).tolist() == values


@pytest.mark.parametrize("top, n", [(3, 20_000), (2000, 9000), (2 ** 40, 500)])
def test_tiles_count_like_a_counter(top, n):
    rng = np.random.default_rng(n)
    x, y = rng.integers(0, top, n), np.minimum(rng.zipf(1.3, n), 2 ** 40 - 1)
    a, b, c = C.tile_counts(x, y)
    assert dict(zip(zip(a.tolist(), b.tolist()), c.tolist())) == Counter(zip(x.tolist(), y.tolist())) and len(a) == len(set(zip(a.tolist(), b.tolist())))


def test_whole_table_against_sql(spark):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{SF}/documents.parquet'")
    want = sorted(con.execute(f"select {', '.join(COLS)} from ({ORACLE_SQL['op11_collocations']})").fetchall())
    assert want and sorted(tuple(r) for r in op11_collocations(spark, SF).select(*COLS).collect()) == want
