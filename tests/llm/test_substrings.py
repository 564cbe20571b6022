import hashlib
import random

from thermolytics.llm import queries, substrings

from .cases import awkward, collected, documents, frame
from ..conftest import SF


def brute(docs):
    """(doc_id, n_words, n_removed, kept) by a table of all windows, in order of (doc_id, start)."""
    out, seen = [], set()
    for doc_id, text in docs:
        w = (text or "").encode().split()
        gone = [False] * len(w)
        for i in range(len(w) - 19):
            run = tuple(w[i:i + 20])
            if run in seen:
                gone[i:i + 20] = [True] * 20
            seen.add(run)
        out.append((doc_id, len(w), sum(gone), b" ".join(x for x, g in zip(w, gone) if not g).decode()))
    return sorted(out, key=repr)


def run(df):
    return collected(substrings.dedup_substrings(df).select("doc_id", "n_words", "n_removed", "kept"))


def test_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    assert run(docs) == brute(sorted(map(tuple, docs.collect())))


def test_small_alphabets(spark):
    """Periodic and nearly periodic texts: equal seeds everywhere, matches that end anywhere."""
    rng = random.Random(5)
    texts = []
    for i in range(60):
        base = [rng.choice("ab" if i % 3 else "abcdefgh") for _ in range(rng.randint(0, 150))]
        if texts and i % 2:
            other = texts[rng.randrange(len(texts))].split()
            at = rng.randint(0, len(other))
            base[rng.randint(0, len(base)):0] = other[at:at + rng.randint(15, 40)]
        texts.append(" ".join(base))
    assert run(documents(spark, texts)) == brute(list(enumerate(texts)))


def test_awkward_rows(spark):
    rows = {}
    for r in substrings.dedup_substrings(frame(spark, extra=True)).collect():
        rows.setdefault(r["doc_id"], []).append(r)
    assert sum(map(len, rows.values())) == len(awkward())
    null = max(rows[None], key=lambda r: r["n_words"])
    assert null["n_removed"] == 0                       # a null id comes first
    assert rows[1][0]["n_removed"] == 120 == rows[2][0]["n_removed"]
    assert rows[3][0]["kept"] == "tail"
    assert [x.asDict() for x in rows[9][0]["removed"]] == [{"first": 40, "end": 80}]
    assert all(r["n_words"] == 0 and r["kept"] == "" for i in (4, 5, 6) for r in rows[i])
    assert rows[8][0]["n_words"] == 30000
    assert rows[11][0] == rows[11][1] and rows[11][0]["n_removed"] == 119      # all but the first word
    assert {r["n_words"] for r in rows[14]} == {7, 4}


def test_query_digest_and_empty_table(spark, tmp_path):
    frame(spark, [(1, "b  a", None, None, 0)]).write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op4_substring_dedup(spark, str(tmp_path)).first()
    assert got["kept_sha256"] == hashlib.sha256(b"b a").hexdigest()
    assert run(frame(spark, [])) == []


def test_many_rows_without_an_id(spark):
    """A third of all rows lack an id, half of them equal: marks stay those of each text."""
    from .cases import words
    rows = [(i, " ".join(words(i, 60)), None, None, 0) for i in range(40)]
    rows += [(None, " ".join(words(7, 60) if i % 2 else words(1000 + i, 60)), None, None, 0) for i in range(20)]
    got = substrings.dedup_substrings(frame(spark, rows)).collect()
    assert len(got) == 60 and all(r["n_removed"] == 0 for r in got if r["doc_id"] is None)
    assert {r["doc_id"]: r["n_removed"] for r in got if r["doc_id"] is not None} == {i: 60 * (i == 7) for i in range(40)}
