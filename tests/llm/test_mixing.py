import duckdb
import pytest

from thermolytics.llm import mixing, queries

from .cases import awkward, collected, frame, words
from ..conftest import SF


def test_against_sql(spark):
    for sf in (SF, SF.replace("0.001", "0.01")):
        con = duckdb.connect()
        con.execute(f"create view documents as select * from '{sf}/documents.parquet'")
        want = con.execute("select doc_id, size, source_size, target, taken from (" + queries.ORACLE_SQL["op8_source_mixing"] + ")").fetchall()
        got = collected(queries.op8_source_mixing(spark, sf))
        assert sorted(r[:3] + r[4:] for r in got) == sorted(r[:3] + r[4:] for r in want)
        assert [r[3] for r in sorted(got)] == pytest.approx([r[3] for r in sorted(want)])


def reshared(sizes, weights, total, epochs=2):
    """Targets by sharing the excess again and again."""
    target, left, free = dict.fromkeys(sizes, 0.0), total, set(sizes)
    while left > 1e-9 and free:
        w = sum(weights[s] for s in free)
        for s in list(free):
            target[s] += left * weights[s] / w
        left = 0
        for s in list(free):
            if target[s] >= epochs * sizes[s]:
                left += target[s] - epochs * sizes[s]
                target[s] = epochs * sizes[s]
                free.discard(s)
    return target


@pytest.mark.parametrize("sizes", [[100] * 6, [1, 1000, 5, 70, 3, 3, 900], [0, 10, 0, 5], [7], [0, 0], [1, 2, 4, 8, 16, 32, 64, 128]])
def test_targets_are_water_filled(spark, sizes):
    names = [None if i == len(sizes) - 1 else f"s{i:02}" for i in range(len(sizes))]
    rows = mixing.source_targets(spark.createDataFrame(list(zip(names, sizes)), "source string, source_size long")).collect()
    by = dict(zip(names, sizes))
    want = reshared(by, {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}, 1.5 * sum(sizes))
    assert {r["source"]: pytest.approx(want[r["source"]], abs=1e-6) for r in rows} == {r["source"]: r["target"] for r in rows}


def test_taken_words_come_near_targets(spark):
    rows = [(i, " ".join(words(i, 1 + i % 37)), "en", "hot" if i % 3 == 0 else f"s{i % 7}", 0) for i in range(3000)]
    got = mixing.mix(frame(spark, rows)).collect()
    assert all(r["taken"] in (0, r["size"], 2 * r["size"]) for r in got)
    sums = {}
    for r in got:
        t = sums.setdefault(r["source"], [r["target"], 0])
        t[1] += r["taken"]
    assert all(abs(target - taken) <= 37 for target, taken in sums.values())
    assert collected(mixing.mix(frame(spark, rows[::-1]))) == sorted((tuple(r) for r in got), key=repr)     # layout does not matter


def test_awkward_rows(spark):
    docs = frame(spark, extra=True)
    got = mixing.mix(docs).collect()
    assert len(got) == len(awkward())
    assert all(r["size"] == 0 == r["taken"] for r in got if r["doc_id"] in (4, 5, 6))
    odd = next(r[1] for r in awkward() if r[0] == 12)                   # with spaces that do not cut words
    assert {r["size"] for r in got if r["doc_id"] == 12} == {len(odd.encode().split())} != {len(odd.split())}
    assert all(0 <= r["taken"] <= 2 * r["size"] for r in got)
    assert len({tuple(r) for r in got if r["doc_id"] == 11}) == 1
    out = mixing.sample(docs)
    assert out.columns == docs.columns
    taken = sum(r["taken"] for r in got)
    assert out.select(mixing.doc_size().alias("n")).groupBy().sum("n").first()[0] == taken


def test_empty_tables(spark):
    assert collected(mixing.mix(frame(spark, []))) == []
    assert collected(mixing.sample(frame(spark, []))) == []
    zero = mixing.mix(frame(spark, [(1, None, None, "a", 0), (2, "", None, None, 0)])).collect()
    assert [(r["size"], r["target"], r["taken"]) for r in zero] == [(0, 0.0, 0)] * 2
