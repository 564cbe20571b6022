import corpus_pipeline as P
from thermolytics.llm import lines, mixing, quality, superminhash
from thermolytics.session import materialize

from .cases import collected, frame
from .test_packing import check_pieces
from .test_superminhash import brute
from ..conftest import SF


def test_stages_on_the_whole_table(spark):
    """Each stage against its rule on its own input, and run() against the stages one by one."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = [n for n, _ in P.STAGES]
    out = {}
    for name, stage in P.STAGES:
        out[name] = (docs, materialize(stage(spark, docs, SF), f"test-{name}"))
        docs = out[name][1]
    for name in names[:-1]:
        assert out[name][1].columns == out[name][0].columns
    before, after = out["quality_classifier"]
    rejected = {r["doc_id"] for r in quality.classify(before).collect() if not r["kept"]}
    assert {r["doc_id"] for r in after.collect()} == {r["doc_id"] for r in before.collect()} - rejected and rejected
    before, after = out["line_dedup"]
    assert after.count() == before.count()
    want = {r["doc_id"]: r["text"] for r in lines.dedup_lines(before).collect()}
    assert {r["doc_id"]: r["text"] for r in after.collect()} == want
    before, after = out["minhash_near_dedup"]
    want = {d for d, _, _, kept in brute([(r["doc_id"], r["text"]) for r in before.collect()], superminhash.PERCENT) if kept}
    assert sorted(r["doc_id"] for r in after.collect()) == sorted(want)
    before, after = out["source_mixing"]
    times = {r["doc_id"]: r["taken"] // r["size"] for r in mixing.mix(before).collect() if r["size"]}
    got = [r["doc_id"] for r in after.collect()]
    assert {d: got.count(d) for d in set(got)} == {d: n for d, n in times.items() if n}
    before, after = out["packing"]
    check_pieces(after.collect(), [(r["doc_id"], r["text"]) for r in before.collect()], 2048)
    whole = P.run(spark, SF).select("doc_id", "start", "length", "ids_crc32")
    assert collected(whole) == collected(after.select("doc_id", "start", "length", "ids_crc32"))


def test_awkward_rows_and_empty_tables(spark):
    for docs in (frame(spark, extra=True), frame(spark, [])):
        columns = docs.columns
        for name, stage in P.STAGES:
            docs = materialize(stage(spark, docs, SF), f"test-{name}")
            assert name == "packing" or docs.columns == columns
