import duckdb

from thermolytics.llm import lines, queries

from .cases import awkward, collected, frame, words
from ..conftest import SF


def test_against_sql(spark):
    for sf in (SF, SF.replace("0.001", "0.01")):
        con = duckdb.connect()
        con.execute(f"create view documents as select * from '{sf}/documents.parquet'")
        want = sorted(map(tuple, con.execute("select doc_id, n_lines, n_dropped, kept_sha256 from ("
                                             + queries.ORACLE_SQL["op5_line_dedup"] + ")").fetchall()))
        got = collected(queries.op5_line_dedup(spark, sf))
        assert sorted(got) == want


def corpus(n=60):
    """Documents of own lines with a footer that varies in a number and a word, and a log line."""
    rows = []
    for i in range(n):
        own = [" ".join(words(1000 + 5 * i + j, 9)) for j in range(4)]
        own.insert(2, f"Page {i} of 60 was printed on day {i % 7}")
        own.insert(4, f"Today at noon user {words(i, 1)[0]} logged in from the front office")
        rows.append((i, "\n".join(own), "en", "s", 0))
    return rows


def test_templates_with_variable_fields_are_dropped_everywhere(spark):
    rows = corpus()
    for r in lines.dedup_lines(frame(spark, rows)).collect():
        left = rows[r["doc_id"]][1].split("\n")
        assert r["text"].split("\n") == [x for i, x in enumerate(left) if i not in (2, 4)]
        assert (r["n_lines"], r["n_dropped"]) == (6, 2)


def test_copies_of_documents_are_no_templates(spark):
    """A third of all rows are copies of one document: its lines stand in one context only."""
    rows = corpus() + [(100 + i, "\n".join(" ".join(words(j, 9)) for j in range(5)), "en", "s", 0) for i in range(30)]
    got = {r["doc_id"]: r["n_dropped"] for r in lines.dedup_lines(frame(spark, rows)).collect()}
    assert all(got[100 + i] == 0 for i in range(30)) and got[5] == 2


def test_a_line_repeated_in_one_document_stays(spark):
    rows = corpus(10) + [(50, "\n".join(f"{a}\nthe same line of one document" for a in words(3, 60)), "en", "s", 0)]
    assert {r["n_dropped"] for r in lines.dedup_lines(frame(spark, rows)).collect()} == {0}


def test_one_very_common_line(spark):
    rows = [(i, f"{' '.join(words(i, 8))}\nall rights are reserved here\n{' '.join(words(-i - 1, 8))}", "en", "s", 0) for i in range(300)]
    got = lines.dedup_lines(frame(spark, rows)).collect()
    assert all(r["n_dropped"] == 1 and "rights" not in r["text"] for r in got)


def test_awkward_rows_and_empty_table(spark):
    docs = frame(spark, extra=True)
    out = lines.dedup_lines(docs, min_docs=1)
    got = out.collect()
    assert out.columns == docs.columns + ["n_lines_", "n_dropped"]
    assert len(got) == len(awkward())
    by_id = {r["doc_id"]: r for r in got}
    assert by_id[4]["text"] is None and by_id[4]["n_lines_"] == 0
    assert by_id[5]["text"] == "" and by_id[5]["n_lines_"] == 1
    assert by_id[6]["text"] == " \t\n \x0b"                                  # blank lines stay
    assert by_id[None]["text"] is not None
    assert len({tuple(r) for r in got if r["doc_id"] == 11}) == 1
    assert collected(lines.dedup_lines(frame(spark, []))) == []


def test_many_lines_in_one_document(spark):
    """Flags are linear in the lines: 30,000 lines of which a third recur."""
    footer = "this footer stands in every document"
    long = "\n".join(f"{i} own\n{footer} indeed\n{i + 1} more" for i in range(10000))
    rows = [(1, long, "en", "s", 0)] + [(10 + i, f"{words(i, 5)}\n{footer} indeed\n{words(i + 99, 5)}", "en", "s", 0) for i in range(40)]
    got = {r["doc_id"]: r for r in lines.dedup_lines(frame(spark, rows)).collect()}
    assert got[1]["n_dropped"] == 10000 and got[1]["text"].count("\n") == 19999


HEAD, FOOT = ["welcome to our site again"], ["all rights are reserved here", "please mind the house rules", "see you again next time"]


def blocks():
    """60 documents between a header and a footer of three lines, 60 with a line between blank ones, 3 of the footer alone."""
    own = lambda i: [" ".join(words(7000 + 5 * i + j, 9)) for j in range(4)]
    rows = [(i, "\n".join(HEAD + own(i) + FOOT), "en", "s", 0) for i in range(60)]
    rows += [(i, "\n\n".join(own(i)[:2] + ["subscribe to the weekly letter"] + own(i)[2:]), "en", "s", 0) for i in range(60, 120)]
    return rows + [(200 + i, FOOT[i], "en", "s", 0) for i in range(3)]


def test_blocks_and_lines_between_blank_ones_are_dropped(spark):
    got = {r["doc_id"]: r for r in lines.dedup_lines(frame(spark, blocks())).collect()}
    assert all(got[i]["n_dropped"] == 4 and got[i]["text"].count("\n") == 3 for i in range(60))
    assert all(got[i]["n_dropped"] == 1 and "weekly" not in got[i]["text"] for i in range(60, 120))
    assert all(got[200 + i]["text"] == "" for i in range(3))


def test_query_drops_blocks(spark, tmp_path):
    """The registered query counts lines inside blocks by documents too."""
    frame(spark, blocks()).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: r["n_dropped"] for r in queries.op5_line_dedup(spark, str(tmp_path)).collect()}
    assert all(got[i] == 4 for i in range(60)) and all(got[i] == 1 for i in range(60, 120))


def test_near_copies_are_no_templates(spark):
    """60 near copies of a document, a line of its own in each: their common lines stay, the footer goes."""
    body = [" ".join(words(8000 + j, 9)) for j in range(30)]
    near = [(300 + i, "\n".join(body[:i % 28 + 1] + [" ".join(words(9000 + i, 9))] + body[i % 28 + 2:] + FOOT), "en", "s", 0) for i in range(60)]
    got = {r["doc_id"]: r for r in lines.dedup_lines(frame(spark, blocks() + near)).collect()}
    assert all(got[300 + i]["n_dropped"] == 3 for i in range(60))
    before = {r["doc_id"]: r for r in lines.dedup_lines(frame(spark, near), by_document=False).collect()}
    after = {r["doc_id"]: r for r in lines.dedup_lines(frame(spark, near)).collect()}
    assert before == after
