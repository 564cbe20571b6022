import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from thermolytics.llm import packing

from .cases import awkward, frame, words
from ..conftest import SF

TOKENIZER = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def ids_of(text):
    return np.array(TOKENIZER.encode(text or "", add_special_tokens=False).ids + [1], "<u4")


def check_pieces(pieces, docs, window):
    """Each id of each (doc_id, text) lies in one piece, sequences have no gaps; returns the padding."""
    from collections import defaultdict
    for_doc, by_seq = defaultdict(list), defaultdict(list)
    for p in pieces:
        for_doc[p["doc_id"]].append(p)
        by_seq[p["sequence_id"]].append(p)
    assert set(for_doc) == {d for d, _ in docs}
    texts = defaultdict(list)
    for d, t in docs:
        texts[d].append(ids_of(t))
    for d, got in for_doc.items():
        assert sum(p["length"] for p in got) == sum(map(len, texts[d]))
        if len(texts[d]) == 1:
            ids, at = texts[d][0], 0
            for p in sorted(got, key=lambda p: p["start"]):
                assert p["start"] == at and p["length"] > 0 and p["doc_tokens"] == len(ids)
                at += p["length"]
                assert p["ids_crc32"] == zlib.crc32(ids[p["start"]:at].tobytes())
    padding = 0
    for got in by_seq.values():
        at = 0
        for p in sorted(got, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= window
        padding += 0 if at & (at - 1) == 0 else window - at
    return padding


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    given = [(r["doc_id"], r["text"]) for r in docs.collect()]
    pieces = packing.pack(docs).collect()
    assert check_pieces(pieces, given, 2048) <= 2048


def test_awkward_rows_and_small_window(spark):
    pieces = packing.pack(frame(spark, extra=True), window=64, shard=4).collect()
    check_pieces(pieces, [(r[0], r[1]) for r in awkward()], 64)


def test_words_can_be_tokenised_one_by_one():
    encoder = packing.WordIds(public_tokenizers.path("word_bpe_49k.json"), most=5)
    texts = ["a<|endoftext|>b <|startoftext|>", "é ́x ΣΑΣ", "İI z\x85k", "日本語 テキスト", "", " \n", "it's they'll"]
    for _ in range(2):
        for t, got in zip(texts, encoder.ids([t.encode() for t in texts])):
            assert got.tolist() == ids_of(t)[:-1].tolist()


def test_neighbours_share_a_window(spark):
    """Documents of two vocabularies, in mixed order: windows do not mix them until one runs out."""
    rows = [(i, " ".join(words(900 + i % 2, 400)[(i // 2) % 50:][:200]), "en", None, 0) for i in range(40)]
    pieces = packing.pack(frame(spark, rows), window=2048, shard=100).collect()
    kinds = {}
    for p in pieces:
        kinds.setdefault(p["sequence_id"], set()).add(p["doc_id"] % 2)
    assert sum(len(k) > 1 for k in kinds.values()) <= 1


def test_bm25_against_brute_force():
    rng = np.random.default_rng(0)
    docs = [rng.integers(0, 30, rng.integers(1, 20)).astype(np.uint32) for _ in range(25)]
    df = np.bincount(np.concatenate([np.unique(d) for d in docs]), minlength=30)
    mean = np.mean([len(d) for d in docs])
    index = packing.Index(docs, df, len(docs), mean)
    idf = np.log1p((len(docs) - df + 0.5) / (df + 0.5))
    for seed in range(25):
        terms = np.unique(docs[seed])
        score = [sum(idf[t] * (d == t).sum() * 2.2 / ((d == t).sum() + 1.2 * (0.25 + 0.75 * len(d) / mean)) for t in terms) for d in docs]
        unused = rng.random(25) < 0.7
        got = index.neighbours(seed, unused)
        assert set(got) == {i for i in range(25) if unused[i] and score[i] > 0}
        assert all(score[a] >= score[b] - 1e-9 for a, b in zip(got, got[1:]))


def test_empty_table(spark):
    assert packing.pack(frame(spark, [])).collect() == []


@pytest.mark.parametrize("n", [2046, 2047, 2048, 4095])
def test_full_windows(spark, n):
    """Documents that just fill, or just miss, their windows."""
    word = next(w for w in ("the", "a", "of") if len(ids_of(w)) == 2)
    docs = [(1, " ".join([word] * n)), (2, word)]
    pieces = packing.pack(frame(spark, [(i, t, None, None, 0) for i, t in docs])).collect()
    check_pieces(pieces, docs, 2048)


def test_words_are_looked_up_once_per_call():
    """Not once per occurrence; blanks around a text and texts without words give nothing more."""
    import pyarrow as pa

    class Counting(packing.Numbers):
        asked = 0

        def __getitem__(self, key):
            self.asked += 1
            return super().__getitem__(key)

    encoder = packing.WordIds(public_tokenizers.path("word_bpe_49k.json"))
    assert [x.tolist() for x in encoder.ids([b""])] == [[]]
    encoder.known = Counting(encoder.known)
    texts = ["the cat the cat " * 50, " The\x0bcat\r\n", "", "the<|endoftext|>The"]
    got = encoder.ids(pa.array([None, *[t.encode() for t in texts]], pa.binary()).slice(1))
    assert [x.tolist() for x in got] == [ids_of(t)[:-1].tolist() for t in texts]
    assert encoder.known.asked <= 5
