import zlib

import numpy as np
import pytest

from thermolytics.llm import langid

from .cases import awkward, collected, frame, words
from ..conftest import SF


def pieces(unit, vocab):
    """(start, end, id) of every piece in the word, whatever its length."""
    for i in range(1, len(unit) + 1):
        for j in range(i):
            k = np.searchsorted(vocab.hashes, np.uint64(langid._hash(unit[j:i])))
            if k < len(vocab) and vocab.hashes[k] == np.uint64(langid._hash(unit[j:i])):
                yield j, i, k


def brute(unit, vocab, p):
    """Log of the sum over all segmentations, with no bound on pieces or words."""
    a = [0.0] + [-np.inf] * len(unit)
    for j, i, k in pieces(unit, vocab):
        a[i] = np.logaddexp(a[i], a[j] + np.log(p[k] * langid.SCALE))
    return a[-1]


def longest_piece():
    import public_tokenizers
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    every = [sp.id_to_piece(i).replace("▁", "") for i in range(sp.get_piece_size()) if not sp.is_byte(i)]
    return max((x for x in every if x), key=lambda x: len(x.encode()))


GIVEN = ["hello", "über", "a", "internationalisation" * 4, "日本語テキスト", "x" * 100, "q" * 31, "q" * 32, "これは長い文です" * 6, "ü" * 40]


def test_forward_sums_all_segmentations():
    vocab = langid.vocabulary()
    p = np.random.default_rng(0).random((len(vocab), 2))
    p /= p.sum(axis=0)
    given = [w.encode() for w in [*GIVEN, longest_piece(), "ab" + longest_piece() + "日本"]]
    assert max(map(len, given)) > 100 and vocab.longest > 16
    got = langid.log_likelihoods(given, vocab, p)
    for w, g in zip(given, got):
        assert np.allclose(g, [brute(b"\x01" + w, vocab, p[:, i]) for i in range(2)])


def test_expected_counts_of_long_words():
    """Short and long words alike: counts weighted by piece length cover each byte once, and equal those by differences."""
    vocab = langid.vocabulary()
    p = np.random.default_rng(1).random(len(vocab))
    p /= p.sum()
    for w in (b"hello", "これは長い文です".encode() * 3, b"internationalisation" * 2):
        unit = b"\x01" + w
        counts = langid.expected_counts([w], np.array([2.0]), vocab, p)
        sizes = {k: i - j for j, i, k in pieces(unit, vocab)}
        assert np.isclose(sum(counts[k] * n for k, n in sizes.items()), 2 * len(unit))
        k = max(sizes, key=lambda k: counts[k])
        more = p.copy()
        more[k] *= 1 + 1e-6     # the expected count is the slope of the log sum
        assert np.isclose((brute(unit, vocab, more) - brute(unit, vocab, p)) / 1e-6, counts[k] / 2, rtol=1e-3)


def test_expected_counts_cover_every_byte_once():
    vocab = langid.vocabulary()
    p = np.full(len(vocab), 1 / len(vocab))
    counts = langid.expected_counts([b"hello"], np.array([3.0]), vocab, p)
    one_byte = [np.searchsorted(vocab.hashes, np.uint64(langid._hash(bytes([b])))) for b in b"\x01helo"]
    assert counts.sum() > 3 and counts[one_byte].sum() < counts.sum()
    lengths = {}
    for j in range(6):
        for i in range(j + 1, 7):
            k = np.searchsorted(vocab.hashes, np.uint64(langid._hash(b"\x01hello"[j:i])))
            if k < len(vocab) and vocab.hashes[k] == np.uint64(langid._hash(b"\x01hello"[j:i])):
                lengths[k] = i - j
    assert np.isclose(sum(counts[k] * n for k, n in lengths.items()), 3 * 6)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = langid.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert len(got) > 20
    assert sum(r["lang_pred"] == r["lang"] for r in got) >= 0.95 * len(got)
    assert all(0 <= r["score"] <= 1 for r in got)


def test_awkward_rows(spark):
    got = langid.identify(frame(spark, extra=True)).collect()
    assert len(got) == len(awkward())
    by_id = {r["doc_id"]: r for r in got}
    for i in (4, 5, 6, 13):
        assert (by_id[i]["lang_pred"], by_id[i]["score"]) == ("und", 0.0)
    assert by_id[8]["lang_pred"] in ("de", "en")
    for i in range(15):
        assert by_id[i]["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0)
    assert by_id[None]["held_out"] is False
    assert len({tuple(r) for r in got if r["doc_id"] == 11}) == 1


def test_learns_only_from_rows_not_held_out(spark):
    ids = [i for i in range(60) if zlib.crc32(str(i).encode()) % 5 == 0]
    docs = frame(spark, [(i, " ".join(words(i, 20)), "zz" if i in ids else "en", None, 0) for i in range(60)])
    assert {r["lang_pred"] for r in langid.identify(docs).collect()} == {"en"}


@pytest.mark.parametrize("rows", [[], [(1, "text", None, None, 0)]])
def test_nothing_to_learn(spark, rows):
    assert [r[2:] for r in collected(langid.identify(frame(spark, rows)))] == [("und", 0.0)] * len(rows)
