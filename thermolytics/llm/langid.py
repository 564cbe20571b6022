"""Language identification by segmentation-marginalised unigrams.

Each language has one probability per piece of a fixed public vocabulary (its byte pieces
included, so every text can be cut into pieces). The probability of a word is the sum over all
its segmentations of the product of their pieces' probabilities, from a forward pass over the
word's bytes; that of a text is the product over its words. Probabilities are learned by
expectation-maximisation: forward-backward passes give expected piece counts over all
segmentations of the training words.

Training reads the texts once: words are counted by language in each task, then summed in Spark.
The EM passes run over the distinct words, each task returning one row per language and piece.
What reaches the driver is the model alone: languages x vocabulary numbers (``MAX_LANGS`` bounds
it). Scoring is one pass without a shuffle.

Words are runs of letters (ASCII) and non-ASCII bytes in the lower-cased text. Words of less than
``CHUNK`` bytes are summed many at a time; longer ones, such as text in scripts without spaces, one by one in
logarithms, over all their segmentations as well. The cost is linear in the text.

Cases: null text or text without a letter is ``und`` with score 0, as is every text if nothing
was learned. Rows without lang, text or doc_id teach nothing. Ties go to the language that sorts
first. Equal rows get equal results; other columns are ignored. An empty table gives an empty
result.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize, release
from .common import Numbers, rows, slices, slots

CHUNK = 32              # bytes of a word from which it is summed by itself
ROUNDS = 3              # EM passes
PRIOR = 0.001           # share of the probability that is spread evenly over the vocabulary
MAX_LANGS = 512
SCALE = 32.0            # per byte, keeps products of probabilities near 1
_B = np.uint64(0x9E3779B97F4A7C15)

LETTERS = bytes(i if 97 <= i <= 122 or i >= 128 else 32 for i in range(256))


def vocabulary(path: str | None = None) -> Vocabulary:
    """The pieces of a public vocabulary and all single bytes; a word-start mark counts as byte 1."""
    import public_tokenizers
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path or public_tokenizers.path("piece_bpe_32k.model"))
    pieces = {bytes([i]) for i in range(256)}
    for i in range(sp.get_piece_size()):
        if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i)):
            pieces.add(sp.id_to_piece(i).replace("▁", "\x01").encode())
    return Vocabulary(np.unique(np.array([_hash(p) for p in pieces], np.uint64)), max(map(len, pieces)))


def _hash(piece: bytes) -> int:
    h = 0
    for b in piece:
        h = (h * int(_B) + b + 1) & 0xFFFFFFFFFFFFFFFF
    return h


def _marked(words: list[bytes]) -> tuple[list[int], list[bytes], list[int]]:
    """(places, marked words) of the words of less than ``CHUNK`` bytes, and the places of the longer ones."""
    short = [i for i, w in enumerate(words) if len(w) < CHUNK]
    return short, [b"\x01" + words[i] for i in short], [i for i, w in enumerate(words) if len(w) >= CHUNK]


def _by_length(words: list[bytes]):
    """(positions, byte matrix) of the words of each length."""
    groups = defaultdict(list)
    for i, w in enumerate(words):
        groups[len(w)].append(i)
    for n, at in groups.items():
        for k in range(0, len(at), 8192):
            part = at[k:k + 8192]
            yield np.array(part), np.frombuffer(b"".join(words[i] for i in part), np.uint8).reshape(len(part), n)


class Vocabulary:
    """Sorted piece hashes with a bitmap that sorts out most byte runs that are no piece."""

    def __init__(self, hashes: np.ndarray, longest: int):
        self.hashes = hashes
        self.longest = longest      # bytes of a piece
        self.some = np.zeros(1 << 20, bool)
        self.some[hashes >> np.uint64(44)] = True

    def __len__(self):
        return len(self.hashes)


def _piece_ids(m: np.ndarray, vocab: Vocabulary) -> dict:
    """(start, end) -> (rows, ids) of the words whose bytes from start to end are a piece."""
    k, n = m.shape
    h = np.zeros((n + 1, k), np.uint64)
    for i in range(n):
        h[i + 1] = h[i] * _B + m[:, i].astype(np.uint64) + np.uint64(1)
    power = np.cumprod(np.full(n + 1, _B, np.uint64))
    found = {}
    for j in range(n):
        last = min(n, j + vocab.longest)
        key = h[j + 1:last + 1] - h[j] * power[:last - j, None]
        size, hit = np.nonzero(vocab.some[key >> np.uint64(44)])
        key = key[size, hit]
        at = np.minimum(np.searchsorted(vocab.hashes, key), len(vocab) - 1)
        good = vocab.hashes[at] == key
        size, hit, at = size[good], hit[good], at[good]
        cuts = np.searchsorted(size, np.arange(last - j + 1))
        for d in range(last - j):
            if cuts[d] < cuts[d + 1]:
                found[j, j + d + 1] = hit[cuts[d]:cuts[d + 1]], at[cuts[d]:cuts[d + 1]]
    return found


def _pieces_in(word: bytes, vocab: Vocabulary) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, id) of every piece in a long word, by ascending end. One pass per piece length."""
    h = [0]
    for c in word:
        h.append((h[-1] * int(_B) + c + 1) & 0xFFFFFFFFFFFFFFFF)
    h = np.array(h, np.uint64)
    starts, ends, ids, power = [], [], [], 1
    for n in range(1, min(vocab.longest, len(word)) + 1):
        power = power * int(_B) & 0xFFFFFFFFFFFFFFFF
        key = h[n:] - h[:-n] * np.uint64(power)
        j = np.flatnonzero(vocab.some[key >> np.uint64(44)])
        at = np.minimum(np.searchsorted(vocab.hashes, key[j]), len(vocab) - 1)
        good = vocab.hashes[at] == key[j]
        starts.append(j[good])
        ends.append(j[good] + n)
        ids.append(at[good])
    start, end, piece = (np.concatenate(x) for x in (starts, ends, ids))
    order = np.lexsort((start, end))
    return start[order], end[order], piece[order]


def _log_sums(frm: np.ndarray, to: np.ndarray, logs: np.ndarray, order: np.ndarray, n: int) -> np.ndarray:
    """(n + 1, columns): log of the sum over all ways from ``order[0]`` to each place; pieces lie by ``to`` in that order."""
    out = np.full((n + 1, logs.shape[1]), -np.inf)
    out[order[0]] = 0
    cuts = np.flatnonzero(np.diff(to, prepend=-1, append=-1))
    for lo, hi in zip(cuts[:-1], cuts[1:]):
        x = out[frm[lo:hi]] + logs[lo:hi]
        top = x.max(axis=0)
        out[to[lo]] = top + np.log(np.exp(x - top).sum(axis=0))
    return out


def log_likelihoods(words: list[bytes], vocab: Vocabulary, probs: np.ndarray) -> np.ndarray:
    """(words, languages): log of the scaled sum over all segmentations. Long words are summed in logarithms."""
    short, units, long = _marked(words)
    out = np.zeros((len(words), probs.shape[1]))
    scaled = probs * SCALE
    for at, m in _by_length(units):
        n = m.shape[1]
        alpha = np.zeros((n + 1, len(at), probs.shape[1]))
        alpha[0] = 1
        for (j, i), (hit, ids) in _piece_ids(m, vocab).items():     # by ascending start
            alpha[i, hit] += alpha[j, hit] * scaled[ids]
        out[np.array(short)[at]] = np.log(np.maximum(alpha[n], 1e-300))
    for k in long:
        start, end, ids = _pieces_in(b"\x01" + words[k], vocab)
        n = len(words[k]) + 1
        out[k] = _log_sums(start, end, np.log(np.maximum(scaled[ids], 1e-300)), np.arange(n + 1), n)[n]
    return out


def expected_counts(words: list[bytes], weights: np.ndarray, vocab: Vocabulary, p: np.ndarray) -> np.ndarray:
    """Expected uses of each piece over all segmentations of the words, each counted ``weights`` times."""
    total = np.zeros(len(vocab))
    p = p * SCALE
    short, units, long = _marked(words)
    for at, m in _by_length(units):
        n, k = m.shape[1], len(at)
        alpha, beta = np.zeros((n + 1, k)), np.zeros((n + 1, k))
        alpha[0], beta[n] = 1, 1
        found = [(j, i, hit, ids, p[ids]) for (j, i), (hit, ids) in _piece_ids(m, vocab).items()]
        for j, i, hit, _, prob in found:
            alpha[i, hit] += alpha[j, hit] * prob
        for j, i, hit, _, prob in reversed(found):
            beta[j, hit] += beta[i, hit] * prob
        scale = weights[np.array(short)[at]] / np.maximum(alpha[n], 1e-300)
        every = [alpha[j, hit] * prob * beta[i, hit] * scale[hit] for j, i, hit, _, prob in found]
        total += np.bincount(np.concatenate([x[3] for x in found]), np.concatenate(every), len(vocab))
    for k in long:
        start, end, ids = _pieces_in(b"\x01" + words[k], vocab)
        n = len(words[k]) + 1
        logs = np.log(np.maximum(p[ids], 1e-300))[:, None]
        alpha = _log_sums(start, end, logs, np.arange(n + 1), n)[:, 0]
        back = np.lexsort((end, -start))
        beta = _log_sums(end[back], start[back], logs[back], np.arange(n, -1, -1), n)[:, 0]
        total += np.bincount(ids, weights[k] * np.exp(alpha[start] + logs[:, 0] + beta[end] - alpha[n]), len(vocab))
    return total


def words_of(text: bytes) -> list[bytes]:
    """Words of lower-cased UTF-8 text."""
    return text.translate(LETTERS).split()


def _lowered() -> Column:
    return F.coalesce(F.lower("text").cast("binary"), F.lit(b"")).alias("text")


def word_counts(train: DataFrame) -> DataFrame:
    """(lang, word, n) over all training rows."""
    schema = pa.schema([("lang", pa.string()), ("word", pa.binary()), ("n", pa.int64())])

    def count(batches):
        counts = defaultdict(Counter)
        for b in slices(batches, 2048):
            for lang, text in rows(b, "lang", "text"):
                counts[lang].update(words_of(text))
            if sum(map(len, counts.values())) > 300_000:
                yield from flush(counts)
                counts.clear()
        yield from flush(counts)

    def flush(counts):
        for lang, c in counts.items():
            yield pa.RecordBatch.from_pydict({"lang": [lang] * len(c), "word": list(c), "n": list(c.values())}, schema)

    parts = train.select("lang", _lowered()).mapInArrow(count, "lang string, word binary, n long")
    return parts.groupBy("lang", "word").agg(F.sum("n").alias("n"))


def fit(train: DataFrame, rounds: int = ROUNDS, vocab_path: str | None = None) -> tuple[list[str], Vocabulary, np.ndarray]:
    """(languages, vocabulary, probabilities) learned from the columns text and lang of ``train``."""
    spark = train.sparkSession
    vocab = vocabulary(vocab_path)
    counts = materialize(word_counts(train.where("lang is not null and text is not null")), "langid-words")
    langs = sorted(r["lang"] for r in counts.select("lang").distinct().limit(MAX_LANGS + 1).collect())
    if len(langs) > MAX_LANGS:
        raise ValueError(f"more than {MAX_LANGS} languages")
    index = {x: i for i, x in enumerate(langs)}
    probs = np.full((len(vocab), len(langs)), 1 / len(vocab))
    schema = pa.schema([("lang", pa.string()), ("piece", pa.int32()), ("n", pa.float64())])
    spread = counts.repartition(slots(spark), "word")
    for _ in range(rounds if langs else 0):

        def expect(batches, probs=probs):
            total = {}
            for b in batches:
                groups = defaultdict(lambda: ([], []))
                for lang, word, n in rows(b, "lang", "word", "n"):
                    groups[lang][0].append(word)
                    groups[lang][1].append(n)
                for lang, (words, n) in groups.items():
                    got = expected_counts(words, np.array(n, float), vocab, probs[:, index[lang]])
                    total[lang] = total.get(lang, 0) + got
            for lang, t in total.items():
                at = np.flatnonzero(t)
                yield pa.RecordBatch.from_pydict({"lang": [lang] * len(at), "piece": at.astype(np.int32), "n": t[at]}, schema)

        sums = spread.mapInArrow(expect, "lang string, piece int, n double").groupBy("lang", "piece").agg(F.sum("n").alias("n"))
        new = np.zeros(probs.shape)
        got = sums.toPandas()                                   # at most languages x vocabulary rows
        new[got["piece"].to_numpy(), got["lang"].map(index).to_numpy()] = got["n"].to_numpy()
        probs = (1 - PRIOR) * new / np.maximum(new.sum(axis=0), 1e-300) + PRIOR / len(vocab)
    release(counts)
    return langs, vocab, probs


def predict(docs: DataFrame, model: tuple[list[str], Vocabulary, np.ndarray]) -> DataFrame:
    """(doc_id, lang_pred, score): most probable language and its posterior at equal priors."""
    langs, vocab, probs = model
    kind = docs.schema["doc_id"].dataType
    at = F.when(F.col("text").rlike(r"\p{L}"), F.lower("text").cast("binary"))

    def score(batches):
        known = Numbers()
        table = np.zeros((0, len(langs)))
        for part in slices(batches, 512):
            if len(known) > 300_000:
                known.clear()
                table = table[:0]
            words = [words_of(text or b"") for text in part.column("text").to_pylist()]
            sizes = np.fromiter(map(len, words), np.int64, len(words))
            ids = np.fromiter(map(known.__getitem__, chain.from_iterable(words)), np.int64, int(sizes.sum()))
            new = list(islice(known, len(table), None))
            if new:
                table = np.concatenate([table, log_likelihoods(new, vocab, probs)])
            doc = np.repeat(np.arange(len(sizes)), sizes)
            total = np.stack([np.bincount(doc, table[ids, i], len(sizes)) for i in range(len(langs))], axis=1)
            best = total.argmax(axis=1)
            post = 1 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1)
            blank = part.column("text").is_null().to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(["und" if x else langs[i] for x, i in zip(blank, best)], pa.string()),
                 pa.array(np.where(blank, 0.0, post))], names=["doc_id", "lang_pred", "score"])

    if not langs:
        return docs.select("doc_id", F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    return docs.select("doc_id", at.alias("text")) \
        .mapInArrow(score, f"doc_id {kind.simpleString()}, lang_pred string, score double")


def held_out() -> Column:
    """Every fifth document by CRC-32 of its id; false for a null id."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))


def identify(docs: DataFrame) -> DataFrame:
    """Learn from the labelled documents that are not held out, predict all."""
    model = fit(docs.where(F.col("doc_id").isNotNull() & ~held_out()).select("text", "lang"))
    return predict(docs, model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
