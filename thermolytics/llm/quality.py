"""Quality classifier from weak labels: EM over heuristic labellers, then a hashed linear scorer.

Overlapping heuristics each vote that a document is bad, or good, or abstain. Their votes make a pattern;
patterns are counted in Spark (at most 3 ** labellers of them, whatever the input). With the
class unknown, expectation-maximisation over the pattern counts estimates how often each labeller votes
which way on either class, and so the posterior of each pattern. The posteriors are the labels on
which the scorer is trained: a logistic model over hashed features (shapes of words, and levels
of the document's statistics). No gold label is used.

The votes of all documents are counted. The scorer is fitted on at most about ``SAMPLE`` different texts,
those whose 64-bit hash is smallest, in the order of their hashes and each weighted by its number of
copies. So neither the files that rows lie in nor their order or partitions change a score.

The fixed function words are those of four languages. A language (column lang, where there is one) with
``LEAST_DOCUMENTS`` documents, many of which lack them, has the short words that stand in many of its documents
taken as well, for its own documents only; documents of rarer languages are held against the fixed words.
Scripts without spaces are read by the character.

Scoring is a column function of the text, so a filter by it moves no rows.

Cases: null text and text without words are scored 0 and rejected. An empty table gives an empty
result. Equal texts of one language get equal scores; documents scored exactly ``CUT`` stay. Other
columns are ignored. Texts are read whole.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import materialize, release
from .common import rows as rows_of
from .common import run_hashes, slices, utf8, word_hashes

DIM = 1 << 13
ROUNDS = 60             # of EM at most
SAMPLE = 40_000         # different texts that the scorer is fitted on
EPOCHS, STEPS = 12, 400 # passes over the sample, and steps at least
BATCH = 256
RATE = 0.5
FALSE_ALARMS = 0.001    # most that a labeller may call bad of the good documents
CUT = 0.2               # documents scored below are rejected: only clear cases
FEW_FUNCTION_WORDS = 0.04
LACKING = 0.25          # share of a language's documents below that, from which on its own words are learned
FREQUENT = 0.2          # share of a language's documents that a frequent word stands in
SHORT = 6               # characters of a frequent word at most
LEAST_DOCUMENTS = 20    # of a language whose own words are learned
MOST_LANGUAGES = 500    # the most frequent ones, for whom words are learned
MOST_WORDS = 200        # learned of a language, the most frequent ones

#: Frequent function words of English, German, French and Spanish.
FUNCTION_WORDS = frozenset(
    b"the of and to in a is that it for on was with as by be this are at from or an not have but "
    b"der die und das den von zu mit sich des auf ist im dem nicht ein eine als auch es an er so dass "
    b"le la les de et des en un une du que qui dans pour sur au par est il ne se pas plus elle avec ou son "
    b"el los y del se las por con una su para al lo como mas o pero sus".split())

#: Letters of scripts without spaces: Thai, Lao, Burmese, Khmer, kana and Han.
UNSPACED = re.compile("([\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff\U00020000-\U0003ffff])")
_LEADS = bytes([0xE0, 0xE1, *range(0xE3, 0xEA), 0xF0])      # first bytes of their letters
_FURTHER = bytes(range(0x80, 0xC0))                         # bytes of a character after its first

SYMBOLS = b"#$%&*+<=>@[\\]^_`{|}~"
_SHAPE = bytes(97 if 97 <= i <= 122 or i >= 128 else 65 if 65 <= i <= 90 else 48 if 48 <= i <= 57 else i for i in range(256))

LABELLERS = ("symbols", "capitals", "function_words", "repetition", "separators", "exclamation", "word_length", "lines")


def spaced(text: bytes) -> tuple[bytes, int]:
    """The text with spaces around letters of scripts without them, and how many there are."""
    if text.isascii() or len(text.translate(None, _LEADS)) == len(text):
        return text, 0
    out, n = UNSPACED.subn(r" \1 ", text.decode("utf-8", "replace"))
    return (out.encode(), n) if n else (text, 0)


def plain_words(text: bytes) -> list[bytes]:
    """Words as they are looked up: lower-case, without punctuation."""
    if not text.isascii():
        text = text.decode("utf-8", "replace").lower().encode()
    return text.lower().translate(None, b".,;:!?\"'()").split()


def statistics(text: bytes, frequent: frozenset = FUNCTION_WORDS) -> tuple[int, dict[str, float], list[bytes]]:
    """(words, the labellers' measures, words)."""
    text, single = spaced(text)
    words = text.split()
    n = len(words)
    if not n:
        return 0, dict.fromkeys(LABELLERS, 0.0), words
    size = len(text)
    shape = text.translate(_SHAPE)
    lower, upper = shape.count(b"a"), shape.count(b"A")
    further = size - len(text.translate(None, _FURTHER))
    runs = run_hashes(word_hashes(words), 5)
    lines = [x for x in text.split(b"\n") if x.strip()]
    return n, {
        "symbols": (size - len(text.translate(None, SYMBOLS))) / size,
        "capitals": upper / max(1, lower + upper),
        "function_words": sum(w in frequent for w in plain_words(text)) / n,
        "repetition": 1 - len(np.unique(runs)) / len(runs) if len(runs) else 0.0,
        "separators": sum(len(w) == 1 and not w.isalnum() and w < b"\x80" for w in words) / n,
        "exclamation": text.count(b"!") / n,
        "word_length": (lower + upper - further) / (n - single + single / 3),    # three letters as a word where unspaced
        "lines": sum(len(x.split()) < 3 for x in lines) / len(lines) if len(lines) > 3 else 0.0,
    }, words


def votes(n: int, s: dict[str, float]) -> np.ndarray:
    """Each labeller's vote: 0 abstains, 1 bad, 2 good."""
    bad = np.array([s["symbols"] > 0.03, s["capitals"] > 0.5, n >= 20 and s["function_words"] < FEW_FUNCTION_WORDS,
                    n >= 20 and s["repetition"] > 0.4, s["separators"] > 0.1, s["exclamation"] > 0.25,
                    not 2 <= s["word_length"] <= 14, s["lines"] > 0.6])
    good = np.array([s["symbols"] < 0.005, False, s["function_words"] > 0.08, False, False, False, False, False])
    return np.where(bad, 1, np.where(good, 2, 0))


def pattern(v: np.ndarray) -> int:
    return int((v * 3 ** np.arange(len(v))).sum())


def features(n: int, s: dict[str, float], words: list[bytes], known: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features: shares of word shapes, and one level per statistic."""
    shapes = Counter(b" ".join(words).translate(_SHAPE).split())
    if len(known) > 200_000:
        known.clear()
    for x in shapes:
        if x not in known:
            known[x] = int(word_hashes([x])[0]) % DIM
    levels = [b"%s=%d" % (k.encode(), min(20, int(v * (1 if k == "word_length" else 20)))) for k, v in s.items()]
    at = [known[x] for x in shapes] + (word_hashes(levels) % np.uint64(DIM)).astype(int).tolist()
    weight = np.sqrt([c / n for c in shapes.values()]).tolist() + [1.0] * len(levels)
    return np.array(at, np.int64), np.array(weight)


def _lang(docs: DataFrame) -> Column:
    return F.coalesce(F.col("lang").cast("string"), F.lit("")) if "lang" in docs.columns else F.lit("")


def frequent_words(docs: DataFrame) -> dict[str, frozenset]:
    """By language: the fixed function words with its own frequent words, for the languages that often lack these."""
    def count(batches):
        found = defaultdict(Counter)
        for b in slices(batches):
            for lang, text in rows_of(b, "lang", "text"):
                words = plain_words(spaced(text)[0])
                if len(words) < 20:
                    continue
                found[lang][""] += 1
                if sum(w in FUNCTION_WORDS for w in words) < FEW_FUNCTION_WORDS * len(words):
                    found[lang][" "] += 1
                    one = {w.decode("utf-8", "replace") for w in set(words)}
                    found[lang].update(w for w in one if len(w) <= SHORT and w.isalpha())
            if sum(map(len, found.values())) > 300_000:
                yield from flush(found)
                found.clear()
        yield from flush(found)

    def flush(found):
        for lang, c in found.items():
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(c), pa.string()), pa.array(list(c), pa.string()),
                                              pa.array(list(c.values()), pa.int64())], names=["lang", "word", "n"])

    counts = docs.select(_lang(docs).alias("lang"), utf8().alias("text")).mapInArrow(count, "lang string, word string, n long")
    counts = materialize(counts.groupBy("lang", "word").agg(F.sum("n").alias("n")), "quality-words")
    lacking = counts.where("word in ('', ' ')").groupBy("lang") \
        .agg(F.sum(F.when(F.col("word") == "", F.col("n"))).alias("all"), F.sum(F.when(F.col("word") == " ", F.col("n"))).alias("low")) \
        .where((F.col("low") > LACKING * F.col("all")) & (F.col("all") >= LEAST_DOCUMENTS)) \
        .orderBy(F.desc("all"), "lang").limit(MOST_LANGUAGES)
    words = counts.where("word not in ('', ' ')").join(F.broadcast(lacking), "lang").where(F.col("n") >= FREQUENT * F.col("low"))
    first = W.partitionBy("lang").orderBy(F.desc("n"), "word")      # words that many documents of one language share
    words = words.withColumn("i", F.row_number().over(first)).where(F.col("i") <= MOST_WORDS)
    own = defaultdict(set)
    for r in words.select("lang", "word").collect():                # at most MOST_LANGUAGES * MOST_WORDS
        own[r["lang"]].add(r["word"].encode())
    release(counts)
    return {lang: FUNCTION_WORDS | some for lang, some in own.items()}


def labelled(docs: DataFrame, frequent: dict[str, frozenset]) -> DataFrame:
    """(h, pattern, at, weight, n): hash, vote pattern and hashed features of each different text with words in
    each language group, and its number of copies."""
    def make(batches):
        known: dict[bytes, int] = {}
        for b in slices(batches):
            out = []
            for h, lang, text in rows_of(b, "h", "lang", "text"):
                n, s, words = statistics(text, frequent.get(lang, FUNCTION_WORDS))
                if n:
                    at, weight = features(n, s, words, known)
                    out.append((h, pattern(votes(n, s)), at.astype(np.uint16).tobytes(), weight.astype(np.float32).tobytes()))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names=["h", "pattern", "at", "weight"])

    # Languages with the same words give a text the same features.
    lang = F.when(_lang(docs).isin(list(frequent)), _lang(docs)).otherwise(F.lit(""))
    rows = docs.select(lang.alias("lang"), utf8().alias("text")).withColumn("h", F.xxhash64("text", "lang"))
    rows = rows.mapInArrow(make, "h long, pattern long, at binary, weight binary")
    return rows.groupBy("h").agg(F.first("pattern").alias("pattern"), F.first("at").alias("at"), F.first("weight").alias("weight"),
                                 F.count(F.lit(1)).alias("n"))


def estimate(patterns: np.ndarray, counts: np.ndarray, rounds: int = ROUNDS) -> tuple[dict[int, float], np.ndarray]:
    """(posterior of good by pattern, vote probabilities by labeller, class and vote), by EM.

    The first guess takes a document with any vote for bad as bad. The share of good documents
    that a labeller calls bad stays at most ``FALSE_ALARMS``: without that bound EM may explain a
    labeller that fires alone on its kind of junk as one that often errs.
    """
    k = len(LABELLERS)
    v = (patterns[:, None] // 3 ** np.arange(k)) % 3
    good = np.where((v == 1).any(axis=1), 0.05, 0.95)
    table = np.zeros((k, 2, 3))
    for _ in range(rounds):
        both = np.stack([1 - good, good], axis=1) * counts[:, None]
        for j in range(k):
            for vote in range(3):
                table[j, :, vote] = both[v[:, j] == vote].sum(axis=0) + 0.01
        table /= table.sum(axis=2, keepdims=True)
        over = np.maximum(table[:, 1, 1] - FALSE_ALARMS, 0)
        table[:, 1, 1] -= over
        table[:, 1, 0] += over
        prior = (both.sum(axis=0) + 1) / (both.sum() + 2)
        log = np.log(prior) + sum(np.log(table[j, :, :].T[v[:, j]]) for j in range(k))
        new = 1 / (1 + np.exp(np.clip(log[:, 0] - log[:, 1], -50, 50)))
        if np.abs(new - good).max(initial=0) < 1e-6:
            break
        good = new
    return {int(p): float(g) for p, g in zip(patterns, good)}, table


def descend(at: list[np.ndarray], weight: list[np.ndarray], y: np.ndarray, copies: np.ndarray) -> np.ndarray:
    """Weights of the linear scorer by minibatch descent over the rows in their order."""
    w, grad = np.zeros(DIM + 1), np.full(DIM + 1, 1e-3)
    batches = []
    for i in range(0, len(y), BATCH):
        n = len(y[i:i + BATCH])
        row = np.repeat(np.arange(n), [len(x) for x in at[i:i + BATCH]])
        batches.append((n, row, np.concatenate(at[i:i + BATCH]).astype(np.int64), np.concatenate(weight[i:i + BATCH]).astype(np.float64),
                        y[i:i + BATCH], copies[i:i + BATCH] / copies[i:i + BATCH].sum()))
    for _ in range(max(EPOCHS, -(-STEPS // max(1, len(batches))))):
        for n, row, a, x, goal, share in batches:
            margin = w[DIM] + np.bincount(row, w[a] * x, n)
            off = (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - goal) * share
            g = np.append(np.bincount(a, off[row] * x, DIM), off.sum()) + 1e-5 * w
            grad += g * g
            w -= RATE * g / np.sqrt(grad)
    return w


def fit(docs: DataFrame) -> tuple[np.ndarray, np.ndarray, dict[int, float], dict[str, frozenset]]:
    """(weights, vote table, posterior by pattern, frequent words by language) from all documents."""
    frequent = frequent_words(docs)
    rows, different = materialize(labelled(docs, frequent), "quality-rows", count=True)
    counts = rows.groupBy("pattern").agg(F.sum("n").alias("n")).toPandas().sort_values("pattern")      # at most 3 ** labellers rows
    posterior, table = estimate(counts["pattern"].to_numpy(np.int64), counts["n"].to_numpy(float))
    # Smallest hashes up to a bound that leaves SAMPLE of them on average.
    if different > SAMPLE:
        rows_in = rows.where(F.col("h") < int((SAMPLE / different - 0.5) * 2 ** 64))
    else:
        rows_in = rows
    got = rows_in.toArrow().sort_by("h")
    at = [np.frombuffer(x, np.uint16) for x in got.column("at").to_pylist()]
    weight = [np.frombuffer(x, np.float32) for x in got.column("weight").to_pylist()]
    y = np.array([posterior[p] for p in got.column("pattern").to_pylist()])
    weights = descend(at, weight, y, got.column("n").to_numpy().astype(float)) if len(y) else np.zeros(DIM + 1)
    release(rows)
    return weights, table, posterior, frequent


def scorer(model, lang: Column, text: str = "text") -> Column:
    """struct(score, posterior, votes) of a text and its language: probability of good by the scorer and by the votes."""
    weights, _, posterior, frequent = model

    @F.pandas_udf("score double, posterior double, votes string")
    def score(texts: pd.Series, langs: pd.Series) -> pd.DataFrame:
        known, out = {}, []
        for t, name in zip(texts, langs):
            n, s, words = statistics(t, frequent.get(name, FUNCTION_WORDS))
            if not n:
                out.append((0.0, None, None))
                continue
            v = votes(n, s)
            at, x = features(n, s, words, known)
            margin = weights[DIM] + (weights[at] * x).sum()
            out.append((1 / (1 + np.exp(-np.clip(margin, -30, 30))), posterior.get(pattern(v)), "".join("-bg"[i] for i in v)))
        return pd.DataFrame(out, columns=["score", "posterior", "votes"])

    return score(utf8(text), lang)


def classify(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, score, posterior, votes, kept."""
    out = docs.select("doc_id", scorer(fit(docs), _lang(docs)).alias("s")).select("doc_id", "s.*")
    return out.withColumn("kept", F.col("score") >= CUT)


def keep_good(docs: DataFrame) -> DataFrame:
    """``docs`` without the documents that the scorer rejects."""
    return docs.where(scorer(fit(docs), _lang(docs))["score"] >= CUT)
