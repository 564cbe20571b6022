"""Lexical retrieval packing: windows filled with a seed document's BM25 neighbours.

Documents are tokenised once (each distinct word once per task; the tokenizer never joins
words, so a text's ids are its words' ids in order) and closed with an end id. Full windows of a
document are sequences of their own. The remainders are packed: they are dealt into shards of
about ``SHARD`` documents, ordered by a lexical sketch so that similar texts meet, and each
shard holds an inverted index of its remainders, weighted by BM25 with document frequencies over
all remainders. A seed asks the index for its nearest unused neighbours and they fill its window in that
order; the last one is cut where the window ends and its rest is the next seed. Where no
neighbour shares a query term, the next unused document follows. So every sequence is full but the
last of each shard.

Shards are cut by (sketch, doc_id, row): copies, however many, spread over shards. A shard is a
partition of bounded size; nothing but the table of document frequencies (one number per
vocabulary id) reaches the driver.

Cases: null text is empty and gives the end id alone. Each row is packed, also where rows share a
doc_id or are equal, or doc_id is null. Texts are read whole. Ties go to the row that comes first
by sketch and id. An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import os
import re
import zlib
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import Numbers, mixed, utf8

WINDOW = 2048
END = 1
SHARD = 2048            # documents per shard
QUERY_TERMS = 32        # of a seed, by weight
SLICE = 1 << 22         # bytes of text that are tokenised at once
K1, B = 1.2, 0.75
PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def byte_character(b: int) -> str:
    """The character for a byte in vocabularies over bytes: printable Latin-1 as it is, others from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    return chr(b) if b in printable else chr(256 + sum(x not in printable for x in range(b)))


class WordIds:
    """Ids of texts through a bounded cache of words.

    Most words are lower-case letters, perhaps with marks after them. The tokenizer cuts between
    the two, so a word is kept as one or two units: letters and marks, or else the word as it
    is. Units of letters need no normalising and no pattern: the tokenizer's model takes them as
    they are, its bytes above ASCII written as the characters that stand for them in its vocabulary.
    """

    #: Lines of ASCII and Latin-1 lower-case letters and then marks (no ' or <), or any others.
    PLAIN = re.compile(rb"((?:[a-z]|\xc3[\x9f-\xb6\xb8-\xbf])+)([!-&(-/:;=-@\[-`{-~]*)\n|[^\n]*\n")

    def __init__(self, path: str, most: int = 600_000):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"      # Spark runs the tasks side by side
        self.tokenizer, self.most = Tokenizer.from_file(path), most
        self.tokenize = self.tokenizer.model.tokenize
        self.above = {c: "".join(map(byte_character, chr(c).encode())) for c in range(0x80, 0x100)}
        self.clear()

    def clear(self):
        self.known, self.pairs = Numbers(), np.empty((0, 2), np.int64)      # words, their units (-1: none)
        self.units, self.flat = Numbers(), np.empty(0, np.uint32)
        self.start, self.size = np.empty(0, np.int64), np.empty(0, np.int64)

    def add(self, letters: bool = False) -> None:
        """Encode the units that are new."""
        if len(self.units) == len(self.size):
            return
        new = b" ".join(islice(self.units, len(self.size), None)).decode("utf-8", "replace")
        if letters:
            tokenize, above = self.tokenize, self.above
            lists = [[t.id for t in tokenize(u if u.isascii() else u.translate(above))] for u in new.split(" ")]
        else:
            lists = [e.ids for e in self.tokenizer.encode_batch_fast(new.split(" "), add_special_tokens=False)]
        size = np.fromiter(map(len, lists), np.int64, len(lists))
        ids = np.fromiter(chain.from_iterable(lists), np.uint32, int(size.sum()))
        self.start = np.concatenate([self.start, len(self.flat) + np.cumsum(size) - size])
        self.size, self.flat = np.concatenate([self.size, size]), np.concatenate([self.flat, ids])

    def learn(self, new: list[bytes]) -> None:
        parts = self.PLAIN.findall(b"\n".join(new) + b"\n")
        core, mark = [c for c, _ in parts], [m for _, m in parts]
        plain = np.fromiter(map(bool, core), bool, len(core))
        pairs = np.empty((len(new), 2), np.int64)
        pairs[plain, 0] = list(map(self.units.__getitem__, filter(None, core)))
        self.add(letters=True)
        pairs[~plain, 0] = [self.units[w] for w, c in zip(new, core) if not c]
        pairs[:, 1] = [self.units[m] if m else -1 for m in mark]
        self.add()
        self.pairs = np.concatenate([self.pairs, pairs])

    def ids(self, texts: pa.Array | list[bytes]) -> list[np.ndarray]:
        """Ids of each text; a column of texts is binary, without nulls."""
        if len(self.known) > self.most:
            self.clear()
        texts = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.binary())
        split = pc.ascii_split_whitespace(lowered(texts.view(pa.string())))
        # A word is looked up once per call, however often the texts have it.
        words = split.flatten().dictionary_encode()
        _, places, data = words.dictionary.buffers()
        n = len(words.dictionary)
        places, data = np.frombuffer(places, np.int32, n + 1).tolist() if n else [0], data.to_pybytes() if data else b""
        at = np.fromiter(map(self.known.__getitem__, [data[a:b] for a, b in zip(places, places[1:])]), np.int64, n)
        if len(self.known) > len(self.pairs):
            self.learn(list(islice(self.known, len(self.pairs), None)))
        pairs = self.pairs[at]
        size = np.where(pairs < 0, 0, self.size[pairs])
        # The ids of the distinct words, and each occurrence's run among them.
        unit, run = pairs.reshape(-1), size.reshape(-1)
        ends = np.cumsum(run)
        once = self.flat[np.repeat(self.start[unit] - (ends - run), run) + np.arange(int(run.sum()))]
        long = size.sum(axis=1)
        begin = np.cumsum(long) - long
        words = words.indices.to_numpy()
        size = long[words]
        ends = np.cumsum(size)
        every = once[np.repeat(begin[words] - (ends - size), size) + np.arange(int(size.sum()))]
        cuts = np.r_[0, ends][split.offsets.to_numpy()]
        return [every[a:b] for a, b in zip(cuts[:-1], cuts[1:])]


def lowered(texts: pa.Array) -> pa.Array:
    """Lower case is the tokenizer's own step; markers of special tokens are the exception."""
    return pc.if_else(pc.match_substring(texts, "<|"), texts, pc.ascii_lower(texts))


def slices(batches, size: int = SLICE):
    """The batches in slices of texts that begin within ``size`` bytes."""
    for b in batches:
        ends = np.cumsum(pc.binary_length(b.column("text")).to_numpy(zero_copy_only=False), dtype=np.int64)
        cuts = [0, *(np.flatnonzero(np.diff(ends // size)) + 1).tolist(), b.num_rows]
        for i, j in zip(cuts, cuts[1:]):
            if j > i:
                yield b.slice(i, j - i)


def encoded(docs: DataFrame, path: str, window: int = WINDOW, end: int = END) -> DataFrame:
    """One row per document: its length in ids, checksums of its full windows, its remainder and a lexical sketch.

    Each task adds rows of document frequencies (``df``), without a document.
    """
    def encode(batches):
        words, part, n_seq = WordIds(path), TaskContext.get().partitionId(), 0
        df = np.zeros(words.tokenizer.get_vocab_size(with_added_tokens=True), np.int64)
        hashes = mixed(np.arange(len(df), dtype=np.uint64)) >> np.uint64(44)
        for piece in slices(batches):
            out = {c: [] for c in ("tokens", "crcs", "first", "rest", "sketch")}
            for ids in words.ids(piece.column("text")):
                ids = np.append(ids, np.uint32(end))
                full = len(ids) // window
                rest = ids[full * window:]
                out["tokens"].append(len(ids))
                out["crcs"].append([crc(ids[i * window:(i + 1) * window]) for i in range(full)])
                out["first"].append((1 << 62) | (part << 36) | n_seq)
                n_seq += full
                terms = np.unique(rest)
                df[terms] += 1
                low = np.sort(hashes[terms])[:3].tolist()
                out["sketch"].append(sum(x << s for x, s in zip(low, (40, 20, 0))))
                out["rest"].append(rest.astype("<u4").tobytes() if len(df) > 1 << 16 else rest.astype("<u2").tobytes())
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id"), pa.array(out["tokens"], pa.int64()), pa.array(out["crcs"], pa.list_(pa.int64())),
                 pa.array(out["first"], pa.int64()), pa.array(out["rest"], pa.binary()),
                 pa.array(out["sketch"], pa.int64()), pa.nulls(piece.num_rows, pa.binary())], names=names)
        yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(
            (None, None, None, None, None, None, df.tobytes()),
            (pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.int64(), pa.binary(), pa.int64(), pa.binary()))], names=names)

    names = ["doc_id", "doc_tokens", "crcs", "first", "rest", "sketch", "df"]
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), utf8().alias("text")).mapInArrow(
        encode, "doc_id long, doc_tokens long, crcs array<long>, first long, rest binary, sketch long, df binary")


def document_frequencies(rows: DataFrame) -> np.ndarray:
    """Sum of the tasks' counts: one number per vocabulary id."""
    def add(batches):
        total = 0
        for b in batches:
            for x in b.column("df").to_pylist():
                total = total + np.frombuffer(x, np.int64)
        if np.ndim(total):
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array([len(total)] * len(at)), pa.array(total[at])],
                                             names=["term", "size", "n"])

    got = rows.where("df is not null").select("df").mapInArrow(add, "term long, size long, n long") \
        .groupBy("term", "size").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(int(got["size"].max()) if len(got) else 1, np.int64)
    out[got["term"].to_numpy(np.int64)] = got["n"].to_numpy()
    return out


class Index:
    """Inverted index of a shard's documents with BM25 weights."""

    def __init__(self, docs: list[np.ndarray], df: np.ndarray, n_docs: int, mean: float):
        idf = np.log1p((n_docs - df + 0.5) / (df + 0.5))
        sizes = np.array([len(d) for d in docs])
        key, tf = np.unique(np.repeat(np.arange(len(docs)), sizes) * len(df) + np.concatenate(docs).astype(np.int64),
                            return_counts=True)
        doc, term = key // len(df), key % len(df)
        weight = idf[term] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * sizes[doc] / mean))
        self.own = np.searchsorted(doc, np.arange(len(docs) + 1))
        self.terms, self.weights = term, weight
        order = np.argsort(term, kind="stable")
        self.doc, self.weight, by = doc[order], weight[order], term[order]
        self.term, self.at = np.unique(by, return_index=True)
        self.ends = np.r_[self.at[1:], len(by)]

    def neighbours(self, seed: int, unused: np.ndarray) -> np.ndarray:
        """Unused documents that share a query term with the seed, best first."""
        a, b = self.own[seed], self.own[seed + 1]
        best = np.argsort(-self.weights[a:b], kind="stable")[:QUERY_TERMS] + a
        t = np.searchsorted(self.term, self.terms[best])
        parts = [slice(x, y) for x, y in zip(self.at[t], self.ends[t])]
        score = np.bincount(np.concatenate([self.doc[p] for p in parts]), np.concatenate([self.weight[p] for p in parts]),
                            len(unused))
        found = np.flatnonzero((score > 0) & unused)
        return found[np.argsort(-score[found], kind="stable")]


def fill(docs: list[np.ndarray], index: Index, window: int = WINDOW):
    """(document, start, length, sequence, offset) of each piece; every document is used up."""
    left = np.array([len(d) for d in docs])
    unused, done, seed, sequence = left > 0, 0, -1, 0
    while True:
        if seed < 0:
            while done < len(docs) and not unused[done]:
                done += 1
            if done == len(docs):
                return
            seed = done
        room, turn, after = window, [seed], -1
        more = index.neighbours(seed, unused) if left[seed] < window else ()
        queue = iter([x for x in more if x != seed])
        following = done
        while turn:
            x = turn.pop()
            n = int(min(room, left[x]))
            yield x, len(docs[x]) - int(left[x]), n, sequence, window - room
            left[x] -= n
            room -= n
            if left[x]:
                after = x
            else:
                unused[x] = False
            if room:
                x = next(queue, None)
                if x is None:
                    while following < len(docs) and not unused[following]:
                        following += 1
                    x = following if following < len(docs) else None
                if x is not None:
                    turn.append(x)
        seed, sequence = after, sequence + 1


def pack(docs: DataFrame, path: str | None = None, window: int = WINDOW, end: int = END, shard: int = SHARD) -> DataFrame:
    """Pieces: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    import public_tokenizers

    rows = materialize(encoded(docs, path or public_tokenizers.path("word_bpe_49k.json"), window, end), "pack-ids")
    df = document_frequencies(rows)
    width = 2 if len(df) <= 1 << 16 else 4
    rest = rows.where("length(rest) > 0")
    stat = rest.agg(F.count("*").alias("n"), F.sum(F.length("rest") / width).alias("ids")).first()
    n_docs, mean = stat["n"], (stat["ids"] or 0) / max(1, stat["n"])

    def shards(batches):
        held = [b for b in batches if b.num_rows]               # one shard
        if not held:
            return
        t = pa.Table.from_batches(held)
        t = t.sort_by([("sketch", "ascending"), ("doc_id", "ascending"), ("row", "ascending")])
        ids, tokens = t.column("doc_id").to_pylist(), t.column("doc_tokens").to_pylist()
        texts = [np.frombuffer(x, f"<u{width}") for x in t.column("rest").to_pylist()]
        base = (TaskContext.get().partitionId() + 1) << 32
        out = [(ids[x], tokens[x] - len(texts[x]) + start, n, crc(texts[x][start:start + n]), tokens[x], base + seq, offset)
               for x, start, n, seq, offset in fill(texts, Index(texts, df, n_docs, mean), window)]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)],
                                         names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

    # The row number splits rows that are equal in sketch and id.
    packed = rest.select("doc_id", "doc_tokens", "first", "rest", "sketch", F.monotonically_increasing_id().alias("row")) \
        .repartitionByRange(max(1, -(-n_docs // shard)), "sketch", "doc_id", "row").mapInArrow(shards, PIECE)
    whole = rows.where("df is null").select("doc_id", "doc_tokens", "first", F.posexplode("crcs").alias("i", "ids_crc32")) \
        .select("doc_id", (F.col("i") * F.lit(window).cast("long")).alias("start"), F.lit(window).cast("long").alias("length"),
                "ids_crc32", "doc_tokens", (F.col("first") + F.col("i")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return whole.union(packed)
