"""Phrase collocations by direct-address tiling.

Texts are cut into blocks of about ``BLOCK_TOKENS`` words of one language, each a row with its own
word list. Words with ``least`` occurrences get ids by frequency rank within their language, and the
blocks become sequences of ids. A phrase of m + 1 words is a pair of neighbouring phrases of m words, so
each level counts pairs of neighbouring ids: in each block the pairs fall into square tiles of
``1 << SIDE`` ids a side, so that frequent ids share tiles. A tile with many pairs is counted by a
``bincount`` over its cells, the others together as coordinates that are sorted once. The counts of a
block go to groups by the hash of the pair, packed, and a group adds up its pairs over all blocks.
Pairs that reach ``least`` are ranked anew by frequency, and their ids go back to the blocks that hold
them, which makes the sequences of the next level.

No vocabulary is broadcast and no pair is dropped before its total is known. A group holds about
``GROUP_PAIRS`` pairs whatever the size of the table, a frequent word or phrase once per block, and
ranks are positions in a range-partitioned order.

Cases: null and empty texts have no words; the null language counts as ``und``. A piece of one word
has no phrase. Equal rows count each. Ids and other columns are not looked at. A text longer than a block
is a block of its own. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import materialize, release
from .common import Numbers, mixed, slices, slots

LONGEST = 3
LEAST = 10
COVERED = 50                # percent of a phrase's count at which a longer one stands for it
TOP = 2000
SCALE = 1_000_000
BLOCK_TOKENS = 1 << 21
GROUP_PAIRS = 1 << 21
SIDE = 9                    # bits of a tile's side
DENSE = 1 << 12             # pairs from which a tile is counted cell by cell
NO_LANG = "und"

#: A-Z to a-z, and the ends of pieces (. , ; : ! ? and line ends) to the full stop, which is in no word.
_TABLE = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ,;:!?\n\x0b\x0c\r", b"abcdefghijklmnopqrstuvwxyz" + b"." * 9)
_STOP = b"."


def tokens(text: bytes) -> list[bytes]:
    """Lower-case words, with a full stop where a piece ends."""
    return text.translate(_TABLE).replace(_STOP, b" . ").split()


def pack(a: np.ndarray) -> bytes:
    """Non-negative integers as byte planes, of as many bytes as the largest needs."""
    a = np.ascontiguousarray(a, np.int64)
    width = max(1, (int(a.max(initial=0)).bit_length() + 7) // 8)
    return bytes([width]) + a.view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()


def unpack(b: bytes) -> np.ndarray:
    width = b[0]
    out = np.zeros(((len(b) - 1) // width, 8), np.uint8)
    out[:, :width] = np.frombuffer(b, np.uint8, offset=1).reshape(width, -1).T
    return out.reshape(-1).view(np.int64)


def tile_counts(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs (x, y) of ids (below 2^40) and their counts."""
    mask = (1 << SIDE) - 1
    tile = ((x >> SIDE) << 31) | (y >> SIDE)
    order = np.argsort(tile, kind="stable")
    tile, cell = tile[order], (((x & mask) << SIDE) | (y & mask))[order]
    first = np.flatnonzero(np.diff(tile, prepend=-1))
    size = np.diff(first, append=len(tile))
    tiles, cells, counts = [], [], []
    for i in np.flatnonzero(size >= DENSE):
        n = np.bincount(cell[first[i]:first[i] + size[i]], minlength=1 << 2 * SIDE)
        hit = np.flatnonzero(n)
        tiles.append(np.full(len(hit), tile[first[i]]))
        cells.append(hit)
        counts.append(n[hit])
    run = np.repeat(np.arange(len(first)), size)
    thin = (size < DENSE)[run]
    key, n = np.unique((run[thin] << 2 * SIDE) | cell[thin], return_counts=True)
    tiles.append(tile[first[key >> 2 * SIDE]])
    cells.append(key & ((1 << 2 * SIDE) - 1))
    counts.append(n)
    tile, cell = np.concatenate(tiles), np.concatenate(cells)
    return ((tile >> 31) << SIDE) | (cell >> SIDE), ((tile & ((1 << 31) - 1)) << SIDE) | (cell & mask), np.concatenate(counts)


def looked_up(a: np.ndarray, b: np.ndarray, table: tuple[np.ndarray, np.ndarray, np.ndarray]) -> np.ndarray:
    """Ids of the pairs (a, b) in ``table`` (a, b, id), -1 for those it lacks."""
    ta, tb, ids = table
    if not len(ids) or not len(a):
        return np.full(len(a), -1, np.int64)
    ua, ub = np.unique(ta), np.unique(tb)
    keys = np.searchsorted(ua, ta) * len(ub) + np.searchsorted(ub, tb)
    order = np.argsort(keys)
    keys, ids = keys[order], ids[order]
    ia, ib = np.searchsorted(ua, a), np.searchsorted(ub, b)
    ia[ia == len(ua)] = 0
    ib[ib == len(ub)] = 0
    key = ia * len(ub) + ib
    at = np.searchsorted(keys, key)
    at[at == len(keys)] = 0
    return np.where((ua[ia] == a) & (ub[ib] == b) & (keys[at] == key), ids[at], -1)


def thinned(seq: np.ndarray) -> np.ndarray:
    """``seq`` with runs of -1 as one: only neighbours matter."""
    gap = seq < 0
    return seq[~(gap & np.concatenate([[True], gap[:-1]]))] if len(seq) else seq


def blocks(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """(block, lang, tokens, words, counts, n): words by falling count, ``tokens`` their packed places from 1, 0 at the
    end of a piece or text, ``n`` words in all."""
    def row(block, name, numbers, parts):
        seq = np.concatenate(parts)
        counts = np.bincount(seq, minlength=len(numbers))
        order = np.argsort(-counts[1:], kind="stable") + 1
        place = np.zeros(len(counts), np.int64)
        place[order] = np.arange(1, len(counts))
        words = list(numbers)
        return {"block": block, "lang": name, "tokens": pack(place[seq]), "words": [words[i] for i in order],
                "counts": counts[order], "n": int(counts[1:].sum())}

    kind = pa.schema([("block", pa.int64()), ("lang", pa.string()), ("tokens", pa.binary()), ("words", pa.list_(pa.string())),
                      ("counts", pa.list_(pa.int64())), ("n", pa.int64())])

    def cut(batches):
        number = TaskContext.get().partitionId() << 33
        held: dict[str, tuple[Numbers, list]] = {}
        size: dict[str, int] = {}

        def out(name):
            nonlocal number
            got = row(number, name, *held.pop(name))
            size.pop(name)
            number += 1
            got["words"] = pa.array(got["words"], pa.binary()).cast(pa.string())
            return pa.RecordBatch.from_arrays(
                [pa.array([got["block"]], pa.int64()), pa.array([got["lang"]], pa.string()), pa.array([got["tokens"]], pa.binary()),
                 pa.ListArray.from_arrays([0, len(got["words"])], got["words"]), pa.array([got["counts"]], pa.list_(pa.int64())),
                 pa.array([got["n"]], pa.int64())], schema=kind)

        for b in slices(batches):
            for name, data in zip(b.column("lang").to_pylist(), b.column("text").to_pylist()):
                found = tokens(data)
                if not found:
                    continue
                if name not in held:
                    held[name], size[name] = (Numbers({_STOP: 0}), []), 0
                numbers, parts = held[name]
                parts.append(np.fromiter(map(numbers.__getitem__, found), np.int64, len(found)))
                parts.append(np.zeros(1, np.int64))
                size[name] += len(found) + 1
                if size[name] >= BLOCK_TOKENS:
                    yield out(name)
                while sum(size.values()) >= 2 * BLOCK_TOKENS:
                    yield out(max(size, key=size.get))
        for name in list(held):
            yield out(name)

    rows = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit(NO_LANG)).alias("lang"),
                       F.coalesce(F.col(text).cast("binary"), F.lit(b"")).alias("text"))
    return rows.mapInArrow(cut, "block long, lang string, tokens binary, words array<string>, counts array<long>, n long")


def ranked(df: DataFrame, *order, name: str = "id") -> DataFrame:
    """``df``, staged, with its rows numbered from 0 in the given order, which must be total. No task sees all rows."""
    spark = df.sparkSession
    local = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    parts = df.repartitionByRange(slots(spark), *order).sortWithinPartitions(*order) \
        .withColumn("_part", F.spark_partition_id()).withColumn("_row", local)
    parts = materialize(parts, "phrases-ranked")
    before = F.coalesce(F.sum("n").over(W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    offsets = parts.groupBy("_part").agg(F.count(F.lit(1)).alias("n")).select("_part", before.alias("_before"))
    # One row per partition.
    return parts.join(F.broadcast(offsets), "_part").withColumn(name, F.col("_before") + F.col("_row")) \
        .drop("_part", "_row", "_before")


def _vocabulary(cut: DataFrame, least: int) -> DataFrame:
    """Level 1: (id, lang, phrase, last, f, pre, suf) of the words with ``least`` occurrences."""
    rows = cut.select("lang", F.explode(F.arrays_zip("words", "counts")).alias("w")).select("lang", "w.words", "w.counts")
    kept = rows.groupBy("lang", F.col("words").alias("phrase")).agg(F.sum("counts").alias("f")).where(F.col("f") >= least)
    none = F.array().cast("array<long>")
    return ranked(kept, "lang", F.desc("f"), "phrase") \
        .select("id", "lang", "phrase", F.col("phrase").alias("last"), "f", none.alias("pre"), none.alias("suf"))


def _word_sequences(cut: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """(block, seq): packed ids + 1, 0 where there is none."""
    def encode(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return pa.table({"block": pa.array([], pa.int64()), "seq": pa.array([], pa.binary())})
        places = unpack(left.column("tokens")[0].as_py())
        ids = np.full(int(places.max(initial=0)) + 1, -1, np.int64)
        ids[right.column("place").to_numpy()] = right.column("id").to_numpy()
        return pa.table({"block": left.column("block"), "seq": pa.array([pack(thinned(ids[places]) + 1)], pa.binary())})

    words = cut.select(F.col("block").alias("home"), "lang", F.posexplode("words").alias("place", "phrase"))
    known = vocabulary.select("lang", "phrase", "id").hint("shuffle_hash")
    places = words.join(known, ["lang", "phrase"]).select("home", (F.col("place") + 1).cast("long").alias("place"), "id")
    return cut.select("block", "tokens").groupBy("block").cogroup(places.groupBy("home")) \
        .applyInArrow(encode, "block long, seq binary")


def _pieces(sequences: DataFrame, groups: int) -> DataFrame:
    """(g, block, a, b, n): each block's distinct pairs of neighbours and their counts, packed, by group."""
    def count(batches):
        for batch in slices(batches, 1):
            block = batch.column("block")[0].as_py()
            seq = unpack(batch.column("seq")[0].as_py()) - 1
            x, y = seq[:-1], seq[1:]
            both = (x >= 0) & (y >= 0)
            if not both.any():
                continue
            a, b, n = tile_counts(x[both], y[both])
            g = (mixed(a.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + b.view(np.uint64)) % np.uint64(groups)).astype(np.int64)
            order = np.lexsort((b, a, g))
            a, b, n, g = a[order], b[order], n[order], g[order]
            first = np.flatnonzero(np.diff(g, prepend=-1))
            for i in range(0, len(first), 256):
                at = first[i:i + 256]
                ends = [*first[i + 1:i + 257], len(g)][:len(at)]
                cells = [(pack(np.diff(a[s:e], prepend=0)), pack(b[s:e]), pack(n[s:e])) for s, e in zip(at, ends)]
                yield pa.RecordBatch.from_arrays([pa.array(g[at].astype(np.int32)), pa.array(np.full(len(at), block)),
                                                  *[pa.array(list(c), pa.binary()) for c in zip(*cells)]],
                                                 names=["g", "block", "a", "b", "n"])

    return sequences.mapInArrow(count, "g int, block long, a binary, b binary, n binary")


def _pairs(t: pa.Table, i: int) -> tuple[np.ndarray, np.ndarray]:
    return np.cumsum(unpack(t.column("a")[i].as_py())), unpack(t.column("b")[i].as_py())


def _totals(pieces: DataFrame, least: int) -> DataFrame:
    """(g, a, b, f) of the pairs with ``least`` occurrences over all blocks."""
    def add(t: pa.Table) -> pa.Table:
        parts = [_pairs(t, i) for i in range(t.num_rows)]
        a, b = (np.concatenate(c) for c in zip(*parts))
        n = np.concatenate([unpack(x.as_py()) for x in t.column("n")])
        order = np.lexsort((b, a))
        a, b, n = a[order], b[order], n[order]
        first = np.flatnonzero((np.diff(a, prepend=-1) != 0) | (np.diff(b, prepend=-1) != 0))
        f = np.add.reduceat(n, first)
        kept = f >= least
        return pa.table({"g": pa.array(np.full(kept.sum(), t.column("g")[0].as_py(), np.int32)), "a": a[first][kept],
                         "b": b[first][kept], "f": f[kept]})

    return pieces.groupBy("g").applyInArrow(add, "g int, a long, b long, f long")


def _longer(totals: DataFrame, level: DataFrame) -> DataFrame:
    """The next level: (id, g, a, b, lang, phrase, last, f, pre, suf).

    ``pre`` has the counts of the phrase's beginnings by length, ``suf`` those of its ends.
    """
    head = level.select(F.col("id").alias("a"), "lang", F.col("phrase").alias("head"), F.concat("pre", F.array("f")).alias("pre"))
    tail = level.select(F.col("id").alias("b"), "last", F.concat("suf", F.array("f")).alias("suf"))
    rows = totals.join(head, "a").join(tail, "b") \
        .select("g", "a", "b", "lang", F.concat_ws(" ", "head", "last").alias("phrase"), "last", "f", "pre", "suf")
    return ranked(rows, "lang", F.desc("f"), "a", "b")


def _next_sequences(sequences: DataFrame, pieces: DataFrame, level: DataFrame) -> DataFrame:
    """Sequences of the ids of ``level``: group by group back to the blocks that hold its phrases."""
    def tell(t: pa.Table, known: pa.Table) -> pa.Table:
        table = tuple(known.column(c).to_numpy() for c in ("a", "b", "id"))
        blocks, parts = [], []
        for i in range(t.num_rows if known.num_rows else 0):
            a, b = _pairs(t, i)
            ids = looked_up(a, b, table)
            hit = ids >= 0
            if hit.any():
                blocks.append(t.column("block")[i].as_py())
                parts.append((pack(np.diff(a[hit], prepend=0)), pack(b[hit]), pack(ids[hit])))
        cols = zip(*parts) if parts else ([], [], [])
        return pa.table({"block": pa.array(blocks, pa.int64())} | {n: pa.array(list(c), pa.binary()) for n, c in zip(["a", "b", "id"], cols)})

    def encode(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return pa.table({"block": pa.array([], pa.int64()), "seq": pa.array([], pa.binary())})
        seq = unpack(left.column("seq")[0].as_py()) - 1
        parts = [(*_pairs(right, i), unpack(right.column("id")[i].as_py())) for i in range(right.num_rows)]
        ids = looked_up(seq[:-1], seq[1:], tuple(np.concatenate(c) for c in zip(*parts)))
        return pa.table({"block": left.column("block"), "seq": pa.array([pack(thinned(ids) + 1)], pa.binary())})

    told = pieces.select("g", "block", "a", "b").groupBy("g").cogroup(level.select("g", "a", "b", "id").groupBy("g")) \
        .applyInArrow(tell, "block long, a binary, b binary, id binary")
    return sequences.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(encode, "block long, seq binary")


def scored(level: DataFrame, words: int) -> DataFrame:
    """(id, lang, phrase, a, l, r, score) of a level's phrases of ``words`` words, by their lowest-scoring cut.

    In decimals of 38 digits: exact while counts are below 10^16.
    """
    cut = f"""array_min(transform(sequence(1, {words - 1}), k -> struct(
        ({SCALE} * cast(f as decimal(19, 0)) * cast(f as decimal(19, 0))) div
            (cast(pre[k - 1] as decimal(19, 0)) * cast(suf[{words - 1} - k] as decimal(19, 0))) as score,
        k, pre[k - 1] as l, suf[{words - 1} - k] as r)))"""
    return level.withColumn("_cut", F.expr(cut)) \
        .select("id", "lang", "phrase", F.col("f").alias("a"), "_cut.l", "_cut.r", F.col("_cut.score").cast("long").alias("score"))


def uncovered(candidates: DataFrame, longer: DataFrame | None, covered: int = COVERED) -> DataFrame:
    """``candidates`` but those with a phrase of the next level round them that has ``covered`` percent of their count.
    (A phrase that is longer still has no larger count than the one of the next level inside it.)"""
    if longer is None:
        return candidates
    most = longer.select(F.col("a").alias("id"), "f").unionByName(longer.select(F.col("b").alias("id"), "f")) \
        .groupBy("id").agg(F.max("f").alias("_most"))
    return candidates.join(most, "id", "left") \
        .where(F.col("_most").isNull() | (100 * F.col("_most") < covered * F.col("a"))).drop("_most")


def collocations(docs: DataFrame, longest: int = LONGEST, least: int = LEAST, covered: int = COVERED, top: int = TOP,
                 text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's ``top`` phrases of 2 to ``longest`` words.

    a, l and r are the counts of the phrase and the two parts of its lowest-scoring cut, n that of all words.
    Order: score, then a, both falling, then the phrase in byte order.
    """
    spark = docs.sparkSession
    cut = materialize(blocks(docs, text, lang), "phrases-blocks")
    totals = cut.groupBy("lang").agg(F.sum("n").alias("n"))
    groups = max(slots(spark), -(-(totals.agg(F.sum("n")).first()[0] or 0) // GROUP_PAIRS))
    levels = [materialize(_vocabulary(cut, least), "phrases-1")]
    sequences = materialize(_word_sequences(cut, levels[0]), "phrases-sequences-1")
    totals = materialize(totals, "phrases-languages")
    release(cut)
    for words in range(2, longest + 1):
        pieces = materialize(_pieces(sequences, groups), f"phrases-pieces-{words}")
        levels.append(materialize(_longer(_totals(pieces, least), levels[-1]), f"phrases-{words}"))
        if words < longest:
            following = materialize(_next_sequences(sequences, pieces, levels[-1]), f"phrases-sequences-{words}")
            release(sequences)
            sequences = following
        release(pieces)
    release(sequences)
    found = None
    for words, (level, longer) in enumerate(zip(levels[1:], [*levels[2:], None]), 2):
        left = uncovered(scored(level, words), longer, covered).drop("id")
        found = left if found is None else found.unionByName(left)
    order = ["lang", F.desc("score"), F.desc("a"), "phrase"]
    if found is None:
        raise ValueError("longest must be at least 2")
    placed = ranked(found, *order, name="_at")
    first = placed.groupBy("lang").agg(F.min("_at").alias("_first")).join(totals, "lang")
    first = materialize(first, "phrases-first")         # one row per language
    out = placed.join(first, "lang").withColumn("rank", (F.col("_at") - F.col("_first") + 1).cast("long")) \
        .where(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    return materialize(out, "phrases-found")
