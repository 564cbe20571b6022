"""Substring dedup by seed and extend: winnowed anchors, extended both ways to maximal repeats.

A word run of ``LENGTH`` words (a window) that also starts earlier, in a smaller doc_id or
earlier in its document, is a repeat; every word that a repeated window covers is removed.
Windows are judged on the input.

* Seeds. Of the hashes of ``SEED`` consecutive words inside a window, the smallest (the rightmost
  of equal ones) is the window's anchor. Windows with the same words have the same anchor at the
  same offset. Consecutive windows that share an anchor form a segment: the anchor extended both
  ways over all the words of its windows. There is about one segment per eight words.
* Join. Anchors that occur once are done: nothing in their windows repeats. For the others the
  whole extension is compared by hash. A segment that has an equal one in an earlier document is
  a repeat as a whole. This settles the inside of every long match.
* Ends. What is left are first occurrences of a segment whose anchor also has other extensions:
  a match ends inside them. Their windows are compared one by one, by 128-bit hash. Removed
  windows side by side then make the maximal repeats.

All comparisons are a minimum of doc_id per hash, with partial sums, so no step forms the pairs of
a group, and groups of any size spread over tasks. Repeats inside one document are found in the
pass over its words.

Cases: null text has no words. Rows that share a doc_id are not compared with each other. A null
doc_id comes before all others. Equal rows get equal results. Texts are read whole; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize, release
from .common import as_long, mixed, rows, run_hashes, slices, utf8, word_hashes

LENGTH = 20
SEED = 6
_TAG_BITS, _N_BITS = 24, 5          # segment position: start, number of windows, tag of the text
_NULL = -(1 << 63)


def _input(docs: DataFrame) -> DataFrame:
    """(did, tag, text): order key of the document, tag that tells rows with one doc_id apart, UTF-8 text."""
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_NULL)).alias("did"), utf8().alias("text")) \
        .withColumn("tag", F.pmod(F.xxhash64("text"), F.lit(1 << _TAG_BITS)))


def window_segments(h: np.ndarray, length: int = LENGTH, seed: int = SEED):
    """(first window, windows, anchor hash, extension hash) of each segment of a document's word hashes."""
    a = run_hashes(h, seed)
    width = length - seed + 1
    n = len(a) - width + 1
    if n <= 0:
        return (np.empty(0, np.int64),) * 2 + (np.empty(0, np.uint64),) * 2
    pos = np.empty(n, np.int64)
    for i in range(0, n, 1 << 16):          # bounded memory for very long texts
        view = np.lib.stride_tricks.sliding_window_view(a[i:i + (1 << 16) + width - 1], width)
        pos[i:i + (1 << 16)] = np.arange(len(view)) + i + width - 1 - view[:, ::-1].argmin(axis=1)
    first = np.flatnonzero(np.r_[True, pos[1:] != pos[:-1]])
    count = np.diff(np.r_[first, n])
    turn = (np.arange(n) - np.repeat(first, count)).astype(np.uint64) * np.uint64(2) + np.uint64(1)
    whole = np.add.reduceat(run_hashes(h, length) * turn, first)
    return first, count, a[pos[first]], mixed(whole + count.astype(np.uint64))


def segments(docs: DataFrame) -> DataFrame:
    """(anchor, seg, did, at, again): ``again`` marks a segment that is in its document earlier as well."""
    def make(batches):
        for b in slices(batches):
            out = []
            for did, tag, text in rows(b, "did", "tag", "text"):
                first, count, anchor, seg = window_segments(word_hashes(text.split()))
                if len(first):
                    seen = np.zeros(len(first), bool)
                    seen[np.unique(mixed(anchor) ^ seg, return_index=True)[1]] = True
                    at = (first << (_N_BITS + _TAG_BITS)) | (count << _TAG_BITS) | tag
                    out.append((anchor, seg, np.full(len(first), did, np.int64), at, ~seen))
            if out:
                anchor, seg, did, at, again = (np.concatenate(c) for c in zip(*out))
                yield pa.RecordBatch.from_arrays([as_long(anchor), as_long(seg), pa.array(did), pa.array(at), pa.array(again)],
                                                 names=["anchor", "seg", "did", "at", "again"])

    return _input(docs).select("did", "tag", "text") \
        .mapInArrow(make, "anchor long, seg long, did long, at long, again boolean")


def _seeded(docs: DataFrame) -> DataFrame:
    """(did, at, whole): segments to remove as a whole, and those whose windows are to be compared."""
    occ = materialize(segments(docs), "sub-segments")
    once = occ.where("not again")
    anchors = once.groupBy("anchor").agg(F.min("seg").alias("lo"), F.max("seg").alias("hi"), F.min("did").alias("first"),
                                         F.count("*").alias("n")).where("n > 1") \
        .select("anchor", "first", (F.col("lo") != F.col("hi")).alias("several"))
    shared = materialize(once.select("anchor", "seg", "did", "at").join(anchors, "anchor"), "sub-shared")
    same = shared.where("not several and did > first").select("did", "at", F.lit(True).alias("whole"))
    several = shared.where("several").drop("first", "several")
    origin = several.groupBy("anchor", "seg").agg(F.min("did").alias("first"))
    ends = several.join(origin, ["anchor", "seg"]).select("did", "at", (F.col("did") > F.col("first")).alias("whole"))
    inner = occ.where("again").select("did", "at", F.lit(True).alias("whole"))
    out = materialize(same.union(ends).union(inner), "sub-marks")
    release(occ, shared)
    return out


def _gathered(marks: DataFrame) -> DataFrame:
    """(did, tag, marks): each text's marks, bounded by its own words. Sets: equal rows mark the same places."""
    tag = F.col("at").bitwiseAND(F.lit((1 << _TAG_BITS) - 1))
    return marks.groupBy("did", tag.alias("tag")).agg(F.collect_set(F.col("at") * 2 + F.col("whole").cast("long")).alias("marks"))


def _split(marks):
    """(first window, windows, whole) of each mark."""
    marks = np.array(marks or (), np.int64)
    at = marks >> 1
    return at >> (_N_BITS + _TAG_BITS), (at >> _TAG_BITS) & ((1 << _N_BITS) - 1), (marks & 1).astype(bool)


def _windows(docs: DataFrame, marks: DataFrame) -> DataFrame:
    """(did, at, whole=True): single windows of match ends that start earlier somewhere."""
    def make(batches):
        for b in slices(batches):
            out = []
            for did, tag, text, marks in rows(b, "did", "tag", "text", "marks"):
                first, count, whole = _split(marks)
                first, count = first[~whole], count[~whole]
                if not len(first):
                    continue
                h = word_hashes(text.split())
                start = np.sort(np.concatenate([np.arange(f, f + c) for f, c in zip(first, count)]))
                one, two = run_hashes(h, LENGTH)[start], run_hashes(mixed(h + np.uint64(1)), LENGTH)[start]
                new = np.zeros(len(start), bool)
                new[np.unique(one, return_index=True)[1]] = True
                out.append((one, two, np.full(len(start), did, np.int64),
                            (start << (_N_BITS + _TAG_BITS)) | (1 << _TAG_BITS) | tag, ~new))
            if out:
                one, two, did, at, again = (np.concatenate(c) for c in zip(*out))
                yield pa.RecordBatch.from_arrays([as_long(one), as_long(two), pa.array(did), pa.array(at), pa.array(again)],
                                                 names=["one", "two", "did", "at", "again"])

    ends = marks.where("not whole")
    windows = _input(docs).join(_gathered(ends), ["did", "tag"]).select("did", "tag", "text", "marks") \
        .mapInArrow(make, "one long, two long, did long, at long, again boolean")
    windows = materialize(windows, "sub-windows")
    firsts = windows.where("not again").groupBy("one", "two").agg(F.min("did").alias("first"), F.count("*").alias("n")) \
        .where("n > 1").drop("n")
    later = windows.where("not again").join(firsts, ["one", "two"]).where("did > first")
    out = materialize(later.select("did", "at").union(windows.where("again").select("did", "at"))
                      .withColumn("whole", F.lit(True)), "sub-ends")
    release(windows)
    return out


def dedup_substrings(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, n_words, n_removed, removed (spans of words, first and end) and kept (words joined by one space)."""
    def cut(batches):
        for b in slices(batches):
            ids, n, gone, spans, kept = [], [], [], [], []
            for did, text, marks in rows(b, "did", "text", "marks"):
                words = text.split()
                first, count, _ = _split(marks)
                step = np.zeros(len(words) + 1, np.int32)
                np.add.at(step, first, 1)
                np.add.at(step, first + count + LENGTH - 1, -1)
                out = np.cumsum(step[:-1]) > 0
                edge = np.flatnonzero(np.diff(np.r_[False, out, False].astype(np.int8)))
                ids.append(None if did == _NULL else did)
                n.append(len(words))
                gone.append(int(out.sum()))
                spans.append([{"first": int(x), "end": int(y)} for x, y in edge.reshape(-1, 2)])
                kept.append(b" ".join(w for w, x in zip(words, out.tolist()) if not x) if len(edge) else b" ".join(words))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(n, pa.int64()), pa.array(gone, pa.int64()),
                 pa.array(spans, pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))),
                 pa.array(kept, pa.binary()).cast(pa.string())], names=["doc_id", "n_words", "n_removed", "removed", "kept"])

    marks = _seeded(docs)
    ends = _windows(docs, marks)
    every = _gathered(marks.where("whole").union(ends))
    return _input(docs).join(every, ["did", "tag"], "left").select("did", "text", "marks") \
        .mapInArrow(cut, "doc_id long, n_words long, n_removed long, removed array<struct<first:long,end:long>>, kept string")
