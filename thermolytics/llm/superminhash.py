"""Near-duplicate documents by SuperMinHash signatures, banding, verification and components.

A document's set is its distinct runs of ``k`` words (the whole sequence if it has fewer).
SuperMinHash gives each element a random permutation of the signature's positions, produced
rank by rank, and position p takes the smallest value of ``rank + random fraction`` that any
element puts there. The ranks of one element are correlated (each position is used once), which
lowers the variance against independent hashes, and a document is done as soon as all its
positions hold values below the next rank.

1. One pass makes signatures and band keys. Documents with equal sets form a class with its
   smallest id as representative, so exact copies cost one row.
2. Band keys are reduced to the smallest class per bucket (partial minima, so a bucket with a
   third of all rows is one row per task), and each class in a shared bucket is paired with
   that hub: candidates grow with the rows, not with their pairs.
3. Candidates are confirmed on full sets, and components found.
4. Buckets whose classes still lie in several components are compared across components, in blocks
   of bounded size, by signature; pairs that come within ``SLACK`` of the threshold are confirmed
   on full sets in the same task. After that no two classes that share a bucket are left
   untested, but for those that are connected already. A task returns a forest of links, not all
   pairs. There is no cap on buckets or partners.

Cases: null or word-less texts have empty sets, are linked with nothing and are kept. Rows that
share a doc_id count as one document that has each of their sets. A null doc_id takes no part:
its component is null and it is kept. Ties need no rule: the component is the smallest id. An
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize, release
from .common import as_long, free_name, mixed, row_key, rows, run_hashes, slices, utf8, word_hashes
from .components import components

K = 5
BANDS, PER_BAND = 21, 6
SLOTS = BANDS * PER_BAND
SLACK = 0.13            # four standard deviations of the estimate
BLOCK = 256             # classes of a bucket in a block; two blocks meet in a task
BLOCK_BYTES = 32 << 20  # of their sets
PERCENT = 80
PART = 1 << 17          # elements whose permutations are in memory at once
_GOLD = 0x9E3779B97F4A7C15
_MASK = 0xFFFFFFFFFFFFFFFF


def shingle_set(text: bytes, k: int = K) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``k`` words, A-Z in lower case."""
    h = word_hashes(text.lower().split())       # of bytes: A-Z only
    if 0 < len(h) < k:
        return mixed(run_hashes(h, len(h)) + np.uint64(len(h)))
    return np.unique(run_hashes(h, k))


def signatures(sets: list[np.ndarray], m: int = SLOTS) -> np.ndarray:
    """(sets, m) SuperMinHash values, rank in the high and random bits in the low 32 bits."""
    sig = np.full((len(sets), m), np.iinfo(np.uint64).max, np.uint64)
    flat = sig.reshape(-1)
    every = np.concatenate(sets) if sets else np.empty(0, np.uint64)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    for start in range(0, len(every), PART):
        x, doc = every[start:start + PART], owner[start:start + PART]
        perm = np.empty((len(x), m), np.uint8)
        perm[:] = np.arange(m, dtype=np.uint8)
        for rank in range(m):
            draw = mixed(x + np.uint64(_GOLD * (rank + 1) & _MASK))
            pick = rank + ((draw >> np.uint64(32)) % np.uint64(m - rank)).astype(np.int64)
            at = np.arange(len(x))
            place = perm[at, pick]
            perm[at, pick] = perm[:, rank]
            np.minimum.at(flat, doc * m + place, np.uint64(rank << 32) | (draw & np.uint64(0xFFFFFFFF)))
            live = ((sig.max(axis=1) >> np.uint64(32)) > np.uint64(rank))[doc]      # later values are larger
            if live.sum() < 0.7 * len(x) or rank > 4 and not live.all():
                x, doc, perm = x[live], doc[live], perm[live]
            if not len(x):
                break
    return sig


def band_keys(sig: np.ndarray) -> np.ndarray:
    """(sets, BANDS) bucket keys."""
    parts = sig.reshape(len(sig), BANDS, PER_BAND)
    key = np.zeros(parts.shape[:2], np.uint64) + np.arange(1, BANDS + 1, dtype=np.uint64)
    for i in range(PER_BAND):
        key = mixed(key * np.uint64(_GOLD) + parts[:, :, i])
    return key


def sketches(docs: DataFrame, k: int = K) -> DataFrame:
    """(doc_id, n_shingles, lo, hi, bands, sig): set size, 128-bit set identity, band keys, 32-bit signature."""
    def make(batches):
        for part in slices(batches):
            sets = [shingle_set(t, k) for t in part.column("text").to_pylist()]
            sig = signatures(sets)
            ids = [xxhash.xxh3_128_digest(s.tobytes()) for s in sets]
            two = np.frombuffer(b"".join(ids), np.int64).reshape(-1, 2)
            bands = pa.ListArray.from_arrays(np.arange(0, BANDS * len(sets) + 1, BANDS, dtype=np.int32),
                                             as_long(band_keys(sig).reshape(-1)))
            short = mixed(sig).astype(np.uint32)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()), pa.array(two[:, 0]),
                 pa.array(two[:, 1]), bands, pa.array([s.tobytes() for s in short], pa.binary())],
                names=["doc_id", "n_shingles", "lo", "hi", "bands", "sig"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), utf8().alias("text")) \
        .mapInArrow(make, "doc_id long, n_shingles long, lo long, hi long, bands array<long>, sig binary")


def full_sets(docs: DataFrame, ids: DataFrame, k: int = K) -> DataFrame:
    """(id, elements): the sets of the documents in ``ids`` (column id), from their whole texts."""
    def make(batches):
        for b in slices(batches):
            sets = [shingle_set(t, k).tobytes() for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(sets, pa.binary())], names=["id", "elements"])

    # A shuffle join at every size: the ids grow with the documents, and hashing spares sorting texts.
    return docs.select(F.col("doc_id").cast("long").alias("id"), utf8().alias("text")) \
        .join(ids.hint("shuffle_hash"), "id", "left_semi").mapInArrow(make, "id long, elements binary")


def linked(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Whether 100 * intersection >= percent * union of two sorted sets."""
    if len(x) < len(y):
        x, y = y, x
    if not len(y) or 100 * len(y) < percent * len(x):
        return False
    both = int((x[np.minimum(np.searchsorted(x, y), len(x) - 1)] == y).sum())
    return 100 * both >= percent * (len(x) + len(y) - both)


def confirmed(sets: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """Those of ``pairs`` (a, b) that are linked by their full ``sets``."""
    def check(batches):
        for b in slices(batches):
            keep = [linked(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), percent) for x, y in rows(b, "x", "y")]
            yield b.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    sides = pairs.join(sets.select(F.col("id").alias("b"), F.col("elements").alias("y")), "b") \
        .join(sets.select(F.col("id").alias("a"), F.col("elements").alias("x")), "a")
    return materialize(sides.mapInArrow(check, "a long, b long").distinct(), "dup-links")


def _open_buckets(shared: DataFrame, found: DataFrame) -> DataFrame:
    """(key, cls, label) of the buckets whose classes lie in several components."""
    labelled = shared.select("key", "cls").join(found.select(F.col("id").alias("cls"), "component"), "cls", "left") \
        .select("key", "cls", F.coalesce("component", "cls").alias("label"))
    several = labelled.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi").select("key")
    return materialize(labelled.join(several, "key", "left_semi"), "dup-rest")


def _across(rest: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between components of one bucket: enough of them to connect what is connected.

    ``rest`` has key, cls, label, bands, sig, elements. Each bucket is dealt into blocks of about
    ``BLOCK`` classes (fewer, where sets are large) and each two of its blocks meet in one group.
    A pair is compared in the first bucket that both are in, by signature and, if that comes near
    the threshold, by full sets, unless its components have been connected in this task by then.
    """
    least = max(1, int(SLOTS * (percent / 100 - SLACK)))
    n = F.greatest(F.ceil(F.count("*") / BLOCK), F.ceil(F.sum(F.length("elements")) / BLOCK_BYTES))
    sizes = rest.groupBy("key").agg(n.cast("int").alias("n"))
    block = F.pmod(F.xxhash64("cls"), F.col("n")).cast("int")
    dealt = rest.join(sizes, "key").withColumn("own", block) \
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n") - 1))) \
        .select("key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "cls", "label",
                "bands", "sig", "elements")

    def compare(t: pa.Table) -> pa.Table:
        key, i, j = (t.column(c)[0].as_py() for c in ("key", "i", "j"))
        own, cls, label = (t.column(c).to_numpy() for c in ("own", "cls", "label"))
        sig = np.frombuffer(b"".join(t.column("sig").to_pylist()), np.uint32).reshape(len(cls), -1)
        bands = t.column("bands").combine_chunks().flatten().to_numpy().reshape(len(cls), -1)
        sets = [np.frombuffer(x, np.uint64) for x in t.column("elements").to_pylist()]
        group = np.unique(label, return_inverse=True)[1]
        left, right = np.flatnonzero(own == i), np.flatnonzero(own == j)
        a, b = [], []
        for x in left:
            y = right[(group[right] != group[x]) & ((cls[right] > cls[x]) | (i != j))]
            alike = (sig[y] == sig[x]).sum(axis=1)
            y, alike = y[alike >= least], alike[alike >= least]
            shared = bands[y] == bands[x]
            first = bands[x][shared.argmax(axis=1)] == key
            y = y[first][np.argsort(-alike[first], kind="stable")]
            for z in y:
                if group[z] != group[x] and linked(sets[x], sets[z], percent):
                    a.append(int(min(cls[x], cls[z])))
                    b.append(int(max(cls[x], cls[z])))
                    group[group == group[z]] = group[x]
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return dealt.groupBy("key", "i", "j").applyInArrow(compare, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, percent: int = PERCENT, k: int = K) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) per row of ``docs``."""
    sketch = materialize(sketches(docs, k), "dup-sketch")
    full = sketch.where("n_shingles > 0 and doc_id is not null")
    classes = materialize(full.groupBy("lo", "hi").agg(F.min("doc_id").alias("cls")), "dup-classes")
    reps = full.select("lo", "hi", F.col("doc_id").alias("cls"), "bands").join(classes, ["lo", "hi", "cls"], "left_semi")
    keys = materialize(reps.select("cls", F.explode("bands").alias("key")), "dup-keys")
    hubs = keys.groupBy("key").agg(F.min("cls").alias("hub"), F.max("cls").alias("last")).where("hub <> last").drop("last")
    shared = materialize(keys.join(hubs, "key"), "dup-shared")
    release(keys)
    pairs = materialize(shared.where("cls <> hub").select(F.col("hub").alias("a"), F.col("cls").alias("b")).distinct(),
                        "dup-pairs")
    sets = materialize(full_sets(docs, shared.select(F.col("cls").alias("id")).distinct(), k), "dup-sets")
    links = confirmed(sets, pairs, percent)
    # Rows that share an id are one document: its id and the classes of its sets belong together.
    again = full.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select("doc_id")
    again = full.join(again, "doc_id", "left_semi").join(classes, ["lo", "hi"]) \
        .select(F.col("doc_id").alias("a"), F.col("cls").alias("b")).where("a <> b").distinct()
    links = links.union(again)
    found = components(links)
    rest = _open_buckets(shared, found)
    if not rest.isEmpty():
        whole = full.join(classes, ["lo", "hi"]).where("doc_id = cls").select("cls", "bands", "sig") \
            .dropDuplicates(["cls"]).join(sets.withColumnRenamed("id", "cls"), "cls")
        links = links.union(materialize(_across(rest.join(whole, "cls"), percent), "dup-links"))
        release(found)
        found = components(links)
    release(rest)
    out = sketch.select("doc_id", "n_shingles", "lo", "hi").join(classes, ["lo", "hi"], "left") \
        .join(found.withColumnRenamed("id", "cls"), "cls", "left") \
        .select("doc_id", "n_shingles",
                F.when(F.col("doc_id").isNull(), None).when(F.col("n_shingles") == 0, F.col("doc_id"))
                .otherwise(F.coalesce("component", "cls")).alias("component_id"))
    # An id with several sets: the smallest component of its rows (all are connected, but for empty ones).
    out = materialize(out.select("*", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept")), "dup-result")
    release(sketch, classes, shared, sets, pairs, found)
    return out


def drop_near_duplicates(docs: DataFrame, percent: int = PERCENT, k: int = K) -> DataFrame:
    """``docs`` without the documents that have a near copy with a smaller id; of equal rows one stays."""
    kept = near_duplicates(docs.select("doc_id", "text"), percent, k).where("kept").select("doc_id").distinct()
    key = free_name(docs, "_key")
    named = docs.where("doc_id is not null").join(kept.hint("shuffle_hash"), "doc_id", "left_semi").select(*docs.columns) \
        .withColumn(key, row_key()).dropDuplicates(["doc_id", key]).drop(key)
    return named.union(docs.where("doc_id is null"))
