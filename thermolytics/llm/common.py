"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word: a run of characters other than space, tab, line feed, VT, FF and carriage return.
#: ``bytes.split()`` cuts UTF-8 text at exactly these characters.
WORD = r"[^\x20\x09-\x0D]+"

_MULT = np.uint64(0x9E3779B97F4A7C15)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_name(df: DataFrame, base: str) -> str:
    """``base``, with underscores added until no column of ``df`` has that name (in any case)."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base += "_"
    return base


def row_key(doc_id: str = "doc_id", text: str = "text") -> Column:
    """64-bit identity of a row by id and text. Equal rows share it, and get equal results."""
    return F.xxhash64(F.col(doc_id).isNull(), F.col(doc_id), F.col(text).isNull(), F.col(text))


def utf8(col: str = "text") -> Column:
    """UTF-8 bytes of a text column, empty for null."""
    return F.coalesce(F.col(col).cast("string").cast("binary"), F.lit(b""))


class Numbers(dict):
    """Numbers its keys 0, 1, ... as they are first looked up."""

    def __missing__(self, key):
        self[key] = n = len(self)
        return n


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def mixed(a: np.ndarray) -> np.ndarray:
    """Finalise 64-bit sums so that their order and low bits are uniform."""
    a = (a ^ (a >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    a = (a ^ (a >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return a ^ (a >> np.uint64(31))


def run_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of ``k`` consecutive entries of ``h`` (none if it is shorter)."""
    n = len(h) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    a = np.zeros(n, np.uint64)
    for j in range(k):
        a = a * _MULT + h[j:j + n]
    return mixed(a)


def as_long(a: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(a).view(np.int64))


def rows(batch: pa.RecordBatch, *names: str) -> Iterator[tuple]:
    """Rows of an Arrow batch as tuples of Python values."""
    return zip(*(batch.column(n).to_pylist() for n in names), strict=True)


def slices(batches: Iterable[pa.RecordBatch], n: int = 256) -> Iterator[pa.RecordBatch]:
    """The batches in slices of ``n`` rows, so that a kernel holds Python objects of few rows at a time."""
    for b in batches:
        for i in range(0, b.num_rows, n):
            yield b.slice(i, n)


def slots(spark: SparkSession) -> int:
    """Partitions for CPU-heavy steps over small rows: as many as shuffles have, and no fewer than task slots."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
