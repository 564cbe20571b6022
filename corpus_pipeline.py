"""Corpus pipeline over ``documents``: each stage calls one operator of ``thermolytics.llm``.

``run(spark, sf_dir)`` applies STAGES in order. Each stage's result is written as Parquet under
the shared checkpoint folder and read again as the next one's ``docs``. All stages but the last
return the columns of documents, whatever columns those are beside doc_id, text and source.

Nulls, empty texts, repeated rows, empty tables and extra columns are treated as the stage's
operator says in its module.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from thermolytics.llm import lines, mixing, packing, quality, superminhash
from thermolytics.session import materialize, release

#: Not SQL: a learned classifier, set similarity over all documents and greedy packing.
ORACLE_SQL = None


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return quality.keep_good(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of templates that recur across documents go; the document stays."""
    return lines.dedup_lines(docs).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, that with the smallest doc_id."""
    return superminhash.drop_near_duplicates(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: not at all, once or twice."""
    return mixing.sample(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences, each seed document's window filled with its lexical neighbours."""
    return packing.pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", quality_filter),
    ("line_dedup", line_dedup),
    ("minhash_near_dedup", near_dedup),
    ("source_mixing", source_mix),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = []
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
        release(*before)
        before = [docs]
    return STAGES[-1][1](spark, docs, sf_dir)
