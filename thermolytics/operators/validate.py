"""Schema contract check: compare a table's schema with a JSON contract and
profile the contract columns in one pass over the data."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def load_contract(text) -> dict:
    """JSON text (or a dict) with a ``columns`` list of {name, type}."""
    d = json.loads(text) if isinstance(text, (str, bytes)) else text
    if not isinstance(d, dict) or "columns" not in d:
        raise ValueError("A contract is a JSON object that lists its columns under 'columns'")
    return d


def type_name(dt: T.DataType) -> str:
    """Spark's JSON type name for atomic types (integer, long, timestamp, ...),
    ``simpleString`` for nested ones."""
    j = json.loads(dt.json())
    return j if isinstance(j, str) else dt.simpleString()


def _status_rows(schema: T.StructType, contract: dict):
    expected = {c["name"].lower(): (c["name"], str(c["type"])) for c in contract["columns"]}
    actual = {f.name.lower(): f for f in schema.fields}
    rows = []
    for key, (name, etype) in expected.items():
        f = actual.get(key)
        if f is None:
            rows.append((name, etype, None, "missing"))
        else:
            atype = type_name(f.dataType)
            rows.append((f.name, etype, atype, "ok" if atype.lower() == etype.lower() else "type_mismatch"))
    for key, f in actual.items():
        if key not in expected:
            rows.append((f.name, None, type_name(f.dataType), "extra"))
    return rows


def check_contract(df: DataFrame, contract) -> DataFrame:
    """Status per column plus a data profile: rows, nulls and values that do
    not convert to the contract type (``try_cast``), from one aggregate.

    status: ok / type_mismatch / missing (failures) / extra (warning only).
    """
    contract = load_contract(contract)
    spark = df.sparkSession
    rows = _status_rows(df.schema, contract)
    present = [(c, e) for c, e, a, s in rows if a is not None]
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for i, (c, etype) in enumerate(present):
        col = F.col(f"`{c}`")
        aggs.append(F.count_if(col.isNull()).alias(f"_n{i}"))
        if etype is None:
            aggs.append(F.lit(None).cast("long").alias(f"_b{i}"))
        else:
            aggs.append(F.count_if(col.isNotNull() & col.try_cast(etype).isNull()).alias(f"_b{i}"))
    prof = df.agg(*aggs)
    pairs = ", ".join(f"'{c}', `_n{i}`, `_b{i}`" for i, (c, _) in enumerate(present))
    long = prof.selectExpr("_rows AS rows", f"stack({len(present)}, {pairs}) AS (column, nulls, invalid)") \
        if present else None
    status = spark.createDataFrame(rows, "column string, expected string, actual string, status string")
    if long is None:
        return status.select("*", F.lit(None).cast("long").alias("rows"), F.lit(None).cast("long").alias("nulls"),
                             F.lit(None).cast("long").alias("invalid"))
    return status.join(long, "column", "left").select("column", "expected", "actual", "status", "rows", "nulls", "invalid")


def contract_passed(report: DataFrame) -> DataFrame:
    """One row: passed = no missing column and no type mismatch."""
    return report.agg(F.coalesce(F.bool_and(~F.col("status").isin("missing", "type_mismatch", "unreadable")),
                                 F.lit(True)).alias("passed"))


def validate_path(spark: SparkSession, path: str, contract, fmt: str = "parquet") -> DataFrame:
    """``check_contract`` on the table at ``path``; a path that cannot be read gives one
    row with status ``unreadable`` (a failure) instead of an exception."""
    from pyspark.sql.utils import AnalysisException
    try:
        df = spark.read.format(fmt).load(path)
    except AnalysisException as exc:
        msg = str(exc).splitlines()[0][:500]
        return spark.createDataFrame(
            [(None, None, msg, "unreadable", None, None, None)],
            "column string, expected string, actual string, status string, rows long, nulls long, invalid long")
    return check_contract(df, contract)
