"""Attaching one-row parameter tables to data rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def attach_row(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Add the columns of ``one_row`` to every row of ``df``.

    ``one_row`` is a global aggregate (exactly one row by construction). It
    is read as one scalar subquery: Spark runs it once, and every row gets
    its values as constants in a projection. There is no join and no data
    movement, and a second row would fail the query instead of multiplying
    rows.
    """
    cols = one_row.columns
    packed = one_row.select(F.struct(*cols).alias("_p")).scalar()
    return df.select("*", *[packed.getField(c).alias(c) for c in cols])
