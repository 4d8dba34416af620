"""Attaching the values of a one-row aggregate to every row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_scalars(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """``df`` plus the columns of ``one_row``, NULL if it is empty.

    A scalar subquery: computed once, then a constant in the projection. No join, so the partitioning and the
    order of ``df`` stay as they are for the windows that follow.
    """
    packed = one_row.select(F.struct(*one_row.columns).alias("_scalars"))
    return df.withColumn("_scalars", packed.scalar()).select(*df.columns, "_scalars.*")
