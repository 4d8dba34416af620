"""Unions, merges into small result tables, reshaping."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepanel.functions.casts import safe_cast


def union_aligned(*frames: DataFrame, types: Mapping[str, str] | None = None) -> DataFrame:
    """UNION ALL with the first frame's columns; columns in ``types`` are cast, bad values become NULL.

    Extra columns of later frames are ignored, a missing one is an error.
    """
    columns, types = frames[0].columns, types or {}

    def aligned(df: DataFrame) -> DataFrame:
        return df.select(*[safe_cast(df, c, types[c]).alias(c) if c in types else F.col(c) for c in columns])

    return reduce(DataFrame.unionByName, [aligned(f) for f in frames])


def union_positional(*frames: DataFrame) -> DataFrame:
    """UNION ALL by column position."""
    return reduce(DataFrame.union, frames)


def stack_models(frames: Mapping[str, DataFrame], name: str = "model") -> DataFrame:
    """Per-model frames in one long frame, the model's name in a column."""
    return reduce(DataFrame.unionByName, [df.withColumn(name, F.lit(m)) for m, df in frames.items()])


def upsert(old: DataFrame, new: DataFrame, keys: Sequence[str], **stamp: Column) -> DataFrame:
    """``old`` with the rows of ``new`` replacing those of equal key, the others added.

    A key that ``new`` has more than once is an error: say first which row counts, with ``keep_last``. ``stamp`` sets columns on the rows that come from ``new`` (a timestamp, say). The result is a new frame:
    write it to a path other than the one ``old`` was read from.
    """
    # Counted by a partial aggregation, so that a key with very many rows does not gather anywhere to be refused.
    repeated = new.groupBy(*keys).agg(F.count(F.lit(1)).alias("_times")).where("_times > 1").limit(1)
    message = F.concat(F.lit("repeated key in the new rows: "), F.to_json(F.struct(*keys)))
    refused = repeated.select(F.raise_error(message).cast("boolean").alias("_refused"))
    checked = new.withColumn("_refused", refused.scalar()).where(F.col("_refused").isNull()).drop("_refused")
    fresh = checked.withColumns(stamp) if stamp else checked
    return old.join(new.select(*keys), list(keys), "left_anti").select(*old.columns).unionByName(fresh)


def insert_if_absent(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``old`` plus the rows of ``new`` whose key it does not have."""
    return old.unionByName(new.join(old.select(*keys), list(keys), "left_anti").select(*new.columns))


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row per key in the given order. Partial aggregation: a frequent key never moves as a whole."""
    values = [c for c in df.columns if c not in keys]
    last = F.max_by(F.struct(*values), F.struct(*order)).alias("_last")
    return df.groupBy(*keys).agg(last).select(*keys, "_last.*").select(*df.columns)


def unpivot_columns(
    df: DataFrame, columns: Sequence[str], *, keys: Sequence[str] = (), name: str = "col_name", value: str = "value"
) -> DataFrame:
    """Wide to long. Rows without a value are left out."""
    doubles = df.select(*keys, *[F.col(c).cast("double").alias(c) for c in columns])
    return doubles.unpivot(list(keys), list(columns), name, value).where(F.col(value).isNotNull())
