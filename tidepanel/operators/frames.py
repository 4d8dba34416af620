"""Selecting columns and rows of a panel."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepanel.constants import BAD_PERIODS, TARGET_COLUMNS
from tidepanel.functions.casts import safe_cast
from tidepanel.functions.features import nonzero_count
from tidepanel.functions.names import columns_last, groups_by_substring, numeric_columns, within_depth
from tidepanel.functions.periods import months_between


def cast_columns(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast the mapped columns in place; bad values become NULL."""
    return df.select(*[safe_cast(df, c, types[c]).alias(c) if c in types else F.col(c) for c in df.columns])


def select_numeric(df: DataFrame, exclude: Sequence[str] = ()) -> DataFrame:
    return df.select(*numeric_columns(df, exclude))


def drop_targets(df: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """Without target and weight columns (and ``extra``), whichever of them exist."""
    return df.drop(*TARGET_COLUMNS, *extra)


def select_depth(df: DataFrame, depth: int) -> DataFrame:
    """Base columns and the lag / delta columns of levels 1..depth."""
    return df.select(*within_depth(df.columns, depth))


def exclude_periods(df: DataFrame, periods: Sequence[int] = BAD_PERIODS, *, period: str = "period") -> DataFrame:
    return df.where(~F.col(period).isin(*periods))


def label_last(df: DataFrame, *aux: str, label: str = "label") -> DataFrame:
    """Without the auxiliary columns, label at the end."""
    kept = df.drop(*aux)
    return kept.select(*columns_last(kept, label))


def align_to_features(df: DataFrame, features: Sequence[str], *, on_missing: str = "raise") -> DataFrame:
    """Exactly the model's features, in its order; a missing one is filled with 0 or an error."""
    missing = [f for f in features if f not in df.columns]
    if missing and on_missing != "zero":
        raise ValueError(f"features not in the frame: {missing}")
    return df.select(*[F.lit(0.0).alias(f) if f in missing else F.col(f) for f in features])


def product_counts(
    df: DataFrame, groups: Mapping[str, str], rest: str, exclude: Sequence[str]
) -> DataFrame:
    """Adds ``q_<group>`` per column group: how many of its columns are non-zero in the row."""
    members = groups_by_substring(df.columns, dict(groups), rest, exclude)
    return df.withColumns({f"q_{g}": nonzero_count(df, columns) for g, columns in members.items()})


def period_calendar(df: DataFrame, *, period: str = "period") -> DataFrame:
    """Every valid month between the first and the last one of the frame."""
    ends = df.agg(F.min(period).alias("first"), F.max(period).alias("last"))
    return ends.select(F.explode(months_between(F.col("first"), F.col("last"))).alias(period))
