"""Turning text columns into numbers by looking at their values and names."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepanel.functions.casts import (
    decimal_comma_number,
    epoch_day,
    looks_yes_no,
    null_if_token,
    yes_no_number,
)
from tidepanel.functions.names import is_date, text_columns

YES_NO_SHARE = 0.8


def normalise_null_tokens(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: null_if_token(F.col(c)) for c in columns})


def yes_no_columns(df: DataFrame, columns: Sequence[str], share: float = YES_NO_SHARE) -> list[str]:
    """Columns of which more than ``share`` of all known values are yes / no words; one aggregate for all columns."""
    if not columns:
        return []
    found = df.agg(*[F.avg(looks_yes_no(F.col(c)).cast("int")).alias(c) for c in columns]).first()
    return [c for c, part in zip(columns, found) if part is not None and part > share]


def coerce_text(df: DataFrame, *, skip: Sequence[str] = ("label",)) -> DataFrame:
    """All text columns as numbers: yes / no words, then dates by column name, then decimal numbers."""
    columns = text_columns(df, skip)
    clean = normalise_null_tokens(df, columns)
    flags = set(yes_no_columns(clean, columns))

    def converted(c: str):
        if c in flags:
            return yes_no_number(F.col(c))
        return epoch_day(F.col(c)) if is_date(c) else decimal_comma_number(F.col(c))

    return clean.withColumns({c: converted(c) for c in columns}) if columns else clean


def column_ranges(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, min, max) of each numeric column from one pass."""
    bounds = [F.struct(F.lit(c).alias("column"), *_bounds(c)) for c in columns]
    return df.agg(F.array(*bounds).alias("_r")).select(F.inline("_r"))


def _bounds(c: str):
    value = F.col(c).cast("double")
    return F.min(value).alias("min"), F.max(value).alias("max")
