"""Casts that turn bad values into NULL, and text clean-up expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepanel.constants import MISTYPED_NO, NO_TOKENS, NULL_TOKENS, YES_TOKENS

_FLOATING = ("double", "float", "float64")


def text_to_double(text: Column) -> Column:
    """Number in the text or NULL. Java-style suffixes (``7d``, ``1.5f``) are not numbers."""
    return F.when(~text.rlike(r"(?i)[0-9.][df]\s*$"), text.try_cast("double"))


def safe_cast(df: DataFrame, column: str, to: str) -> Column:
    """Cast one column of ``df``; a value that does not fit becomes NULL."""
    source = df.schema[column].dataType
    if isinstance(source, T.StringType) and to.lower() in _FLOATING:
        return text_to_double(F.col(column))
    return F.col(column).try_cast(to)


def number(df: DataFrame, column: str) -> Column:
    return safe_cast(df, column, "double")


def null_if_token(text: Column) -> Column:
    """Trimmed text; the tokens that stand for a missing value become NULL."""
    trimmed = F.trim(text)
    return F.when(~trimmed.isin(*NULL_TOKENS), trimmed)


def looks_yes_no(text: Column) -> Column:
    """Words that speak for a yes / no column; a mistyped no is read as one but is no evidence."""
    return F.upper(text).isin(*YES_TOKENS, *[t for t in NO_TOKENS if t != MISTYPED_NO])


def yes_no_number(text: Column) -> Column:
    upper = F.upper(text)
    return F.when(upper.isin(*YES_TOKENS), 1.0).when(upper.isin(*NO_TOKENS), 0.0)


def epoch_day(text: Column) -> Column:
    """Days since 1970-01-01; text that is no date becomes NULL."""
    return F.unix_date(text.try_cast("timestamp_ntz").cast("date")).cast("double")


def decimal_comma_number(text: Column) -> Column:
    return text_to_double(F.replace(text, F.lit(","), F.lit(".")))
