"""Column sets chosen from a schema by name or type."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tidepanel.constants import DATE_NAME_PATTERN


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    skip = set(exclude)
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType) and f.name not in skip]


def text_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    skip = set(exclude)
    return [f.name for f in df.schema if isinstance(f.dataType, T.StringType) and f.name not in skip]


def within_depth(columns: Sequence[str], depth: int) -> list[str]:
    """Base columns plus the lag/delta columns of levels 1..depth.

    A column whose name holds ``_lag`` or ``_delta`` anywhere is derived; it stays only with a trailing
    level inside the range, written with or without a separator (``x_lag2``, ``x_delta_2``).
    """
    level = re.compile(r"_(?:lag|delta)_?(\d+)$")

    def keep(name: str) -> bool:
        if "_lag" not in name and "_delta" not in name:
            return True
        found = level.search(name)
        return found is not None and 1 <= int(found.group(1)) <= depth

    return [c for c in columns if keep(c)]


def groups_by_substring(
    columns: Sequence[str], substrings: dict[str, str], rest: str, exclude: Iterable[str] = ()
) -> dict[str, list[str]]:
    """Split columns by case-insensitive substring; one holding two substrings is in both groups."""
    skip = set(exclude)
    names = [c for c in columns if c not in skip]
    groups = {g: [c for c in names if s.lower() in c.lower()] for g, s in substrings.items()}
    taken = {c for members in groups.values() for c in members}
    groups[rest] = [c for c in names if c not in taken]
    return groups


def is_money(name: str, period: str = "period") -> bool:
    return name != period and (name.startswith("m") or "_m" in name)


def is_date(name: str) -> bool:
    return re.search(DATE_NAME_PATTERN, name.lower()) is not None


def columns_last(df: DataFrame, *last: str) -> list[str]:
    """All columns with ``last`` moved to the end."""
    return [c for c in df.columns if c not in last] + list(last)
