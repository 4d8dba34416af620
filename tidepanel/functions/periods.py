"""Column expressions over months stored as integer YYYYMM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def month_of_year(period: Column) -> Column:
    return period % 100


def month_serial(period: Column) -> Column:
    """Months since year 0: 202401 -> 24289. Consecutive months differ by one."""
    return F.floor(period / 100).cast("bigint") * 12 + period % 100


def months_between(first: Column, last: Column) -> Column:
    """Array of every valid YYYYMM from ``first`` to ``last``, both included."""
    return F.transform(
        F.sequence(month_serial(first) - 1, month_serial(last) - 1),
        lambda s: F.floor(s / 12).cast("bigint") * 100 + s % 12 + 1,
    )
