"""Row-wise feature and target expressions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepanel.constants import (
    CONTACT_COST,
    GONE_IN_ONE,
    GONE_IN_TWO,
    HIT_PROFIT,
    STAYS,
    TENURE_FACTORS,
    WEIGHTS,
)
from tidepanel.functions.casts import number


def tenure_scaled(amount: Column, tenure: Column) -> Column:
    """Scale a trailing-quarter count up for entities younger than a quarter plus one month."""
    scaled = F
    for months, factor in TENURE_FACTORS.items():
        scaled = scaled.when(tenure == months, amount * F.lit(factor))
    return scaled.otherwise(amount.cast("double"))


def guarded_ratio(numerator: Column, denominator: Column) -> Column:
    """NULL when the denominator is NULL or 0."""
    return numerator.cast("double") / F.nullif(denominator.cast("double"), F.lit(0.0))


def nonzero_count(df: DataFrame, columns: Sequence[str]) -> Column:
    """How many of the columns hold a non-zero number in this row."""
    ones = [F.when(number(df, c) != 0, 1).otherwise(0) for c in columns]
    return reduce(add, ones, F.lit(0)).cast("bigint")


def binary_target(label: Column) -> Column:
    """1 for both churn classes, 0 for staying, NULL without a label."""
    return F.when(label.isin(GONE_IN_ONE, GONE_IN_TWO), 1).when(label == STAYS, 0).cast("bigint")


def class_weight(label: Column, default: float | None = None) -> Column:
    weight = F
    for name, value in WEIGHTS.items():
        weight = weight.when(label == name, F.lit(value))
    return weight.otherwise(F.lit(default).cast("double"))


def hit_target(label: Column) -> Column:
    """1 for the class that earns money; a missing label counts as 0."""
    return F.when(label == GONE_IN_TWO, 1).otherwise(0).cast("bigint")


def not_staying_target(label: Column) -> Column:
    """0 for staying; a missing label counts as 1."""
    return F.when(label == STAYS, 0).otherwise(1).cast("bigint")


def contact_profit(label: Column, hit: int = HIT_PROFIT, cost: int = CONTACT_COST) -> Column:
    """Profit of contacting the row. Whole currency units; a missing label costs money like any miss."""
    return F.when(label == GONE_IN_TWO, F.lit(hit)).otherwise(F.lit(-cost)).cast("bigint")


def confusion_profit(
    actual: Column, predicted: Column, hit: int = HIT_PROFIT, cost: int = CONTACT_COST
) -> Column:
    """Aggregate: profit of all predicted positives."""
    row = F.when((actual == 1) & (predicted == 1), F.lit(hit)).when((actual == 0) & (predicted == 1), F.lit(-cost))
    return F.sum(row.otherwise(0).cast("bigint"))


def weighted_momentum(deltas: Sequence[Column]) -> Column:
    """Deltas of levels 1..K weighted K..1; NULL if any level is NULL."""
    depth = len(deltas)
    return reduce(add, [d * F.lit(depth - i) for i, d in enumerate(deltas)])
