"""How far each feature's mean change lies from that of the other features."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepanel.operators.combine import unpivot_columns
from tidepanel.functions.features import weighted_momentum
from tidepanel.functions.names import within_depth
from tidepanel.functions.casts import number

LEVELS = 5


def delta_columns(columns: Sequence[str], levels: int = LEVELS) -> list[str]:
    """Columns named ``<feature>_delta_<level>`` with a level of 1..levels."""
    return [c for c in within_depth(columns, levels) if re.search(r"_delta_\d+$", c)]


def feature_of(name: Column) -> Column:
    return F.regexp_extract(name, r"^(.*)_delta_[0-9]+$", 1)


def level_of(name: Column) -> Column:
    return F.regexp_extract(name, r"_delta_([0-9]+)$", 1).try_cast("bigint")


def mean_of_each(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Mean of every column, over the table or per group."""
    return df.groupBy(*by).agg(*[F.avg(c).alias(c) for c in columns])


def long_means(means: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """(by.., feature, lvl, value) from a wide frame of means."""
    long = unpivot_columns(means, columns, keys=by)
    return long.select(
        *by, feature_of(F.col("col_name")).alias("feature"), level_of(F.col("col_name")).alias("lvl"), "value"
    )


def zscore_by_level(long: DataFrame, *, level: str = "lvl", value: str = "value") -> DataFrame:
    """Standard score of each value among all values of its level; NULL where the level does not vary.

    Every row stays; a NULL level is a level. Level statistics are aggregated and joined back, so no level is gathered in one task.
    """
    stats = long.groupBy(F.col(level).alias("_level")).agg(F.avg(value).alias("_mean"), F.stddev_samp(value).alias("_std"))
    scored = long.join(stats, F.col(level).eqNullSafe(F.col("_level")))
    z = F.try_divide(F.col(value) - F.col("_mean"), F.col("_std")).alias("z_score")
    return scored.select(*long.columns, z)


def pivot_levels(scored: DataFrame, *, by: Sequence[str] = (), levels: int = LEVELS) -> DataFrame:
    """One row per feature (and group) with the scores of level 1..levels side by side."""
    cells = [
        F.avg(F.when(F.col("lvl") == i, F.col("z_score"))).alias(f"delta_{i}") for i in range(1, levels + 1)
    ]
    return scored.groupBy(*by, "feature").agg(*cells)


def delta_zscore_matrix(df: DataFrame, *, by: Sequence[str] = (), levels: int = LEVELS) -> DataFrame:
    """Means of all delta columns, standardised per level, one row per feature (and group)."""
    columns = delta_columns(df.columns, levels)
    long = long_means(mean_of_each(df, columns, by), columns, by)
    return pivot_levels(zscore_by_level(long), by=by, levels=levels)


def with_momentum(df: DataFrame, features: Sequence[str], depth: int = 3) -> DataFrame:
    """Adds ``<feature>_momentum``: the deltas of levels 1..depth weighted depth..1."""
    added = {f"{f}_momentum": weighted_momentum([F.col(f"{f}_delta_{k}") for k in range(1, depth + 1)]) for f in features}
    return df.withColumns(added)


def delta_from_lags(df: DataFrame, columns: Sequence[str], depth: int) -> DataFrame:
    """Adds ``<c>_delta_<k>`` from stored ``<c>_lag_<k>`` columns; values that are no numbers give NULL."""
    added = {
        f"{c}_delta_{k}": number(df, c) - number(df, f"{c}_lag_{k}") for c in columns for k in range(1, depth + 1)
    }
    return df.withColumns(added)
