"""Feature importances, random probe columns and the cut they define."""

from __future__ import annotations

import random
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepanel.constants import CANARY
from tidepanel.functions.names import numeric_columns
from tidepanel.operators.sampling import hashed_uniforms
from tidepanel.operators.scalars import with_scalars


def canary_sources(columns: Sequence[str], n: int, seed: int) -> list[str]:
    """The column whose range each canary copies."""
    pick = random.Random(seed)
    return [pick.choice(list(columns)) for _ in range(n)]


def add_canaries(
    df: DataFrame,
    n: int = 20,
    *,
    seed: int = 42,
    keys: Sequence[str] = ("id", "period"),
    exclude: Sequence[str] = (),
) -> DataFrame:
    """Adds ``canary_0..n-1``: noise over the range of a random numeric column.

    The noise is a hash of the row's key, so a retried task or a second read sees the same values.
    """
    sources = canary_sources(numeric_columns(df, [*keys, *exclude]), n, seed)
    bounds = []
    for c in sorted(set(sources)):
        bounds += [F.min(F.col(c).cast("double")).alias(f"_lo_{c}"), F.max(F.col(c).cast("double")).alias(f"_hi_{c}")]
    with_bounds = with_scalars(df, df.agg(*bounds))
    uniform = hashed_uniforms(n, seed, *[F.col(k) for k in keys])
    noise = [
        (F.col(f"_lo_{c}") + (F.col(f"_hi_{c}") - F.col(f"_lo_{c}")) * u).alias(f"{CANARY}_{i}")
        for i, (c, u) in enumerate(zip(sources, uniform))
    ]
    return with_bounds.select(*df.columns, *noise)


def is_canary(feature: str = "feature"):
    return F.col(feature).ilike(f"%{CANARY}%")


def canary_rows(importances: DataFrame) -> DataFrame:
    """Importance rows of the probe columns."""
    return importances.where(is_canary())


def canary_cut(
    importances: DataFrame, *, gain: str = "gain", feature: str = "feature", group: Sequence[str] = ()
) -> DataFrame:
    """Features ranked strictly above the best canary (gain desc, then name); all if no canary ranks.

    Compares with the best canary's row instead of ranking: an aggregate per group and a filter.
    """
    # Order key: larger is better, the smaller name wins among equal gains.
    best = importances.where(is_canary(feature)).groupBy(*group).agg(
        F.max(gain).alias("_best"), F.min_by(feature, F.struct((-F.col(gain)).alias("g"), F.col(feature))).alias("_name")
    )
    if group:
        compared = importances.join(best, list(group), "left")
    else:
        compared = with_scalars(importances, best)
    above = (
        F.col("_best").isNull()
        | (F.col(gain) > F.col("_best"))
        | ((F.col(gain) == F.col("_best")) & (F.col(feature) < F.col("_name")))
    )
    return compared.where(above).select(*importances.columns)


def canary_gain_band(importances: DataFrame, gain: str = "gain", share: float = 0.45) -> DataFrame:
    """Mean gain of the canaries and the bounds ``share`` above and below it."""
    mean = canary_rows(importances).agg(F.avg(gain).alias("mean_gain"))
    return mean.select(
        "mean_gain",
        (F.col("mean_gain") * F.lit(1 + share)).alias("upper"),
        (F.col("mean_gain") * F.lit(1 - share)).alias("lower"),
    )


def importance_summary(importances: DataFrame, gain: str = "gain", feature: str = "feature") -> DataFrame:
    """Per feature: mean, sample deviation and number of models, largest mean first."""
    summary = importances.groupBy(feature).agg(
        F.avg(gain).alias("mean"), F.stddev_samp(gain).alias("std"), F.count(gain).alias("count")
    )
    return summary.orderBy(F.desc("mean"), feature)


def importance_mean(importances: DataFrame, gain: str = "gain", feature: str = "feature") -> DataFrame:
    return importances.groupBy(feature).agg(F.avg(gain).alias("mean_gain"))


def importance_topk(importances: DataFrame, k: int = 20, gain: str = "gain", feature: str = "feature") -> DataFrame:
    return importances.orderBy(F.desc(gain), feature).limit(k)
