"""Row selection for training: hashed undersampling, period splits, business filter."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepanel.constants import FIRST_CHURN_PERIOD, FIRST_STAY_PERIOD, GONE_IN_ONE, GONE_IN_TWO, STAYS
from tidepanel.functions.features import binary_target, class_weight


def hashed_uniform(*parts: Column, steps: int = 1_000_000) -> Column:
    """A number in [0, 1) on a grid of ``steps``, fixed by the parts. Same value in every engine with md5."""
    digest = F.substring(F.md5(F.concat_ws("|", *[p.cast("string") for p in parts])), 1, 8)
    return (F.conv(digest, 16, 10).cast("bigint") % steps) / F.lit(float(steps))


def hashed_uniforms(n: int, seed: int, *parts: Column) -> list[Column]:
    """``n`` numbers in [0, 1) fixed by the parts: 32 bits each, eight from one digest."""
    out = []
    for i in range(n):
        digest = F.sha2(F.concat_ws("|", *[p.cast("string") for p in parts], F.lit(f"{seed}:{i // 8}")), 256)
        word = F.conv(F.substring(digest, 8 * (i % 8) + 1, 8), 16, 10).cast("bigint")
        out.append(word / F.lit(float(2**32)))
    return out


def hash_undersample(
    df: DataFrame, rate: float, seed: int, *, key: str = "id", label: str = "label"
) -> DataFrame:
    """All churn rows, and the staying rows of a hashed share of the entities.

    An entity is in or out for every month, and a larger rate keeps all of a smaller one. Rows without a
    label are dropped.
    """
    kept = hashed_uniform(F.col(key), F.lit(seed)) <= rate
    return df.where((F.col(label) != STAYS) | ((F.col(label) == STAYS) & kept))


def business_filter(
    df: DataFrame,
    evaluation: Sequence[int],
    *,
    first_churn: int = FIRST_CHURN_PERIOD,
    first_stay: int = FIRST_STAY_PERIOD,
    period: str = "period",
    label: str = "label",
) -> DataFrame:
    """Evaluation months whole; churn rows from ``first_churn``; staying rows from ``first_stay``."""
    month, cls = F.col(period), F.col(label)
    return df.where(
        month.isin(*evaluation)
        | (cls.isin(GONE_IN_ONE, GONE_IN_TWO) & (month >= first_churn))
        | ((cls == STAYS) & (month >= first_stay))
    )


def period_split(
    df: DataFrame,
    train: Sequence[int],
    test: Sequence[int],
    prediction: Sequence[int],
    *,
    rate: float | None = None,
    seed: int = 0,
    key: str = "id",
    period: str = "period",
    label: str = "label",
) -> DataFrame:
    """Rows with a ``split`` column and the targets y and w, in one pass.

    A month in several lists appears once per split. Only training rows are undersampled.
    """
    names = F.array_compact(
        F.array(
            F.when(F.col(period).isin(*train), "train"),
            F.when(F.col(period).isin(*test), "test"),
            F.when(F.col(period).isin(*prediction), "pred"),
        )
    )
    wanted = df.where(F.col(period).isin(*{*train, *test, *prediction}))
    out = wanted.withColumn("split", F.explode(names))
    if rate is not None:
        kept = hashed_uniform(F.col(key), F.lit(seed)) <= rate
        in_sample = F.coalesce((F.col(label) != STAYS) | kept, F.lit(False))
        out = out.where((F.col("split") != "train") | (F.col(label).isNotNull() & in_sample))
    y = F.col("y") if "y" in df.columns else binary_target(F.col(label))
    w = F.col("w") if "w" in df.columns else class_weight(F.col(label), 1.0)
    return out.withColumns({"y": y, "w": w})


def period_holdout(df: DataFrame, validation: Sequence[int], *, period: str = "period") -> DataFrame:
    """Adds ``is_validation``: true in the listed months."""
    return df.withColumn("is_validation", F.col(period).isin(*validation))


def split_counts(df: DataFrame, expected: Sequence[str], *, split: str = "split", rest: str = "rest") -> DataFrame:
    """Rows per expected split, 0 included, and of all others together, with a flag on the empty ones."""
    listed = F.coalesce(F.col(split).isin(*expected), F.lit(False))
    counts = [F.count(F.when(F.col(split) == s, 1)).alias(s) for s in expected]
    counted = df.agg(*counts, F.count(F.when(~listed, 1)).alias(rest)).unpivot([], [*expected, rest], split, "n")
    return counted.withColumn("is_empty", F.col("n") == 0)
