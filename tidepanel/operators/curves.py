"""Gain curves, best cuts, plateau score and top-k lists.

Position i counts from 0 and holds the profit of the first i + 1 contacts; ``rk = i + 1``. The best cut
``k_opt`` is the first position of the maximum, its threshold is the score one position earlier.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepanel.constants import (
    CURVE_CEILING,
    CURVE_FLOOR,
    FINAL_CONTACTS,
    PLATEAU_HALF_WIDTH,
    SCORE_THRESHOLD,
)
from tidepanel.functions.features import confusion_profit, contact_profit, hit_target
from tidepanel.operators.ranking import BROADCAST_ROWS, CUMULATIVE, PREVIOUS_SCORE, RANK, Ranking, null_safe_join, rank
from tidepanel.operators.scalars import with_scalars
from tidepanel.sources.scratch import materialise

KEY = ("id", "period")


def ranked_profit(
    df: DataFrame,
    *,
    score: str = "score",
    label: str = "label",
    group: Sequence[str] = ("model",),
    tie: Sequence[str] = KEY,
    rows_per_bucket: int | None = None,
) -> Ranking:
    """Scores with the profit of each row, ready for the curve operators below."""
    profit = df.select(*group, *tie, F.col(score).alias("score"), contact_profit(F.col(label)).alias("gain"))
    return rank(profit, "score", group=group, tie=tie, gain="gain", rows_per_bucket=rows_per_bucket)


def cumulative_gain(ranking: Ranking) -> DataFrame:
    """Running profit at every rank."""
    return ranking.ranked().drop(PREVIOUS_SCORE)


def gain_curve_segment(
    ranking: Ranking, floor: int = CURVE_FLOOR, ceiling: int = CURVE_CEILING
) -> DataFrame:
    """Running profit at positions floor <= k < ceiling."""
    return _segment(ranking, floor, ceiling).drop(PREVIOUS_SCORE, RANK)


def _segment(ranking: Ranking, floor: int, ceiling: int) -> DataFrame:
    return ranking.between(floor + 1, ceiling).withColumn("k", F.col(RANK) - 1)


def best_cut(ranking: Ranking, floor: int = CURVE_FLOOR, ceiling: int = CURVE_CEILING) -> DataFrame:
    """Per group: k_opt, gain_max and thr_opt inside the segment."""
    top = F.max(F.struct(F.col(CUMULATIVE), -F.col("k"), F.col(PREVIOUS_SCORE))).alias("top")
    cuts = _segment(ranking, floor, ceiling).groupBy(*ranking.group).agg(top)
    return cuts.select(
        *ranking.group,
        (-F.col("top").getField("col2")).alias("k_opt"),
        F.col(f"top.{CUMULATIVE}").alias("gain_max"),
        F.col(f"top.{PREVIOUS_SCORE}").alias("thr_opt"),
    )


def max_gain(ranking: Ranking) -> DataFrame:
    """Highest running profit over the whole list and the number of contacts that first reaches it."""
    peaks = _peaks(ranking)
    return peaks.select(*ranking.group, (F.col("peak") + 1).alias("k_max"), "gain_max")


def _peaks(ranking: Ranking) -> DataFrame:
    """The largest prefix sum of each group, from the buckets' sums and largest prefixes: no row is read again."""
    place = F.col("_n_before") + F.col("_peak_place")
    found = ranking.offsets().groupBy(*ranking.group).agg(F.max(F.struct(F.col("_g_top").alias("gain"), (-place).alias("place"))).alias("top"))
    return found.select(*ranking.group, (-F.col("top.place") - 1).alias("peak"), F.col("top.gain").alias("gain_max"))


def plateau_gain(ranking: Ranking, half_width: int = PLATEAU_HALF_WIDTH) -> DataFrame:
    """Mean running profit over positions [peak - half_width, peak + half_width), clipped to the list."""
    around = _peaks(ranking).select(
        *ranking.group,
        "peak",
        "gain_max",
        F.greatest(F.col("peak") - half_width, F.lit(0)).alias("_from"),
        (F.col("peak") + half_width).alias("_to"),
    )
    starts = ranking.overlapping(F.col("_from") + 1, F.col("_to"), around)
    near = ranking.with_group(ranking.ranked(starts), around).where(
        (F.col(RANK) > F.col("_from")) & (F.col(RANK) <= F.col("_to"))
    )
    return near.groupBy(*ranking.group).agg(
        F.avg(CUMULATIVE).alias("plateau_gain"),
        F.max("peak").alias("peak"),
        F.max("gain_max").alias("gain_max"),
    )


def mean_gain_curve(
    ranking: Ranking, floor: int = CURVE_FLOOR, ceiling: int = CURVE_CEILING
) -> DataFrame:
    """Mean over the groups of the running profit at each position of the segment."""
    return _segment(ranking, floor, ceiling).groupBy("k").agg(F.avg(CUMULATIVE).alias("mean_gain"))


def mean_best_cut(ranking: Ranking, floor: int = CURVE_FLOOR, ceiling: int = CURVE_CEILING) -> DataFrame:
    """Best position of the mean curve, its value, and the groups' mean score one position earlier.

    The mean score is carried along each position, so the segment is ranked once.
    """
    points = _segment(ranking, floor, ceiling).groupBy("k").agg(
        F.avg(CUMULATIVE).alias("mean_gain"), _steady_mean(PREVIOUS_SCORE).alias("mean_thr")
    )
    top = F.max(F.struct(F.col("mean_gain"), -F.col("k"), F.col("mean_thr"))).alias("top")
    return points.agg(top).select(
        (-F.col("top").getField("col2")).alias("k_opt"),
        F.col("top.mean_gain").alias("gain_max"),
        F.col("top.mean_thr").alias("mean_thr"),
    )


def _steady_mean(c: str) -> Column:
    """Mean whose last digit does not depend on the order of the rows; for a handful of values (one a model)."""
    values = F.array_sort(F.collect_list(F.col(c).cast("double")))
    return F.aggregate(values, F.lit(0.0), lambda total, x: total + x, lambda total: total / F.nullif(F.size(values), F.lit(0)))


def cut_rows(ranking: Ranking, k: int = FINAL_CONTACTS) -> DataFrame:
    """The last row inside the first min(k, n) of each group. Only rows inside the cut are sorted together; none is written."""
    last = ranking.first(k).groupBy(*ranking.group).agg(F.max(F.struct(RANK, ranking.score, *ranking.tie)).alias("_last"))
    return last.select(
        *ranking.group,
        F.col(f"_last.{ranking.score}").alias("_cut_score"),
        *[F.col(f"_last.{c}").alias(f"_cut_{c}") for c in ranking.tie],
        F.col(f"_last.{RANK}").cast("bigint").alias("_cut_rank"),
    )


def _with_cuts(df: DataFrame, ranking: Ranking, cuts: DataFrame) -> DataFrame:
    """``df`` with the columns of its group's cut, broadcast if the groups are few."""
    if not ranking.group:
        return with_scalars(df, cuts)
    cuts = materialise(cuts)
    return null_safe_join(df, F.broadcast(cuts) if cuts.count() <= BROADCAST_ROWS else cuts, ranking.group)


def _at_or_above_cut(ranking: Ranking) -> Column:
    """Lexicographic comparison with the cut row; NULL scores rank last."""
    ties = [F.struct(*[F.col(f"{prefix}{c}").alias(c) for c in ranking.tie]) for prefix in ("", "_cut_")]
    score, cut = F.col(ranking.score), F.col("_cut_score")
    return F.coalesce(score > cut, score.isNotNull() & cut.isNull()) | (score.eqNullSafe(cut) & (ties[0] <= ties[1]))


def topk_flag(ranking: Ranking, k: int = FINAL_CONTACTS, name: str = "predicted") -> DataFrame:
    """Every row with 1 for the first min(k, n) of its group, else 0. The frame itself is neither shuffled nor written."""
    if k <= 0:
        return ranking.source.withColumn(name, F.lit(0).cast("bigint"))
    marked = _with_cuts(ranking.source, ranking, cut_rows(ranking, k))
    flagged = marked.withColumn(name, F.when(_at_or_above_cut(ranking), 1).otherwise(0).cast("bigint"))
    return flagged.drop("_cut_score", "_cut_rank", *[f"_cut_{c}" for c in ranking.tie])


def cutoff_score(ranking: Ranking, k: int = FINAL_CONTACTS) -> DataFrame:
    """Per group: rows inside the cut, highest score, score of the last row inside."""
    inside = ranking.first(k).groupBy(*ranking.group)
    last = F.max(F.struct(RANK, ranking.score)).alias("_last")
    found = inside.agg(F.max(ranking.score).alias("score_max"), last)
    return found.select(
        *ranking.group, "score_max", F.col(f"_last.{RANK}").cast("bigint").alias("k"), F.col(f"_last.{ranking.score}").alias("score_cut")
    )


def score_ensemble_mean(
    df: DataFrame, *, score: str = "score", by: Sequence[str] = KEY, keep: Sequence[str] = ()
) -> DataFrame:
    """Mean score per row over all models, each model counting once.

    ``keep`` names columns that are equal in all of a row's models (the label). They join the grouping key,
    which leaves the groups as they are and the aggregation hash-based.
    """
    return df.groupBy(*by, *keep).agg(F.avg(score).alias("score"), F.count(F.lit(1)).alias("n_models"))


def mean_of_columns(columns: Sequence[str]) -> Column:
    """Ensemble mean of scores that sit side by side in one row: no shuffle at all."""
    total = reduce(lambda a, b: a + b, [F.col(c) for c in columns])
    return total / F.lit(float(len(columns)))


def threshold_profit(
    df: DataFrame,
    threshold: float = SCORE_THRESHOLD,
    *,
    score: str = "score",
    label: str = "label",
    group: Sequence[str] = ("model",),
) -> DataFrame:
    """Profit per group when every row scoring above the threshold is contacted."""
    predicted = F.when(F.col(score) > threshold, 1).otherwise(0)
    return df.groupBy(*group).agg(confusion_profit(hit_target(F.col(label)), predicted).alias("profit"))
