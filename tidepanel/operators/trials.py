"""Trial tables: ranks, hand-picked ranks, summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def top_trials(trials: DataFrame, k: int, *, value: str = "value", trial: str = "trial") -> DataFrame:
    """The k best trials with their rank from 1. Only k rows reach the ranking window."""
    best = trials.orderBy(F.desc(value), trial).limit(k)
    return best.withColumn("rank", F.row_number().over(Window.orderBy(F.desc(value), trial)).cast("bigint"))


def pick_trials(
    trials: DataFrame, ranks: Sequence[int], *, value: str = "value", trial: str = "trial"
) -> DataFrame:
    """Trials of the given ranks; ranks beyond the table are ignored."""
    return top_trials(trials, max(ranks), value=value, trial=trial).where(F.col("rank").isin(*ranks))


def rank_of_model(name: str = "model"):
    """Rank written in a model's name (``top3_seed_7`` -> 3), NULL without one."""
    return F.regexp_extract(name, r"top(\d+)_", 1).try_cast("bigint")


def pick_models(models: DataFrame, ranks: Sequence[int], *, name: str = "model") -> DataFrame:
    """Rows whose model name carries one of the ranks; every row if none is given."""
    return models.where(rank_of_model(name).isin(*ranks)) if ranks else models


def trial_summary(
    runs: DataFrame,
    *,
    trial: str = "trial",
    best_iteration: str = "best_iter",
    plateau: str = "plateau_gain",
    gain: str = "gain_max",
    peak: str = "peak",
) -> DataFrame:
    """Per trial over its seeds: rounds for the final fit, plateau gain, max gain and where it peaks."""
    return runs.groupBy(trial).agg(
        F.avg(best_iteration).alias("mean_best_iter"),
        F.avg(best_iteration).cast("bigint").alias("rounds"),
        F.avg(plateau).alias("plateau_gain"),
        F.max(gain).alias("gain_max"),
        F.max_by(peak, F.struct(F.col(gain), -F.col(peak))).alias("peak"),
    )


def summary_ranked(summary: DataFrame, k: int | None = None, *, gain: str = "gain_max") -> DataFrame:
    """Summary rows by gain, best first, optionally the first k."""
    keys = [c for c in summary.columns if c != gain]
    ordered = summary.orderBy(F.desc(gain), *keys)
    return ordered if k is None else ordered.limit(k)


def distinct_periods(df: DataFrame, *, period: str = "period") -> DataFrame:
    """One row: the table's months in order as a title (", ") and as a name ("_")."""
    months = df.select(period).distinct().agg(F.array_sort(F.collect_list(period)).alias("months"))
    text = F.col("months").cast("array<string>")
    return months.select(F.array_join(text, ", ").alias("title"), F.array_join(text, "_").alias("name"))
