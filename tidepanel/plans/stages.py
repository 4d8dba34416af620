"""The staged runs: build the panel, evaluate models, predict scenarios."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepanel.constants import BAD_PERIODS, CURVE_CEILING, CURVE_FLOOR, FINAL_CONTACTS
from tidepanel.functions.features import guarded_ratio, tenure_scaled
from tidepanel.functions.names import within_depth
from tidepanel.functions.periods import month_of_year
from tidepanel.operators.curves import (
    KEY,
    best_cut,
    ranked_profit,
    score_ensemble_mean,
    topk_flag,
)
from tidepanel.operators.frames import drop_targets, exclude_periods, product_counts
from tidepanel.operators.history import historical_features
from tidepanel.operators.labels import with_gap_label
from tidepanel.operators.ranking import rank
from tidepanel.sources.scratch import materialise
from tidepanel.sources.tables import read_periods


def build_features(
    panel: DataFrame,
    columns: Sequence[str],
    *,
    groups: Mapping[str, str],
    rest: str,
    tenure: str | None = None,
    quarterly_count: str | None = None,
    salary: str | None = None,
    age: str | None = None,
    bad_periods: Sequence[int] = BAD_PERIODS,
    window: int = 6,
    lags: int = 2,
) -> DataFrame:
    """Raw panel to labelled historical features: one exchange on the id serves the label and the windows.

    Labels look at all months; the bad months are dropped before the row windows.
    """
    labelled = with_gap_label(panel)
    counted = product_counts(labelled, groups, rest, ["id", "period", "label"])
    kept = exclude_periods(counted, bad_periods)
    added = {"month": month_of_year(F.col("period"))}
    if tenure and quarterly_count:
        added["quarterly_scaled"] = tenure_scaled(F.col(quarterly_count), F.col(tenure))
    if salary and age:
        added["salary_over_age"] = guarded_ratio(F.col(salary), F.col(age))
    return historical_features(kept.withColumns(added), columns, window=window, lags=lags)


def prediction_frame(spark: SparkSession, path: str, period: int, depth: int) -> DataFrame:
    """One month of a feature table with lags and deltas up to ``depth``, targets dropped."""
    columns = within_depth(spark.read.parquet(path).columns, depth)
    return drop_targets(read_periods(spark, path, [period], columns=columns))


def gain_summary(
    scores: DataFrame,
    experiment: str,
    *,
    floor: int = CURVE_FLOOR,
    ceiling: int = CURVE_CEILING,
    ensemble_name: str = "ensemble",
) -> DataFrame:
    """(experiment, model, k_opt, gain_max, thr_opt) per model and for the mean of all models."""
    single = best_cut(ranked_profit(scores), floor, ceiling)
    # Written once: ranking reads its input more than once.
    together = materialise(score_ensemble_mean(scores, keep=["label"]))
    mean = best_cut(ranked_profit(together, group=()), floor, ceiling)
    named = mean.select(F.lit(ensemble_name).alias("model"), *mean.columns)
    rows = single.withColumn("model", F.col("model").cast("string")).unionByName(named)
    return rows.select(F.lit(experiment).alias("experiment"), *rows.columns)


@dataclass(frozen=True)
class Scenario:
    """A prediction run: which month, with the models of which experiments."""

    name: str
    period: int
    experiments: tuple[str, ...]


def scenario_predictions(
    scores: DataFrame,
    scenarios: Iterable[Scenario],
    k: int = FINAL_CONTACTS,
    *,
    rows_per_bucket: int | None = None,
) -> DataFrame:
    """(scenario, id, period, score, predicted) for all scenarios in one job.

    ``scores`` is long: experiment, model, id, period, score. An experiment listed twice counts twice.
    """
    wanted = [(s.name, s.period, e) for s in scenarios for e in s.experiments]
    plan = scores.sparkSession.createDataFrame(wanted, "scenario string, period bigint, experiment string")
    chosen = scores.join(plan, ["period", "experiment"])
    mean = materialise(score_ensemble_mean(chosen, by=["scenario", *KEY]))
    options = {"rows_per_bucket": rows_per_bucket} if rows_per_bucket else {}
    ranking = rank(mean, "score", group=["scenario"], tie=KEY, **options)
    return topk_flag(ranking, k).select("scenario", *KEY, "score", "predicted")
