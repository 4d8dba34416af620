"""Whole runs over a month-partitioned feature table: choose features, train, predict.

Each run reads what the one before left in the workspace, and leaves its own results there. A run that was cut short can be started again:
finished trials and saved models are not repeated, and tables are merged by their keys.
"""

from __future__ import annotations

import warnings
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepanel.constants import CURVE_CEILING, CURVE_FLOOR, FINAL_CONTACTS, PLATEAU_HALF_WIDTH
from tidepanel.functions.names import numeric_columns, within_depth
from tidepanel.operators.curves import KEY, topk_flag
from tidepanel.operators.ranking import rank
from tidepanel.operators.sampling import period_split
from tidepanel.operators.trials import top_trials
from tidepanel.plans import models
from tidepanel.plans.stages import gain_summary, prediction_frame
from tidepanel.sources.csv import read_feature_list, write_feature_list, write_predictions
from tidepanel.sources.scratch import materialise
from tidepanel.sources.stored import insert_stored, path_exists, upsert_stored
from tidepanel.sources.tables import read_periods

METADATA_SCHEMA = f"experiment string, {models.MODELS_SCHEMA}"


@dataclass(frozen=True)
class Workspace:
    """Where the runs of one study keep their results."""

    folder: str

    def at(self, *names: str) -> str:
        return "/".join([self.folder.rstrip("/"), *names])

    @property
    def features(self) -> str:
        return self.at("features")

    @property
    def metadata(self) -> str:
        return self.at("models_metadata")

    @property
    def summary(self) -> str:
        return self.at("gain_summary")

    def trials(self, experiment: str) -> str:
        return self.at("trials", experiment)

    def models(self, experiment: str) -> str:
        return self.at("models", experiment)


def selection_run(
    spark: SparkSession,
    table: str,
    work: Workspace,
    periods: Sequence[int],
    *,
    depth: int = 2,
    rate: float = 0.1,
    seed: int = 42,
    canaries: int = 20,
    rounds: int = 150,
) -> DataFrame:
    """Months of the table, undersampled, through a fit with canaries; the features above them all are written, best first.

    Returns (feature, gain). If none is above them (a small sample, few rounds), there is no cut: all features are kept, without a gain, and a
    warning says so. Nothing is written over: a workspace that has a feature list keeps it and this is an error.
    """
    if path_exists(spark, work.features):
        raise ValueError(f"{work.features} is there already")
    frame = read_periods(spark, table, periods, columns=within_depth(spark.read.parquet(table).columns, depth))
    sampled = period_split(frame, periods, [], [], rate=rate, seed=seed).drop("split")
    features = numeric_columns(sampled, [*KEY, "y", "w"])
    kept = materialise(models.canary_selection(sampled.select(*KEY, *features, "y", "w"), features, n=canaries, seed=seed, rounds=rounds))
    if kept.isEmpty():
        warnings.warn(f"no feature ranks above the canaries, all {len(features)} are kept", stacklevel=2)
        kept = spark.createDataFrame([(f, None) for f in features], kept.schema)
    write_feature_list(kept.orderBy(F.desc("gain"), "feature").coalesce(1), work.features)
    return kept


def _listed(spark: SparkSession, work: Workspace) -> list[str]:
    """The chosen features: one name a line, at most as many as the table has columns."""
    return sorted(r["feature"] for r in read_feature_list(spark, work.features).collect())


def training_run(
    spark: SparkSession,
    table: str,
    work: Workspace,
    experiment: str,
    *,
    train: Sequence[int],
    validation: Sequence[int],
    test: Sequence[int],
    trials: int,
    seeds: Sequence[int],
    final_seeds: Sequence[int],
    top: int,
    rate: float | None = None,
    seed: int = 42,
    rounds: int = 1000,
    patience: int = 200,
    half_width: int = PLATEAU_HALF_WIDTH,
    floor: int = CURVE_FLOOR,
    ceiling: int = CURVE_CEILING,
    space: Mapping[str, tuple] = models.SEARCH_SPACE,
    parallelism: int = 1,
) -> DataFrame:
    """Search on train and validation months, an ensemble of the best trials on both, its gain curves on the test months.

    Returns the experiment's rows of the gain summary (a row per model and one for their mean); they and the models' metadata are merged
    into the workspace's tables.
    """
    features = _listed(spark, work)
    frame = read_periods(spark, table, sorted({*train, *validation, *test}), columns=[*KEY, "label", *features])
    split = period_split(frame, train, [*validation, *test], [], rate=rate, seed=seed)
    fitted, held = split.where("split = 'train'"), split.where("split = 'test'").where(F.col("period").isin(*validation))
    found = models.hyperparameter_trials(
        fitted,
        held,
        features,
        n_trials=trials,
        seeds=seeds,
        rounds=rounds,
        patience=patience,
        half_width=half_width,
        path=work.trials(experiment),
        space=space,
        parallelism=parallelism,
        seed=seed,
    )
    whole = fitted.unionByName(held)
    scorers, metadata = models.train_seed_ensemble(
        whole, features, top_trials(found, top), final_seeds, work.models(experiment), parallelism=parallelism
    )
    named = metadata.withColumn("experiment", F.lit(experiment)).select("experiment", *metadata.columns)
    insert_stored(named, work.metadata, ["experiment", "model_path"], partition="experiment")
    judged = read_periods(spark, table, test, columns=[*KEY, "label", *features])
    scores = materialise(models.score_models(judged, scorers, keep=[*KEY, "label"]))
    summary = gain_summary(scores, experiment, floor=floor, ceiling=ceiling)
    upsert_stored(summary, work.summary, ["experiment", "model"], partition="experiment")
    return summary


def prediction_run(
    spark: SparkSession,
    table: str,
    work: Workspace,
    name: str,
    *,
    period: int,
    experiments: Sequence[str],
    ranks: Sequence[int] = (),
    k: int = FINAL_CONTACTS,
    depth: int = 2,
) -> str:
    """The month's first k rows by the mean score of the experiments' models (all, or those of some ranks) as CSV; returns its path."""
    features = _listed(spark, work)
    stored = spark.read.schema(METADATA_SCHEMA).parquet(work.metadata)
    chosen = stored.where(F.col("experiment").isin(*experiments))
    scorers = models.load_scorers(chosen, features, ranks)
    frame = prediction_frame(spark, table, period, depth)
    scored = models.score_ensemble(frame, scorers)
    flagged = topk_flag(rank(materialise(scored), "score", tie=KEY), k)
    return write_predictions(flagged, work.at("predictions"), name, ranks=ranks)
