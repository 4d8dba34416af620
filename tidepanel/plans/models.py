"""Boosted-tree jobs: feature vectors, seed ensembles, scoring, canary selection, random search.

Fits are distributed by MLlib over a checkpointed frame; the driver only loops over parameter sets and seeds, a bounded number of
them at a time.
"""

from __future__ import annotations

import json
import math
import random
import re
import warnings
from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

import numpy as np
import pyarrow as pa
from pyspark import inheritable_thread_target
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepanel.constants import PLATEAU_HALF_WIDTH
from tidepanel.functions.names import numeric_columns
from tidepanel.operators.combine import insert_if_absent
from tidepanel.operators.curves import mean_of_columns, plateau_gain, ranked_profit
from tidepanel.operators.selection import add_canaries, canary_cut
from tidepanel.sources.scratch import materialise

VECTOR = "features"
# Trees need a number where the value is missing (NULL or NaN); they can split it off as they need.
SENTINEL = -1.0e30

# Few bins, as in the published settings; parameter names are those of MLlib.
FIXED = {"maxBins": 32, "checkpointInterval": 10}

# Rows of a training partition.
ROWS_PER_PART = 100_000

# Search space: kind, lower, upper.
SEARCH_SPACE = {
    "maxDepth": ("int", 2, 7),
    "stepSize": ("log", 0.009, 0.5),
    "minInstancesPerNode": ("int", 20, 1000),
    "featureShare": ("float", 0.05, 1.0),
    "subsamplingRate": ("float", 0.01, 1.0),
}

TRIALS_SCHEMA = (
    "trial bigint, value double, best_iter double, gain_max bigint, peak bigint, seeds bigint, params string"
)
MODELS_SCHEMA = (
    "top_rank bigint, trial bigint, value double, best_iter bigint, seed bigint, model_path string, params string"
)


def _dealt(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows in partitions of like size, by a hash of the key and in its order. Their number follows from the rows alone: a fit waits for its
    slowest task after every level, and subsampling draws by position, so a rerun with the same seed must meet the rows in the same places."""
    return df.repartition(max(1, math.ceil(df.count() / ROWS_PER_PART)), *keys).sortWithinPartitions(*keys)


def _training_rows(df: DataFrame, features: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """Vectors, target and weight as files: fits read them many times."""
    dealt = _dealt(df.select(*dict.fromkeys([*keys, *features, "y", "w"])), keys)
    return materialise(with_vector(dealt, features, ["y", "w"]))


def with_vector(df: DataFrame, features: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """``keep`` plus the feature vector: values with a sentinel for NULL and NaN."""
    values = [F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(None)), F.lit(SENTINEL)).alias(f"_v_{c}") for c in features]
    wide = df.select(*keep, *values)
    return VectorAssembler(inputCols=[f"_v_{c}" for c in features], outputCol=VECTOR).transform(wide).select(*keep, VECTOR)


def classifier(params: Mapping[str, object], rounds: int, seed: int, **extra) -> GBTClassifier:
    settings = {**FIXED, **{k: v for k, v in params.items() if k != "featureShare"}}
    if "featureShare" in params:
        settings["featureSubsetStrategy"] = str(params["featureShare"])
    return GBTClassifier(
        featuresCol=VECTOR,
        labelCol="y",
        weightCol="w",
        maxIter=rounds,
        seed=seed,
        **settings,
        **extra,
    )


def importances(model: GBTClassificationModel, features: Sequence[str], spark: SparkSession) -> DataFrame:
    """(feature, gain) of every feature."""
    rows = [(f, float(gain)) for f, gain in zip(features, model.featureImportances.toArray())]
    return spark.createDataFrame(rows, "feature string, gain double")


@dataclass(frozen=True)
class Scorer:
    """A saved model, the features it wants and the name of its scores."""

    name: str
    model: GBTClassificationModel
    features: tuple[str, ...]


def score_columns(
    df: DataFrame, scorers: Sequence[Scorer], *, keep: Sequence[str], on_missing: str = "raise"
) -> tuple[DataFrame, list[str]]:
    """All models' scores side by side: one pass over the frame, one column per model.

    A model whose features are not all there is an error, gets zeros or is left out (raise / zero / skip).
    """
    if on_missing == "skip":
        scorers = [s for s in scorers if set(s.features) <= set(df.columns)]
    missing = sorted({c for s in scorers for c in s.features} - set(df.columns))
    if missing and on_missing != "zero":
        raise ValueError(f"features not in the frame: {missing}")
    out = df.withColumns({c: F.lit(0.0) for c in missing}) if missing else df
    vectors = {features: f"_x{i}" for i, features in enumerate(dict.fromkeys(s.features for s in scorers))}
    for features, vector in vectors.items():
        out = with_vector(out, features, out.columns).withColumnRenamed(VECTOR, vector)
    for i, s in enumerate(scorers):
        out = _add_score(out, s.model, vectors[s.features], f"_s{i}")
    names = [f"_s{i}" for i in range(len(scorers))]
    return out.select(*keep, *names), names


def _add_score(df: DataFrame, model: GBTClassificationModel, vector: str, name: str) -> DataFrame:
    named = model.copy().setFeaturesCol(vector).setPredictionCol("")
    named = named.setRawPredictionCol(f"{name}_raw").setProbabilityCol(f"{name}_p")
    scored = named.transform(df).withColumn(name, vector_to_array(F.col(f"{name}_p"))[1])
    return scored.drop(f"{name}_raw", f"{name}_p")


def score_models(
    df: DataFrame, scorers: Sequence[Scorer], *, keep: Sequence[str] = ("id", "period"), on_missing: str = "raise"
) -> DataFrame:
    """Long scores (keep.., model, score)."""
    if on_missing == "skip":
        scorers = [s for s in scorers if set(s.features) <= set(df.columns)]
    wide, names = score_columns(df, scorers, keep=keep, on_missing=on_missing)
    pairs = [F.struct(F.lit(s.name).alias("model"), F.col(c).alias("score")) for s, c in zip(scorers, names)]
    return wide.select(*keep, F.inline(F.array(*pairs)))


def score_ensemble(
    df: DataFrame, scorers: Sequence[Scorer], *, keep: Sequence[str] = ("id", "period"), on_missing: str = "raise"
) -> DataFrame:
    """(keep.., score): the models' mean, computed within the row."""
    wide, names = score_columns(df, scorers, keep=keep, on_missing=on_missing)
    return wide.select(*keep, mean_of_columns(names).alias("score"))


def canary_selection(
    df: DataFrame,
    features: Sequence[str] | None = None,
    *,
    n: int = 20,
    seed: int = 42,
    rounds: int = 150,
    keys: Sequence[str] = ("id", "period"),
) -> DataFrame:
    """(feature, gain) of the features a boosted-tree fit ranks above every random probe column.

    ``df`` holds y (0/1) and w; rows without a target are not trained on.
    """
    known = df.where(F.col("y").isNotNull())
    features = list(features or numeric_columns(df, [*keys, "y", "w"]))
    # Written before the canaries are added, which need the columns' bounds first.
    rows = materialise(_dealt(known.select(*keys, *features, "y", "w"), keys))
    probed = add_canaries(rows, n, seed=seed, keys=keys, exclude=["y", "w"])
    inputs = [c for c in probed.columns if c not in (*keys, "y", "w")]
    frame = materialise(with_vector(probed, inputs, ["y", "w"]))
    params = {"stepSize": 0.05, "maxDepth": 5, "subsamplingRate": 0.8, "featureShare": 0.8}
    model = classifier(params, rounds, seed).fit(frame)
    return canary_cut(importances(model, inputs, df.sparkSession))


def _exists(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def _saved(spark: SparkSession, path: str) -> GBTClassificationModel | None:
    """The model under a path, None if nothing is there; what cannot be read is an error."""
    return GBTClassificationModel.load(path) if _exists(spark, path) else None


def _each(action: Callable, items: Iterable, parallelism: int) -> list:
    """Results of an action for all items, at most ``parallelism`` at a time."""
    with ThreadPool(processes=max(1, parallelism)) as pool:
        return pool.map(inheritable_thread_target(SparkSession.active())(action), list(items))


def train_seed_ensemble(
    df: DataFrame,
    features: Sequence[str],
    trials: DataFrame,
    seeds: Sequence[int],
    folder: str,
    *,
    metadata: DataFrame | None = None,
    keys: Sequence[str] = ("id", "period"),
    parallelism: int = 1,
) -> tuple[list[Scorer], DataFrame]:
    """One model per chosen trial and seed; returns the scorers and the metadata table.

    ``trials`` has rank, trial, value, best_iter and params (JSON), a handful of rows. A model that is already
    under ``folder`` is loaded instead of trained; one that cannot be read is an error. Metadata rows are added where their path is new.
    """
    spark = df.sparkSession
    known = df.where(F.col("y").isNotNull())
    wanted = [(t, seed, f"top{t['rank']}_seed_{seed}") for t in trials.orderBy("rank").collect() for seed in seeds]
    place = {name: f"{folder.rstrip('/')}/{name}" for *_, name in wanted}
    missing = any(not _exists(spark, path) for path in place.values())
    frame = _training_rows(known, features, keys) if missing else None

    def fitted(task) -> GBTClassificationModel:
        t, seed, name = task
        model = _saved(spark, place[name])
        if model is None:
            model = classifier(json.loads(t["params"]), _rounds(t), seed).fit(frame)
            model.write().save(place[name])
        return model

    scorers, rows = [], []
    for (t, seed, name), model in zip(wanted, _each(fitted, wanted, parallelism)):
        scorers.append(Scorer(name, model, tuple(features)))
        used = json.dumps({**FIXED, **json.loads(t["params"]), "seed": seed}, sort_keys=True)
        rows.append((t["rank"], t["trial"], float(t["value"]), _rounds(t), seed, place[name], used))
    fresh = spark.createDataFrame(rows, MODELS_SCHEMA)
    return scorers, fresh if metadata is None else insert_if_absent(metadata, fresh, ["model_path"])


def _rounds(trial) -> int:
    return max(1, int(trial["best_iter"]))


def train_final_model(
    df: DataFrame,
    features: Sequence[str],
    params: Mapping[str, object],
    best_iter: int,
    seed: int,
    *,
    keys: Sequence[str] = ("id", "period"),
) -> Scorer:
    """One model from known parameters and rounds, on every row with a target."""
    frame = _training_rows(df.where(F.col("y").isNotNull()), features, keys)
    settings = {**params, "minInstancesPerNode": 3}
    return Scorer(f"final_seed_{seed}", classifier(settings, best_iter, seed).fit(frame), tuple(features))


def load_scorers(
    metadata: DataFrame, features: Sequence[str], ranks: Sequence[int] = (), *, on_missing: str = "raise"
) -> list[Scorer]:
    """Models listed in a metadata table, all or those of the given ranks.

    One that is not there is an error, or (skip) left out with a warning that names it; one that cannot be read is an error.
    """
    spark, absent = metadata.sparkSession, []
    chosen = metadata.where(F.col("top_rank").isin(*ranks)) if ranks else metadata
    found = []
    for r in chosen.select("model_path").orderBy("model_path").collect():
        model = _saved(spark, r["model_path"])
        if model is None:
            absent.append(r["model_path"])
        else:
            found.append(Scorer(r["model_path"].rstrip("/").rsplit("/", 1)[-1], model, tuple(features)))
    if absent and on_missing != "skip":
        raise ValueError(f"models not found: {absent}")
    if absent:
        warnings.warn(f"models left out: {absent}", stacklevel=2)
    if not found:
        raise ValueError("no models" + (f" of ranks {list(ranks)}" if ranks else ""))
    return found


def sample_params(trial: int, seed: int, space: Mapping[str, tuple] = SEARCH_SPACE) -> dict[str, object]:
    """Parameters of a trial, fixed by its number and the seed, so a resumed search goes on as planned."""
    pick = random.Random(f"{seed}/{trial}")
    out: dict[str, object] = {}
    for name, spec in space.items():
        kind, args = spec[0], spec[1:]
        if kind == "int":
            out[name] = pick.randint(*args)
        elif kind == "float":
            out[name] = pick.uniform(*args)
        elif kind == "log":
            out[name] = math.exp(pick.uniform(math.log(args[0]), math.log(args[1])))
        elif kind == "choice":
            out[name] = pick.choice(list(args[0]))
        else:
            raise ValueError(f"unknown parameter kind {kind!r}")
    return out


def best_round(losses: Sequence[float], patience: int) -> int:
    """Number of rounds up to the lowest loss; the search for it ends after ``patience`` rounds without a lower one."""
    best = 0
    for i, loss in enumerate(losses):
        if loss < losses[best]:
            best = i
        elif i - best >= patience:
            break
    return best + 1


def _leaf_values(model: GBTClassificationModel) -> list[np.ndarray]:
    """What each leaf of each tree adds to the margin; leaves are numbered from left to right, the order in which trees are printed."""
    return [
        weight * np.array([float(v) for v in re.findall(r"Predict: (\S+)", tree.toDebugString)])
        for tree, weight in zip(model.trees, model.treeWeights)
    ]


def _with_leaves(df: DataFrame, model: GBTClassificationModel, name: str) -> DataFrame:
    """``df`` with the leaf of each tree that a row falls into."""
    named = model.copy().setFeaturesCol(VECTOR).setPredictionCol("").setRawPredictionCol("").setProbabilityCol("").setLeafCol(f"{name}_v")
    return named.transform(df).withColumn(name, vector_to_array(f"{name}_v").cast("array<int>")).drop(f"{name}_v")


def _margins(leaves: pa.ListArray, values: Sequence[np.ndarray], last: int) -> np.ndarray:
    """Running margin (rows x rounds) after each of the first ``last`` rounds."""
    at = leaves.flatten().to_numpy().reshape(len(leaves), -1)
    added = np.empty((len(leaves), last))
    for i in range(last):
        added[:, i] = values[i][at[:, i]]
    return np.cumsum(added, axis=1)


def staged_scores(df: DataFrame, model: GBTClassificationModel, keep: Sequence[str], rounds: range | None = None) -> DataFrame:
    """(keep.., round, score): every row's margin after each of the rounds (from 1; default all), in one pass over the trees.

    ``df`` has the feature vector. The margin orders rows as the probability does.
    """
    rounds = rounds or range(1, model.getNumTrees + 1)
    values, first, last = _leaf_values(model), rounds[0], rounds[-1]

    def stage(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                margins = _margins(part.column("_leaf"), values, last)[:, first - 1 :]
                rows = np.repeat(np.arange(part.num_rows), margins.shape[1])
                columns = [part.column(c).take(pa.array(rows)) for c in keep]
                numbers = np.tile(np.arange(first, last + 1), part.num_rows)
                yield pa.RecordBatch.from_arrays([*columns, pa.array(numbers), pa.array(margins.ravel())], [*keep, "round", "score"])

    schema = T.StructType([*[df.schema[c] for c in keep], T.StructField("round", T.LongType()), T.StructField("score", T.DoubleType())])
    return _with_leaves(df, model, "_leaf").select(*keep, "_leaf").mapInArrow(stage, schema)


def round_profits(
    holdout: DataFrame,
    model: GBTClassificationModel,
    *,
    half_width: int = PLATEAU_HALF_WIDTH,
    rounds: range | None = None,
    keys: Sequence[str] = ("id", "period"),
    label: str = "label",
) -> DataFrame:
    """(round, plateau_gain, peak, gain_max) of the model cut after each of its rounds.

    ``holdout`` has keys, label and feature vector. All rounds are ranked by one job: the round is the ranking's group.
    """
    staged = staged_scores(holdout, model, [*keys, label], rounds)
    return plateau_gain(ranked_profit(staged, label=label, group=["round"], tie=keys), half_width)


def fit_with_patience(
    train: DataFrame,
    holdout: DataFrame,
    params: Mapping[str, object],
    rounds: int,
    seed: int,
    patience: int,
    *,
    half_width: int = PLATEAU_HALF_WIDTH,
) -> tuple[GBTClassificationModel, int]:
    """A model, and the number of its rounds with the highest profit on the holdout.

    The search for that number ends after ``patience`` rounds without a higher profit. A fit starts with twice the patience and is
    doubled until that is so or all rounds are there; its first trees are those of a shorter fit with the same seed, so profits are read
    for new rounds only, and the work is at most about twice that of the rounds needed.
    """
    profits: list[int] = []
    n = min(rounds, max(2 * patience, 1))
    while True:
        model = classifier(params, n, seed).fit(train)
        found = round_profits(holdout, model, half_width=half_width, rounds=range(len(profits) + 1, n + 1))
        profits += [r["gain_max"] for r in found.orderBy("round").collect()]  # a row for each round
        best = best_round([-p for p in profits], patience)
        if n == rounds or len(profits) - best >= patience:
            return model, best
        n = min(rounds, 2 * n)


def score_at_rounds(df: DataFrame, models: Sequence[tuple[GBTClassificationModel, int]], keep: Sequence[str]) -> DataFrame:
    """(keep.., score): mean probability of models that are each cut after their number of rounds; one pass over the rows."""
    held = [(_leaf_values(model), last) for model, last in models]
    out = df
    for i, (model, _) in enumerate(models):
        out = _with_leaves(out, model, f"_leaf{i}")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                margins = [_margins(part.column(f"_leaf{i}"), values, last)[:, -1] for i, (values, last) in enumerate(held)]
                mean = np.mean([1 / (1 + np.exp(-2 * m)) for m in margins], axis=0)
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in keep], pa.array(mean)], [*keep, "score"])

    schema = T.StructType([*[df.schema[c] for c in keep], T.StructField("score", T.DoubleType())])
    return out.select(*keep, *[f"_leaf{i}" for i in range(len(models))]).mapInArrow(score, schema)


def hyperparameter_trials(
    train: DataFrame,
    validation: DataFrame,
    features: Sequence[str],
    *,
    n_trials: int,
    seeds: Sequence[int],
    rounds: int = 1000,
    patience: int = 200,
    parallelism: int = 1,
    seed: int = 0,
    half_width: int = PLATEAU_HALF_WIDTH,
    path: str | None = None,
    space: Mapping[str, tuple] = SEARCH_SPACE,
) -> DataFrame:
    """Random search: per trial a seed ensemble on the holdout, scored by the plateau gain.

    Each fit counts up to its most profitable round on the holdout, see ``fit_with_patience``.
    With ``path``, finished trials are appended there and a later call only runs those that are missing.
    """
    spark = train.sparkSession
    done = _read_trials(spark, path)
    seen = {r["trial"] for r in done.select("trial").collect()} if done is not None else set()
    missing = [t for t in range(n_trials) if t not in seen]
    if not missing:
        return done
    known = train.where(F.col("y").isNotNull())
    # Scoring needs every validation row, a fit only those with a target.
    fitted = _training_rows(known, features, ["id", "period"])
    held_out = materialise(with_vector(validation, features, ["id", "period", "label"]))

    rows = []
    for number in missing:
        params = sample_params(number, seed, space)
        models = _each(lambda s: fit_with_patience(fitted, held_out, params, rounds, s, patience, half_width=half_width), seeds, parallelism)
        # Written once: the curve reads it several times and would otherwise score again each time.
        ensemble = materialise(score_at_rounds(held_out, models, ["id", "period", "label"]))
        result = plateau_gain(ranked_profit(ensemble, group=()), half_width).first()
        best_iter = sum(n for _, n in models) / len(models)
        row = (
            number,
            float(result["plateau_gain"]) if result else None,
            best_iter,
            result["gain_max"] if result else None,
            result["peak"] if result else None,
            len(models),
            json.dumps(params, sort_keys=True),
        )
        rows.append(row)
        if path:
            spark.createDataFrame([row], TRIALS_SCHEMA).coalesce(1).write.mode("append").parquet(path)
    if path:
        return _read_trials(spark, path)
    return spark.createDataFrame(rows, TRIALS_SCHEMA)


def _read_trials(spark: SparkSession, path: str | None) -> DataFrame | None:
    if path is None or not _exists(spark, path):
        return None
    return spark.read.schema(TRIALS_SCHEMA).parquet(path)
