"""Model jobs on a small planted signal, staged runs, shape of the physical plans."""

import itertools
import json
import re

import pytest
from pyspark.sql import functions as F

from tidepanel.functions.features import binary_target, class_weight
from tidepanel.operators import curves
from tidepanel.plans import models, stages
from tidepanel.sources import tables
from tidepanel.sources.scratch import fresh_path

FEATURES = ["signal", "noise", "holes"]


@pytest.fixture(scope="module")
def panel(spark):
    """400 entities, 6 months; a low signal means churn."""
    u = lambda *c: F.pmod(F.xxhash64(*c), F.lit(1000)) / 1000
    base = spark.range(400).select("id", F.explode(F.array(*[F.lit(202000 + m) for m in range(1, 7)])).alias("period"))
    signal = u("id", "period", F.lit(1))
    label = F.when(signal < 0.15, "BAJA+2").when(signal < 0.2, "BAJA+1").otherwise("CONTINUA")
    out = base.select(
        "id",
        F.col("period").cast("bigint").alias("period"),
        signal.alias("signal"),
        u("id", "period", F.lit(2)).alias("noise"),
        F.when(u("id", F.lit(3)) > 0.4, u("id", "period", F.lit(3))).alias("holes"),
        label.alias("label"),
    )
    return out.withColumns({"y": binary_target(F.col("label")), "w": class_weight(F.col("label"), 1.0)})


def trials(spark, n=2):
    rows = [(i + 1, i, float(9 - i), 3.7, json.dumps({"maxDepth": 2 + i, "subsamplingRate": 0.8})) for i in range(n)]
    return spark.createDataFrame(rows, "rank bigint, trial bigint, value double, best_iter double, params string")


@pytest.fixture(scope="module")
def trained(spark, panel):
    folder = fresh_path(spark, "models")
    train = panel.where("period < 202005")
    scorers, metadata = models.train_seed_ensemble(train, FEATURES, trials(spark), [1, 2], folder)
    return folder, train, scorers, metadata


def test_signal_beats_canaries(panel):
    frame = panel.select("id", "period", *FEATURES, "y", "w")
    kept = [r["feature"] for r in models.canary_selection(frame, FEATURES, n=4, rounds=4).collect()]
    assert "signal" in kept and not any(f.startswith("canary") for f in kept)


def test_ensemble_metadata_and_reload(spark, trained):
    folder, train, scorers, metadata = trained
    rows = metadata.orderBy("top_rank", "seed").collect()
    assert [(r["top_rank"], r["seed"], r["best_iter"]) for r in rows] == [(1, 1, 3), (1, 2, 3), (2, 1, 3), (2, 2, 3)]
    again, more = models.train_seed_ensemble(
        train.limit(0), FEATURES, trials(spark), [1, 2], folder, metadata=metadata
    )
    assert more.count() == 4
    assert [s.model.getNumTrees for s in again] == [s.model.getNumTrees for s in scorers]
    assert [s.name for s in models.load_scorers(metadata, FEATURES, [2])] == ["top2_seed_1", "top2_seed_2"]
    with pytest.raises(ValueError):
        models.load_scorers(metadata, FEATURES, [7])
    gone = metadata.withColumn("model_path", F.when(F.col("seed") == 1, F.concat("model_path", F.lit("x"))).otherwise(F.col("model_path")))
    with pytest.raises(ValueError, match="top2_seed_1x"):
        models.load_scorers(gone, FEATURES, [2])
    with pytest.warns(UserWarning, match="top2_seed_1x"):
        assert [s.name for s in models.load_scorers(gone, FEATURES, [2], on_missing="skip")] == ["top2_seed_2"]


def test_an_unreadable_model_is_an_error(spark, panel):
    folder = fresh_path(spark, "broken")
    spark.range(1).write.parquet(f"{folder}/top1_seed_1")
    with pytest.raises(Exception):
        models.train_seed_ensemble(panel, FEATURES, trials(spark, 1), [1], folder)


def test_rounds_are_chosen_with_patience(panel, monkeypatch):
    assert models.best_round([5, 4, 4.5, 3, 3.5], 2) == 4  # a rise, then a new low
    assert models.best_round([5, 4, 4.5, 4.6, 3], 2) == 2
    assert models.best_round([1, 2, 3], 200) == 1 and models.best_round([3, 2, 1], 1) == 3


@pytest.fixture(scope="module")
def vectors(panel):
    frame = models.with_vector(panel.where("y is not null"), FEATURES, ["id", "period", "label", "y", "w"])
    return frame.where("period < 202004").cache(), frame.where("period >= 202004").cache()


def brute_profits(holdout, fits, half_width):
    """(round, plateau, peak, best) from MLlib's own probabilities of separate fits."""
    out = []
    for n, model in enumerate(fits, 1):
        rows = model.transform(holdout).select("id", "period", "label", "rawPrediction").collect()
        rows.sort(key=lambda r: (-r["rawPrediction"][1], r["id"], r["period"]))
        curve = list(itertools.accumulate(780000 if r["label"] == "BAJA+2" else -20000 for r in rows))
        peak = curve.index(max(curve))
        near = curve[max(0, peak - half_width) : peak + half_width]
        out.append((n, pytest.approx(sum(near) / len(near)), peak, max(curve)))
    return out


def test_profit_after_every_round_equals_separate_fits(vectors):
    train, holdout = vectors
    params = {"maxDepth": 3, "stepSize": 0.4, "subsamplingRate": 0.6, "featureShare": 0.7}
    fits = [models.classifier(params, n, 7).fit(train) for n in range(1, 7)]
    found = [tuple(r) for r in models.round_profits(holdout, fits[-1], half_width=15).orderBy("round").collect()]
    assert found == brute_profits(holdout, fits, 15)
    # Margins are MLlib's, and a cut model scores as the shorter fit does.
    short = {(r["id"], r["period"]): r["probability"][1] for r in fits[2].transform(holdout).collect()}
    cut = models.score_at_rounds(holdout, [(fits[-1], 3), (fits[-1], 3)], ["id", "period"]).collect()
    assert all(r["score"] == pytest.approx(short[r["id"], r["period"]], abs=1e-12) for r in cut) and len(cut) == len(short)
    later = models.staged_scores(holdout, fits[-1], ["id"], range(3, 5)).collect()
    assert {r["round"] for r in later} == {3, 4} and len(later) == 2 * len(short)


def test_patience_is_by_profit(vectors, monkeypatch):
    train, holdout = vectors
    params = {"maxDepth": 2, "stepSize": 0.5, "subsamplingRate": 0.7}
    profits = [p for *_, p in brute_profits(holdout, [models.classifier(params, n, 3).fit(train) for n in range(1, 9)], 500)]
    grown = []
    real = models.classifier
    monkeypatch.setattr(models, "classifier", lambda p, n, s: grown.append(n) or real(p, n, s))
    for patience in (1, 2, 8):
        grown.clear()
        model, best = models.fit_with_patience(train, holdout, params, 8, 3, patience)
        assert best == models.best_round([-p for p in profits], patience)
        assert grown == [n for n in (2 * patience, 4 * patience, 8 * patience) if n < 8 and n < 2 * (best + patience)] + [8] * (grown[-1] == 8)
        assert model.getNumTrees == grown[-1] >= best


def test_nan_is_missing(spark):
    df = spark.createDataFrame([(float("nan"),), (None,), (2.0,)], "x double")
    found = [r[models.VECTOR].toArray().tolist() for r in models.with_vector(df, ["x"], []).collect()]
    assert found == [[models.SENTINEL], [models.SENTINEL], [2.0]]


def test_same_seed_same_scores(spark, panel, trained):
    _, train, scorers, _ = trained
    again, _ = models.train_seed_ensemble(train.repartition(5), FEATURES, trials(spark, 1), [1], fresh_path(spark, "m"))
    month = panel.where("period = 202006").drop("label", "y", "w")

    def scores(s):
        return {r["id"]: r["score"] for r in models.score_models(month, [s]).collect()}

    assert scores(scorers[0]) == scores(models.load_scorers(trained[3], FEATURES, [1])[0])
    assert len(scores(again[0])) == 400


def test_scores_long_wide_and_mean(spark, panel, trained):
    scorers = trained[2]
    month = panel.where("period = 202006")
    long = models.score_models(month, scorers, keep=["id", "period", "label"])
    assert long.count() == 4 * 400
    by_row = {r["id"]: r["score"] for r in models.score_ensemble(month, scorers).collect()}
    grouped = {r["id"]: r["score"] for r in curves.score_ensemble_mean(long).collect()}
    assert all(by_row[k] == pytest.approx(grouped[k], abs=1e-12) for k in by_row)
    best = curves.max_gain(curves.ranked_profit(long.where("model = 'top1_seed_1'"))).first()
    assert best["gain_max"] > 0.5 * 780000 * month.where("label = 'BAJA+2'").count()


def test_missing_feature_modes(panel, trained):
    scorers = trained[2][:1]
    short = panel.drop("noise")
    with pytest.raises(ValueError):
        models.score_models(short, scorers)
    assert models.score_models(short, scorers, on_missing="zero").count() == 2400
    with_all, none = panel.limit(10), models.Scorer("other", scorers[0].model, ("absent",))
    assert models.score_models(with_all, [*scorers, none], on_missing="skip").count() == 10


def test_final_model(panel):
    scorer = models.train_final_model(panel, FEATURES, {"maxDepth": 2}, 3, 5)
    assert scorer.model.getNumTrees == 3


def test_search_resumes(spark, panel):
    path = fresh_path(spark, "trials")
    options = dict(
        seeds=[1], rounds=2, half_width=20, path=path, space={"maxDepth": ("int", 2, 3), "stepSize": ("log", 0.1, 0.3)}
    )
    train, valid = panel.where("period < 202005"), panel.where("period >= 202005")
    first = models.hyperparameter_trials(train, valid, FEATURES, n_trials=1, **options).collect()
    both = models.hyperparameter_trials(train, valid, FEATURES, n_trials=2, **options).orderBy("trial").collect()
    assert [r["trial"] for r in both] == [0, 1] and both[0] == first[0]
    assert first[0]["value"] > 0 and first[0]["gain_max"] >= first[0]["value"]
    files = len(spark.read.parquet(path).inputFiles())
    models.hyperparameter_trials(train, valid, FEATURES, n_trials=2, **options)
    assert len(spark.read.parquet(path).inputFiles()) == files


def test_sampled_parameters_stay_in_range():
    drawn = [models.sample_params(t, 1) for t in range(50)]
    assert all(2 <= p["maxDepth"] <= 7 and 0.009 <= p["stepSize"] <= 0.5 for p in drawn)
    assert models.sample_params(3, 1) == drawn[3] and len({p["stepSize"] for p in drawn}) == 50
    assert models.sample_params(0, 1, {"a": ("choice", ["x"])}) == {"a": "x"}


def test_build_features_shuffles_once(spark, panel):
    path = fresh_path(spark, "raw")
    raw = panel.select("id", "period", F.col("signal").alias("m_a"), F.col("noise").alias("n_b"), F.lit(3).alias("age"))
    tables.replace_table(raw, path)
    built = stages.build_features(
        spark.read.parquet(path),
        ["m_a", "n_b"],
        groups={"m": "m_", "n": "n_"},
        rest="other",
        tenure="age",
        quarterly_count="n_b",
        salary="m_a",
        age="age",
        bad_periods=[202003],
    )
    assert built.count() == 2000
    assert {"label", "q_m", "q_other", "month", "quarterly_scaled", "salary_over_age", "m_a_trend6"} <= set(built.columns)
    plan = built._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 1
    assert len(re.findall(r"\bSort \[", plan)) == 1
    assert "Join" not in plan


def test_topk_does_not_shuffle_the_scores(spark, panel):
    path = fresh_path(spark, "scores")
    tables.replace_table(panel.select("id", "period", F.col("signal").alias("score"), F.lit(1).alias("model")), path)
    flagged = curves.topk_flag(curves.rank(spark.read.parquet(path), "score", group=["model"], rows_per_bucket=200), 50)
    plan = flagged._jdf.queryExecution().executedPlan().toString()
    # The large side of the last join is the bare scan.
    assert re.search(r"BroadcastHashJoin.*\n\s+:- (\*\(\d+\) )?(Project|Filter|ColumnarToRow|FileScan)", plan)
    assert flagged.agg(F.sum("predicted")).first()[0] == 50


def test_gain_summary_and_scenarios(spark, panel):
    scores = panel.select(
        F.explode(F.array(F.lit("m1"), F.lit("m2"))).alias("model"), "id", "period", "label", (1 - F.col("signal")).alias("score")
    )
    summary = stages.gain_summary(scores, "exp", floor=10, ceiling=500).collect()
    assert sorted(r["model"] for r in summary) == ["ensemble", "m1", "m2"]
    assert len({(r["k_opt"], r["gain_max"]) for r in summary}) == 1
    tagged = scores.withColumn("experiment", F.when(F.col("model") == "m1", "e1").otherwise("e2"))
    plan = [stages.Scenario("s1", 202005, ("e1",)), stages.Scenario("s2", 202006, ("e1", "e2"))]
    out = stages.scenario_predictions(tagged, plan, 25, rows_per_bucket=100)
    counts = {r["scenario"]: (r["n"], r["p"]) for r in out.groupBy("scenario").agg(F.count("*").alias("n"), F.sum("predicted").alias("p")).collect()}
    assert counts == {"s1": (400, 25), "s2": (400, 25)}


def test_prediction_frame(spark, panel):
    path = fresh_path(spark, "features")
    wide = panel.select("id", "period", "signal", *[F.lit(i).alias(f"signal_lag{i}") for i in (1, 2, 3)], "label", "y", "w")
    tables.write_period_table(wide, path)
    out = stages.prediction_frame(spark, path, 202004, 2)
    assert sorted(out.columns) == ["id", "period", "signal", "signal_lag1", "signal_lag2"]
    assert out.count() == 400


def test_training_partitions_follow_from_the_rows(spark, panel, monkeypatch):
    """The same rows in the same places whatever the session's partitions, no partition much larger than asked for."""
    monkeypatch.setattr(models, "ROWS_PER_PART", 300)

    def dealt(df, parts):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        try:
            frame = models._training_rows(df, FEATURES, ["id", "period"])
            return [[tuple(r) for r in part] for part in frame.rdd.glom().collect()]
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "8")

    first = dealt(panel, "3")
    assert len(first) == 8 and max(map(len, first)) < 450 and sum(map(len, first)) == 2400
    assert dealt(panel.repartition(5, "noise"), "20") == first


def test_a_job_computes_its_frame_once(spark, monkeypatch):
    """Search, ensemble and check read what was written."""
    from catalog import job_queries

    built = []
    real = job_queries.snap
    monkeypatch.setattr(job_queries, "snap", lambda *args: built.append(args) or real(*args))
    row = [(0, 1.0, 2.0, 5, 3, 2, "{}")]
    monkeypatch.setattr(models, "hyperparameter_trials", lambda *args, **options: spark.createDataFrame(row, models.TRIALS_SCHEMA))
    monkeypatch.setattr(models, "train_seed_ensemble", lambda df, *args, **options: (built.append(df), None))
    monkeypatch.setattr(models, "score_models", lambda df, scorers, **options: df.select("id"))
    found = job_queries.ensemble_scores(spark, "/root/testdata/sf0.001")
    assert len(built) == 2  # the panel, and the rows the ensemble was given
    for df in (built[1], found):
        assert "FileScan" not in df._jdf.queryExecution().executedPlan().toString()
