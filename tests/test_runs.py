"""The three runs one after the other, each on what the one before left."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tidepanel.functions.features import binary_target
from tidepanel.plans import models, runs
from tidepanel.sources import tables
from tidepanel.sources.scratch import fresh_path

TRAIN, VALIDATION, TEST, LAST = [202001, 202002, 202003], [202004], [202005], 202006
SPACE = {"maxDepth": ("int", 2, 3), "stepSize": ("log", 0.1, 0.5)}
OPTIONS = dict(train=TRAIN, validation=VALIDATION, test=TEST, trials=2, seeds=[1], final_seeds=[1, 2], top=2, rate=0.6, rounds=4, patience=2, half_width=20, floor=5, ceiling=200, space=SPACE)


@pytest.fixture(scope="module")
def study(spark):
    """A feature table in which a low signal means churn, two features are noise, and one lag is too deep."""
    u = lambda *c: F.pmod(F.xxhash64(*c), F.lit(1000)) / 1000
    months = F.explode(F.array(*[F.lit(202000 + m).cast("bigint") for m in range(1, 7)])).alias("period")
    base = spark.range(300).select("id", months)
    signal = u("id", "period", F.lit(1))
    label = F.when(F.col("period") == LAST, None).when(signal < 0.15, "BAJA+2").when(signal < 0.2, "BAJA+1").otherwise("CONTINUA")
    noise = {f"noise{i}": u("id", "period", F.lit(10 + i)) for i in range(2)}
    out = base.withColumns({"signal": signal, **noise, "signal_lag1": u("id", F.lit(5)), "signal_lag9": signal, "label": label})
    path = fresh_path(spark, "feature_table")
    tables.write_period_table(out, path)
    return path, runs.Workspace(fresh_path(spark, "study"))


def test_select_train_and_predict(spark, study):
    table, work = study
    kept = runs.selection_run(spark, table, work, TRAIN, rate=0.5, canaries=3, rounds=4)
    chosen = [r["feature"] for r in kept.orderBy(F.desc("gain")).collect()]
    assert chosen[0] == "signal" and "signal_lag9" not in chosen and not any("canary" in c for c in chosen)
    assert [r["value"] for r in spark.read.text(work.features).collect()] == chosen
    with pytest.raises(ValueError, match="already"):
        runs.selection_run(spark, table, work, TRAIN)

    summary = {r["model"]: r for r in runs.training_run(spark, table, work, "e1", **OPTIONS).collect()}
    assert set(summary) == {"top1_seed_1", "top1_seed_2", "top2_seed_1", "top2_seed_2", "ensemble"}
    hits = spark.read.parquet(table).where(f"period = {TEST[0]}").agg(F.sum(binary_target(F.col("label")))).first()[0]
    assert summary["ensemble"]["gain_max"] > 0.5 * 760_000 * hits
    held = spark.read.schema(runs.METADATA_SCHEMA).parquet(work.metadata)
    assert held.count() == 4 and spark.read.parquet(work.trials("e1")).count() == 2

    # Months beyond the table's labels are never trained on; the prediction takes the first 25 of the last month.
    path = runs.prediction_run(spark, table, work, "run", period=LAST, experiments=["e1"], k=25)
    rows = spark.read.csv(path, header=True, inferSchema=True).collect()
    assert len(rows) == 300 and sum(r["Predicted"] for r in rows) == 25
    signal = {r["id"]: r["signal"] for r in spark.read.parquet(table).where(f"period = {LAST}").collect()}
    assert sum(signal[r["id"]] < 0.2 for r in rows if r["Predicted"]) >= 20
    some = runs.prediction_run(spark, table, work, "run", period=LAST, experiments=["e1"], ranks=[2], k=25)
    assert some.endswith("run_manual")


def test_no_feature_above_the_canaries_keeps_all(spark, study, monkeypatch):
    """The runs that follow need features to train on."""
    table, work = study[0], runs.Workspace(fresh_path(spark, "study"))
    found = [spark.createDataFrame([], "feature string, gain double")]
    monkeypatch.setattr(models, "canary_selection", lambda *args, **options: found[0])
    with pytest.warns(UserWarning, match="no feature ranks above"):
        kept = runs.selection_run(spark, table, work, TRAIN, rate=0.5, canaries=3, rounds=4)
    every = ["noise0", "noise1", "signal", "signal_lag1"]
    assert sorted(r["feature"] for r in kept.collect()) == every and runs._listed(spark, work) == every


def test_a_run_again_repeats_no_fit_and_changes_no_file(spark, study, monkeypatch):
    table, work = study
    if not Path(work.summary).exists():
        pytest.skip("needs the study's first run")
    files = lambda: {str(p): p.stat().st_mtime_ns for d in (work.summary, work.metadata, work.models("e1"), work.trials("e1")) for p in Path(d).rglob("*.parquet")}
    before = files()
    monkeypatch.setattr(models, "classifier", lambda *a, **k: pytest.fail("a model is fitted again"))
    runs.training_run(spark, table, work, "e1", **OPTIONS)
    assert files() == before
    monkeypatch.undo()
    runs.training_run(spark, table, work, "e2", **(OPTIONS | {"trials": 1, "top": 1, "final_seeds": [3]}))
    after = files()
    assert all(after.get(f) == t for f, t in before.items()) and len(after) > len(before)
    path = runs.prediction_run(spark, table, work, "both", period=LAST, experiments=["e1", "e2"], k=10)
    assert spark.read.csv(path, header=True, inferSchema=True).agg(F.sum("Predicted")).first()[0] == 10
