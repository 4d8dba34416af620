"""Tables on disk: entity buckets, months found at run time, merges in place, one month at a time."""

import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tidepanel.operators import history, labels
from tidepanel.sources import stored, tables
from tidepanel.sources.scratch import fresh_path


@pytest.fixture(scope="module")
def panel(spark):
    """300 entities over 14 months with gaps, short lives and missing values."""
    u = lambda *c: F.pmod(F.xxhash64(*c), F.lit(1000)) / 1000
    months = F.explode(F.array(*[F.lit(y * 100 + m).cast("bigint") for y, last in ((2020, 12), (2021, 2)) for m in range(1, last + 1)]))
    rows = spark.range(300).select("id", months.alias("period"))
    rows = rows.where((u("id", "period") > 0.2) & (F.col("period") <= 202003 + F.pmod("id", F.lit(7)) * 50))
    return rows.withColumns({"a": F.when(u("id", "period", F.lit(1)) > 0.1, u("id", "period", F.lit(2))), "b": F.pmod(F.xxhash64("id", "period"), F.lit(9))}).persist()


def plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def entity_table(spark, panel):
    path = fresh_path(spark, "entities")
    return tables.write_entity_table(panel, path.rsplit("/", 1)[-1].replace("-", "_"), path, buckets=8)


def test_windows_over_an_entity_table_need_no_exchange(spark, panel):
    table = entity_table(spark, panel)
    features = history.historical_features(table, ["a", "b"])
    assert "Exchange hashpartitioning" not in plan(features)
    assert "Exchange hashpartitioning" in plan(history.historical_features(panel.repartition(5), ["a", "b"]))
    assert features.exceptAll(history.historical_features(panel, ["a", "b"])).isEmpty()
    labelled = labels.churn_label_gap(table)
    assert "Exchange hashpartitioning" not in plan(labelled)


def test_label_join_over_an_entity_table_needs_no_exchange(spark, panel):
    settings = {"spark.sql.requireAllClusterKeysForCoPartition": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        table = entity_table(spark, panel)
        joined = labels.join_labels(table, labels.churn_label_gap(table))
        found = plan(joined)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert "SortMergeJoin" in found and "Exchange hashpartitioning" not in found
    assert joined.exceptAll(labels.with_gap_label(panel)).isEmpty() and joined.count() == panel.count()


def test_months_of_a_table_prune_folders(spark, panel):
    path = fresh_path(spark, "months")
    tables.write_period_table(panel, path)
    calendar = spark.createDataFrame([(202003, "x"), (202011, "x"), (202012, "y"), (209901, "x"), (None, "x")], "period bigint, scenario string")
    found = tables.read_periods(spark, path, calendar.where("scenario = 'x'"), columns=["id", "period", "a"])
    text = plan(found)
    assert "dynamicpruning" in text
    assert sorted(r["period"] for r in found.select("period").distinct().collect()) == [202003, 202011]
    expected = tables.read_periods(spark, path, [202003, 202011], columns=["id", "period", "a"])
    assert found.exceptAll(expected).isEmpty() and found.count() == expected.count()
    # Files of other months are not opened.
    opened = [m for m in _metrics(found._jdf.queryExecution().executedPlan(), "numPartitions")]
    assert opened == [2]


def _metrics(node, name):
    """Values of a metric over the nodes of an executed plan."""
    if "AdaptiveSparkPlan" in node.nodeName():
        node = node.executedPlan()
    if "QueryStage" in node.nodeName():
        node = node.plan()
    found = node.metrics().get(name)
    out = [found.get().value()] if found.isDefined() and "Scan parquet" in node.nodeName() else []
    for i in range(node.children().size()):
        out += _metrics(node.children().apply(i), name)
    return out


KEYS = ["experiment", "model"]


def rows(spark, *values):
    return spark.createDataFrame(values, "experiment string, model string, gain bigint, note string")


def files(path):
    return {str(p.relative_to(path)): p.stat().st_mtime_ns for p in Path(path).rglob("*.parquet")}


def held(df, path):
    return sorted(map(tuple, stored.read_stored(df, path).collect()))


def test_merges_touch_only_their_experiments(spark):
    path = fresh_path(spark, "summary")
    first = rows(spark, ("e1", "m1", 1, None), ("e1", "m2", 2, "x"), ("e2", "m1", 3, None), ("e/3", "m1", 4, "y"))
    stored.upsert_stored(first, path, KEYS, partition="experiment")
    before = files(path)
    new = rows(spark, ("e1", "m2", 20, None), ("e1", "m3", 30, "z"), ("e4", "m1", 40, None))
    stored.upsert_stored(new, path, KEYS, partition="experiment")
    assert held(first, path) == [("e/3", "m1", 4, "y"), ("e1", "m1", 1, None), ("e1", "m2", 20, None), ("e1", "m3", 30, "z"), ("e2", "m1", 3, None), ("e4", "m1", 40, None)]
    after = files(path)
    untouched = {f for f in before if "experiment=e1" not in f}
    assert len(untouched) >= 2 and all(after.get(f) == before[f] for f in untouched)
    assert not any(f in after for f in before if "experiment=e1" in f)
    # Again: nothing is written. A merge with one changed row writes its experiment.
    stored.upsert_stored(new, path, KEYS, partition="experiment")
    assert files(path) == after
    stored.upsert_stored(new.withColumn("gain", F.when(F.col("experiment") == "e4", 41).otherwise(F.col("gain"))), path, KEYS, partition="experiment")
    last = files(path)
    assert {f for f in last if f not in after} == {f for f in last if "experiment=e4" in f} and ("e4", "m1", 41, None) in held(first, path)


def test_insert_leaves_what_is_there(spark):
    path = fresh_path(spark, "models")
    first = rows(spark, ("e1", "m1", 1, None), ("e2", "m1", 2, None))
    stored.insert_stored(first, path, KEYS, partition="experiment")
    before = files(path)
    stored.insert_stored(first.withColumn("gain", F.lit(9).cast("bigint")), path, KEYS, partition="experiment")
    assert files(path) == before and held(first, path) == [("e1", "m1", 1, None), ("e2", "m1", 2, None)]
    stored.insert_stored(rows(spark, ("e2", "m1", 7, None), ("e2", "m9", 8, None)), path, KEYS, partition="experiment")
    assert held(first, path) == [("e1", "m1", 1, None), ("e2", "m1", 2, None), ("e2", "m9", 8, None)]
    stored.insert_stored(first.limit(0), path, KEYS, partition="experiment")
    assert len(held(first, path)) == 3


def test_a_refused_merge_changes_nothing(spark):
    path = fresh_path(spark, "refused")
    first = rows(spark, ("e1", "m1", 1, None))
    stored.upsert_stored(first, path, KEYS, partition="experiment")
    before = files(path)
    with pytest.raises(Exception, match="repeated key"):
        stored.upsert_stored(rows(spark, ("e1", "m1", 2, None), ("e1", "m1", 3, None)), path, KEYS, partition="experiment")
    with pytest.raises(ValueError, match="one of the keys"):
        stored.insert_stored(first, path, ["model"], partition="experiment")
    assert files(path) == before and held(first, path) == [("e1", "m1", 1, None)]


def _months(panel):
    return sorted(r["period"] for r in panel.select("period").distinct().collect())


@pytest.mark.parametrize("options", [{}, {"lags": [1, 8], "window": 3}, {"statistics": [], "lags": 1}])
def test_features_month_by_month_equal_the_batch(panel, options):
    batch = history.historical_features(panel, ["a", "b"], **options).persist()
    state, cut = None, 202009
    # The first months as a batch, or all of them one by one.
    if options:
        state = history.history_state(panel.where(F.col("period") <= cut), ["a", "b"], **options).checkpoint()
    for m in [m for m in _months(panel) if not options or m > cut]:
        found, state = history.history_step(state, panel.where(F.col("period") == m), ["a", "b"], **options)
        state = state.checkpoint()
        expected = batch.where(F.col("period") == m)
        assert found.columns == expected.columns
        assert _same(found, expected)
    assert state.groupBy("id").count().agg(F.max("count")).first()[0] <= 8


def _same(found, expected):
    key = lambda rows: sorted(map(repr, rows))
    a, b = ([tuple(round(v, 9) + 0.0 if isinstance(v, float) else v for v in r) for r in df.collect()] for df in (found, expected))
    return key(a) == key(b)


@pytest.mark.parametrize("skipped", [[], [202007], [202007, 202008, 202101]])
def test_labels_month_by_month_equal_the_batch(spark, panel, skipped):
    rows_ = panel.where(~F.col("period").isin(*skipped)) if skipped else panel
    expected = {(r["id"], r["period"]): r["label"] for r in labels.churn_label_gap(rows_).collect()}
    still, found = None, {}
    for m in _months(rows_):
        settled, still = labels.label_step(still, rows_.where(F.col("period") == m))
        still = still.checkpoint()
        for r in settled.collect():
            assert (r["id"], r["period"]) not in found
            found[r["id"], r["period"]] = r["label"]
        assert still.select("period").distinct().count() <= 2
    found |= {(r["id"], r["period"]): None for r in still.collect()}
    assert found == expected


def test_a_month_is_planned_on_the_state_alone(spark, panel):
    path = fresh_path(spark, "state")
    history.history_state(panel, ["a"]).write.parquet(path)
    month = panel.where("period = 202102")
    features, _ = history.history_step(spark.read.parquet(path), month, ["a"])
    assert len(re.findall(r"FileScan parquet", plan(features))) == 1


def test_a_large_partition_is_written_by_several_tasks(spark):
    path = fresh_path(spark, "summary")
    many = spark.range(4000).selectExpr("'e1' as experiment", "concat('m', id) as model", "id as gain", "'x' as note")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        stored.insert_stored(many, path, KEYS, partition="experiment")
        assert len(files(path)) == 8
        stored.insert_stored(many.withColumn("model", F.concat("model", F.lit("b"))), path, KEYS, partition="experiment")
        assert len(files(path)) == 8 and len(held(many, path)) == 8000
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_rows_with_a_null_key_are_inserted_once(spark):
    path = fresh_path(spark, "summary")
    first = rows(spark, ("e1", None, 1, None), ("e1", "m2", 2, "x"))
    stored.insert_stored(first, path, KEYS, partition="experiment")
    before = files(path)
    stored.insert_stored(first, path, KEYS, partition="experiment")
    assert files(path) == before
    stored.insert_stored(rows(spark, ("e1", None, 1, None), ("e1", "m2", 9, "y"), ("e1", "m3", 3, None)), path, KEYS, partition="experiment")
    found = stored.read_stored(first, path).collect()
    assert sorted(str(tuple(r)) for r in found) == ["('e1', 'm2', 2, 'x')", "('e1', 'm3', 3, None)", "('e1', None, 1, None)"]
