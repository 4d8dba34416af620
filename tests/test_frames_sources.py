"""Column sets, casts, coercion, merges, sources and sinks."""

import pytest
from pyspark.sql import functions as F

from tidepanel.functions import casts, features, names
from tidepanel.operators import combine, drift, frames, profiling, sampling, selection, trials
from tidepanel.sources import csv, tables
from tidepanel.sources.scratch import fresh_path, materialise


def values(df, column):
    return [r[column] for r in df.collect()]


def test_depth_filter():
    columns = ["a", "a_lag1", "a_lag2", "a_lag12", "a_delta3", "a_lag_1", "b_delta_2", "x_lagged", "c_tend6"]
    assert names.within_depth(columns, 2) == ["a", "a_lag1", "a_lag2", "a_lag_1", "b_delta_2", "c_tend6"]


def test_name_groups_overlap():
    groups = names.groups_by_substring(
        ["id", "Master_x", "visa_y", "master_visa", "z"], {"m": "MASTER", "v": "visa"}, "rest", ["id"]
    )
    assert groups == {"m": ["Master_x", "master_visa"], "v": ["visa_y", "master_visa"], "rest": ["z"]}


def test_money_and_date_names():
    assert [names.is_money(c, "month") for c in ("mcash", "Visa_mlimit", "month", "cpay")] == [True, True, False, False]
    assert [names.is_date(c) for c in ("Visa_Finiciomora", "fecha_alta", "f_ini", "amount")] == [True, True, True, False]


def test_bad_numbers_become_null(spark):
    df = spark.createDataFrame([("12.5",), ("7d",), ("1f",), ("x",), ("",), (None,), (" 3 ",), ("1e2",)], "t string")
    assert values(df.select(casts.number(df, "t").alias("v")), "v") == [12.5, None, None, None, None, None, 3.0, 100.0]
    assert values(frames.cast_columns(df, {"t": "bigint"}), "t") == [None, None, None, None, None, None, 3, None]


def test_text_coercion(spark):
    rows = [(1, "S", "2021-03-04", "1,5", "k"), (2, "no", "never", "NULL", "k"), (3, " si ", None, "x", "k"), (4, "0", "", "2", "k")]
    df = spark.createDataFrame(rows, "id bigint, flag string, fecha string, amount string, label string")
    out = profiling.coerce_text(df).orderBy("id")
    assert values(out, "flag") == [1.0, 0.0, 1.0, 0.0]
    assert values(out, "fecha") == [18690.0, None, None, None]
    assert values(out, "amount") == [1.5, None, None, 2.0]
    assert values(out, "label") == ["k"] * 4


def test_yes_no_needs_more_than_four_fifths(spark):
    df = spark.createDataFrame([(i, "S" if i < 8 else "x") for i in range(10)], "id bigint, a string")
    assert profiling.yes_no_columns(df, ["a"]) == []
    assert profiling.yes_no_columns(df.where("id < 9"), ["a"]) == ["a"]
    # The first rows mislead: 200 words, then numbers.
    late = spark.range(1000).select("id", F.when(F.col("id") < 200, "S").otherwise(F.col("id").cast("string")).alias("a"))
    assert profiling.yes_no_columns(late, ["a"]) == []
    assert profiling.coerce_text(late).where("a is null").count() == 200
    assert profiling.yes_no_columns(spark.createDataFrame([("N0",)] * 9, "a string"), ["a"]) == []


def test_targets_without_label(spark):
    df = spark.createDataFrame([("BAJA+2",), ("BAJA+1",), ("CONTINUA",), (None,)], "label string")
    label = F.col("label")
    out = df.select(
        features.binary_target(label).alias("y"),
        features.class_weight(label).alias("w"),
        features.class_weight(label, 1.0).alias("w1"),
        features.hit_target(label).alias("y1"),
        features.not_staying_target(label).alias("y2"),
        features.contact_profit(label).alias("g"),
    ).collect()
    assert [tuple(r) for r in out] == [
        (1, 1.00002, 1.00002, 1, 1, 780000),
        (1, 1.00001, 1.00001, 0, 1, -20000),
        (0, 1.0, 1.0, 0, 0, -20000),
        (None, None, 1.0, 0, 1, -20000),
    ]


def test_ratio_tenure_momentum(spark):
    df = spark.createDataFrame([(10.0, 0.0, 1), (10.0, None, 2), (10.0, 4.0, 3), (10.0, 5.0, 4)], "a double, b double, t int")
    assert values(df.select(features.guarded_ratio(F.col("a"), F.col("b")).alias("r")), "r") == [None, None, 2.5, 2.0]
    scaled = df.select(features.tenure_scaled(F.col("a"), F.col("t")).alias("s"))
    assert values(scaled, "s") == [50.0, 20.0, 12.0, 10.0]
    deltas = spark.createDataFrame([(1, 2, 3), (1, None, 3)], "x_delta_1 int, x_delta_2 int, x_delta_3 int")
    assert values(drift.with_momentum(deltas, ["x"]), "x_momentum") == [10, None]


def test_missing_features(spark):
    df = spark.createDataFrame([(1.0, 2.0)], "a double, b double")
    assert frames.align_to_features(df, ["b", "c"], on_missing="zero").first().asDict() == {"b": 2.0, "c": 0.0}
    with pytest.raises(ValueError):
        frames.align_to_features(df, ["b", "c"])


def test_calendar(spark):
    df = spark.createDataFrame([(201911,), (202002,)], "period bigint")
    assert sorted(values(frames.period_calendar(df), "period")) == [201911, 201912, 202001, 202002]


def test_upsert_and_insert(spark):
    old = spark.createDataFrame([("a", 1, "t0"), ("b", 2, "t0")], "k string, v int, at string")
    new = spark.createDataFrame([("b", None, "-"), ("c", 4, "-")], "k string, v int, at string")
    merged = combine.upsert(old, new, ["k"], at=F.lit("t1"))
    assert sorted(map(tuple, merged.collect()), key=str) == [("a", 1, "t0"), ("b", None, "t1"), ("c", 4, "t1")]
    with pytest.raises(Exception, match="repeated key"):
        combine.upsert(old, new.unionAll(new), ["k"]).collect()
    added = combine.insert_if_absent(old, new, ["k"])
    assert sorted(map(tuple, added.collect())) == [("a", 1, "t0"), ("b", 2, "t0"), ("c", 4, "-")]


def test_keep_last(spark):
    df = spark.createDataFrame([("a", 1, 0), ("a", 2, 1), ("b", 3, 0), ("a", None, 2)], "k string, v int, o int")
    assert sorted(map(tuple, combine.keep_last(df, ["k"], ["o"]).collect())) == [("a", None, 2), ("b", 3, 0)]


def test_union_needs_all_columns(spark):
    first = spark.createDataFrame([(1, "2")], "a int, b string")
    with pytest.raises(Exception):
        combine.union_aligned(first, first.drop("b")).collect()


def test_unpivot_leaves_out_nulls(spark):
    df = spark.createDataFrame([(1, 2.0, None)], "k int, x_delta_1 double, y_delta_12 double")
    long = drift.long_means(df, ["x_delta_1", "y_delta_12"], ["k"])
    assert [tuple(r) for r in long.collect()] == [(1, "x", 1, 2.0)]


def test_zscore_of_a_constant_level(spark):
    df = spark.createDataFrame([("a", 1, 5.0), ("b", 1, 5.0), ("a", 2, 1.0), ("b", 2, 3.0)], "feature string, lvl bigint, value double")
    out = {(r["feature"], r["lvl"]): r["z_score"] for r in drift.zscore_by_level(df).collect()}
    assert out["a", 1] is None and out["a", 2] == pytest.approx(-(0.5**0.5))


def test_zscore_keeps_every_level(spark):
    rows = [("a", 6, 1.0), ("b", 6, 3.0), ("a", None, 1.0), ("b", None, 5.0)]
    out = drift.zscore_by_level(spark.createDataFrame(rows, "feature string, lvl bigint, value double")).collect()
    assert sorted(round(r["z_score"], 6) for r in out) == [-0.707107, -0.707107, 0.707107, 0.707107]


def test_undersampling_is_nested_and_keeps_churn(spark):
    label = F.when(F.col("id") % 10 == 0, "BAJA+1").when(F.col("id") % 10 == 1, None).otherwise("CONTINUA")
    df = spark.range(4000).select("id", label.alias("label"))
    kept = [set(values(sampling.hash_undersample(df, rate, 3), "id")) for rate in (0.0, 0.1, 0.5, 1.0)]
    churn = set(range(0, 4000, 10))
    assert all(churn <= k for k in kept)
    assert kept[0] <= kept[1] <= kept[2] <= kept[3]
    assert kept[3] == {i for i in range(4000) if i % 10 != 1}
    assert 0.4 < len(kept[2] - churn) / 3200 < 0.6
    assert set(values(sampling.hash_undersample(df, 0.5, 4), "id")) != kept[2]


def test_split_overlap_and_undersampled_train(spark):
    rows = [(1, 1, "CONTINUA"), (1, 2, "CONTINUA"), (2, 1, None), (2, 2, None), (3, 3, None)]
    df = spark.createDataFrame(rows, "id bigint, period bigint, label string")
    out = sampling.period_split(df, [1, 2], [2], [3], rate=1.0)
    assert sorted((r["split"], r["id"], r["period"]) for r in out.collect()) == [
        ("pred", 3, 3), ("test", 1, 2), ("test", 2, 2), ("train", 1, 1), ("train", 1, 2)
    ]
    counts = sampling.split_counts(out, ["train", "x"])
    assert values(counts, "is_empty") == [False, True, False] and sum(values(counts, "n")) == out.count()


def test_business_filter(spark):
    rows = [("BAJA+1", 201812), ("BAJA+1", 201901), ("CONTINUA", 201912), ("CONTINUA", 202001), (None, 202002), (None, 202107)]
    df = spark.createDataFrame(rows, "label string, period bigint")
    assert values(sampling.business_filter(df, [202107]), "period") == [201901, 202001, 202107]


def test_canary_cut(spark):
    rows = [("a", 5.0), ("canary_0", 3.0), ("b", 3.0), ("d", 3.0), ("canary_1", 1.0), ("c", 0.5)]
    df = spark.createDataFrame(rows, "feature string, gain double")
    assert sorted(values(selection.canary_cut(df), "feature")) == ["a", "b"]
    assert len(selection.canary_cut(df.where("feature not like 'canary%'")).collect()) == 4


def test_canaries_are_stable_and_in_range(spark):
    df = spark.range(500).select("id", F.lit(202001).alias("period"), (F.col("id") * 2 - 100).alias("v"))
    first = selection.add_canaries(df, 3).orderBy("id").collect()
    again = selection.add_canaries(df.repartition(7), 3).orderBy("id").collect()
    assert first == again
    assert all(-100 <= r["canary_0"] <= 898 for r in first)
    assert len({r["canary_0"] for r in first}) > 450


def test_trial_ranks(spark):
    df = spark.createDataFrame([(1, 5.0), (2, 9.0), (3, 5.0), (4, 1.0)], "trial bigint, value double")
    assert values(trials.top_trials(df, 3), "trial") == [2, 1, 3]
    assert values(trials.pick_trials(df, [3, 9]), "trial") == [3]
    models = spark.createDataFrame([("top1_seed_5",), ("top12_seed_5",), ("other",)], "model string")
    assert values(trials.pick_models(models, [12]), "model") == ["top12_seed_5"]
    assert trials.pick_models(models, []).count() == 3


def test_sampled_schema(spark):
    path = fresh_path(spark, "csv")
    rows = [(i, 202001, 5, i / 2, "x", i) for i in range(40)]
    df = spark.createDataFrame(rows, "id bigint, period bigint, mcash bigint, rate double, t string, Visa_mlimit bigint")
    csv.write_csv(df.coalesce(1), path)
    read = csv.read_csv_fitted(spark, path, types={"t": "string"})
    assert [f.dataType.simpleString() for f in read.schema] == ["bigint", "bigint", "double", "double", "string", "double"]
    assert read.agg(F.sum("mcash")).first()[0] == 200.0


def test_a_late_value_decides_the_type(spark):
    path = fresh_path(spark, "csv")
    rows = [(str(i) if i < 30 else "x", str(i) if i < 39 else "2.5") for i in range(40)]
    csv.write_csv(spark.createDataFrame(rows, "c string, n string").coalesce(1), path)
    read = csv.read_csv_fitted(spark, path)
    assert [f.dataType.simpleString() for f in read.schema] == ["string", "double"] and read.count() == 40
    with pytest.raises(Exception):
        csv.read_csv_fitted(spark, path, types={"c": "bigint"}).collect()


def test_gzip_files_are_dealt_out_whatever_the_folder_is_called(spark):
    path = fresh_path(spark, "plain")
    csv.write_csv(spark.range(10), path, compression="gzip")
    assert "REBALANCE" in csv.read_csv_inferred(spark, path)._jdf.queryExecution().executedPlan().toString()


def test_prediction_files(spark):
    assert csv.prediction_name("june", [1]) == "june_manual"
    path = fresh_path(spark, "p")
    csv.write_csv(spark.createDataFrame([(1, 1), (2, 0)], "id bigint, Predicted int"), path)
    assert {(r["id"], r["score"]) for r in csv.read_predictions(spark, path).collect()} == {(1, 1.0), (2, 0.0)}
    bad = fresh_path(spark, "p")
    csv.write_csv(spark.createDataFrame([("1", "0.5"), ("2", "high")], "id string, y_pred string"), bad)
    with pytest.raises(Exception):
        csv.read_predictions(spark, bad).collect()
    other = fresh_path(spark, "p")
    csv.write_csv(spark.createDataFrame([(1, 1)], "id bigint, s int"), other)
    with pytest.raises(ValueError):
        csv.read_predictions(spark, other)


def test_month_table_is_pruned_and_splits_a_large_month(spark):
    path = fresh_path(spark, "months")
    period = F.when(F.col("id") < 9000, 202001).otherwise(202002)
    df = spark.range(10_000).select("id", period.alias("period"), (F.col("id") % 7).alias("v"))
    tables.write_period_table(df, path, files=8)
    read = tables.read_periods(spark, path, [202002], columns=["id", "v", "period"])
    assert read.count() == 1000 and read.columns == ["id", "v", "period"]
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(period" in plan
    files = spark.read.parquet(path).where("period = 202001").select(F.input_file_name()).distinct().count()
    assert files > 3


def test_checkpoint_cuts_the_lineage(spark):
    df = materialise(spark.range(100).repartition(3).where("id % 2 = 0"))
    assert df.count() == 50
    assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()
