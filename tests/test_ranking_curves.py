"""Ranks, curves and cuts: few large buckets, many small ones and a plain window must agree."""

import re

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidepanel.operators import curves
from tidepanel.operators.ranking import rank
from tidepanel.sources.scratch import fresh_path


def make(spark, rows):
    return spark.createDataFrame(rows, "model bigint, id bigint, period bigint, label string, score double")


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of all rows share one score, one model is tiny, some scores are NULL, NaN or infinite."""
    n = F.col("n")
    score = (
        F.when(n % 3 == 0, 0.5)
        .when(n % 101 == 0, F.lit(None))
        .when(n % 211 == 0, F.lit(float("nan")))
        .when(n % 307 == 0, F.lit(float("-inf")))
        .when(n % 311 == 0, F.lit(float("inf")))
        .otherwise(F.pmod(F.xxhash64("n"), F.lit(4000)) / 4000)
    )
    label = F.when(n % 37 == 0, "BAJA+2").when(n % 41 == 0, None).otherwise("CONTINUA")
    frame = spark.range(20_000).withColumnRenamed("id", "n").select(
        F.when(n < 300, 1).otherwise(2 + n % 2).cast("bigint").alias("model"),
        F.floor(n / 4).cast("bigint").alias("id"),
        (202001 + n % 4).cast("bigint").alias("period"),
        label.alias("label"),
        score.cast("double").alias("score"),
    )
    return frame.persist()


def plain(df):
    w = Window.partitionBy("model").orderBy(F.desc_nulls_last("score"), "id", "period")
    gain = F.when(F.col("label").eqNullSafe("BAJA+2"), 780000).otherwise(-20000)
    ranked = df.select("*", gain.alias("gain")).select("*", F.row_number().over(w).alias("rk"), F.sum("gain").over(w).alias("cum"))
    return ranked.select("model", "id", "period", "rk", "cum")


@pytest.mark.parametrize("rows_per_bucket", [10**9, 1500, 40])
def test_two_level_sum_equals_one_window(skewed, rows_per_bucket):
    ranking = curves.ranked_profit(skewed, rows_per_bucket=rows_per_bucket)
    found = {(r["model"], r["rk"]): (r["id"], r["period"], r["cum"]) for r in curves.cumulative_gain(ranking).collect()}
    expected = {(r["model"], r["rk"]): (r["id"], r["period"], r["cum"]) for r in plain(skewed).collect()}
    assert found == expected


def test_heavy_ties_are_split(skewed):
    ranking = curves.ranked_profit(skewed, rows_per_bucket=500)
    largest = ranking.df.groupBy(*ranking.bucket_key).count().agg(F.max("count")).first()[0]
    assert largest < 1500


@pytest.mark.parametrize("common", ["0.5", "null", "'NaN'", "'-Infinity'", "'Infinity'", "1.7976931348623157E308"])
def test_any_frequent_score_and_a_frequent_id_are_split(spark, common):
    """Half of the rows share a score, and half of those one id; text ids leave only the score to split by."""
    n = F.col("n")
    rows = spark.range(12_000).withColumnRenamed("id", "n").select(
        F.lit(1).alias("model"),
        F.when(n % 4 == 0, 3000).otherwise(n).cast("bigint").alias("id"),
        n.cast("bigint").alias("period"),
        F.when(n % 50 == 0, "BAJA+2").alias("label"),
        F.when(n % 2 == 0, F.expr(f"cast({common} as double)")).otherwise(F.sin("n")).alias("score"),
    )
    ranking = curves.ranked_profit(rows, rows_per_bucket=300)
    largest = ranking.df.groupBy(*ranking.bucket_key).count().agg(F.max("count")).first()[0]
    assert largest < 900
    for frame in (rows, rows.withColumn("id", F.col("id").cast("string"))):
        found = curves.cumulative_gain(curves.ranked_profit(frame, rows_per_bucket=300))
        assert found.select("period", "rk", "cum").exceptAll(plain(frame).select("period", "rk", "cum")).count() == 0
        assert found.count() == 12_000


@pytest.mark.parametrize("kind", ["bigint", "decimal(20,2)", "float"])
def test_neighbouring_large_scores_keep_their_order(spark, kind):
    """Scores that share a double, or many equal ones of a type that has no exact double."""
    n = F.col("n")
    large = F.lit(2**53) + n % 3 if kind == "bigint" else n % 3
    rows = spark.range(6_000).withColumnRenamed("id", "n").select(
        F.lit(1).alias("model"),
        n.alias("id"),
        (n % 7).alias("period"),
        F.lit("CONTINUA").alias("label"),
        F.when(n % 5 > 0, large).cast(kind).alias("score"),
    )
    found = curves.cumulative_gain(curves.ranked_profit(rows, rows_per_bucket=100)).select("id", "rk", "cum")
    assert found.exceptAll(plain(rows).select("id", "rk", "cum")).count() == 0
    assert found.count() == 6_000


def test_minus_zero_ties_with_zero(spark):
    score = F.when(F.col("id") % 2 == 0, F.lit(0.0)).otherwise(F.lit(-0.0))
    rows = spark.range(3_000).select(
        F.lit(1).alias("model"), "id", F.lit(1).alias("period"), F.lit(None).cast("string").alias("label"), score.alias("score")
    )
    found = curves.cumulative_gain(curves.ranked_profit(rows, rows_per_bucket=100))
    assert [r["rk"] for r in found.orderBy("id").collect()] == list(range(1, 3_001))


def test_many_buckets_are_joined_by_shuffle(skewed, monkeypatch):
    monkeypatch.setattr("tidepanel.operators.ranking.BROADCAST_ROWS", 3)
    small = curves.ranked_profit(skewed, rows_per_bucket=200)
    large = curves.ranked_profit(skewed, rows_per_bucket=10**9)
    for f in (lambda r: curves.best_cut(r, 100, 1000), lambda r: curves.plateau_gain(r, 50)):
        assert sorted(map(repr, f(small).collect())) == sorted(map(repr, f(large).collect()))


def test_last_running_profit_is_the_total(skewed):
    ranking = curves.ranked_profit(skewed, rows_per_bucket=700)
    last = ranking.ranked().groupBy("model").agg(F.max_by("cum", "rk").alias("last"), F.sum("gain").alias("total"))
    assert all(r["last"] == r["total"] for r in last.collect())


def test_operators_agree_for_any_bucket_size(skewed):
    large = curves.ranked_profit(skewed, rows_per_bucket=10**9)
    small = curves.ranked_profit(skewed, rows_per_bucket=200)
    operators = [
        lambda r: curves.best_cut(r, 100, 1000),
        lambda r: curves.max_gain(r),
        lambda r: curves.plateau_gain(r, 50),
        lambda r: curves.gain_curve_segment(r, 150, 400).select("model", "id", "period", "k", "cum"),
        lambda r: curves.mean_gain_curve(r, 100, 300),
        lambda r: curves.mean_best_cut(r, 100, 300),
        lambda r: curves.cutoff_score(r, 250),
        lambda r: curves.topk_flag(r, 250).select("model", "id", "period", "predicted"),
    ]
    for f in operators:
        assert sorted(map(repr, f(large).collect())) == sorted(map(repr, f(small).collect()))


def test_flags_sum_to_k_or_all(skewed):
    sizes = {r["model"]: r["count"] for r in skewed.groupBy("model").count().collect()}
    ranking = curves.ranked_profit(skewed, rows_per_bucket=400)
    for k in (0, 1, 250, 5000, 10**6):
        flagged = curves.topk_flag(ranking, k).groupBy("model").agg(F.sum("predicted").alias("n"))
        assert {r["model"]: r["n"] for r in flagged.collect()} == {m: min(k, n) for m, n in sizes.items()}


def test_no_groups(skewed):
    one = skewed.where("model = 2").drop("model")
    few = curves.ranked_profit(one, group=(), rows_per_bucket=300)
    grouped = curves.ranked_profit(skewed.where("model = 2"), rows_per_bucket=10**9)
    assert curves.best_cut(few, 100, 900).first() == curves.best_cut(grouped, 100, 900).drop("model").first()
    assert curves.plateau_gain(few, 40).first() == curves.plateau_gain(grouped, 40).drop("model").first()
    assert curves.topk_flag(few, 77).agg(F.sum("predicted")).first()[0] == 77


def test_equal_scores_go_by_id(spark):
    rows = make(spark, [(1, 2, 202001, "BAJA+2", 0.5), (1, 1, 202001, "CONTINUA", 0.5)])
    found = curves.cumulative_gain(curves.ranked_profit(rows)).orderBy("rk").collect()
    assert [(r["id"], r["cum"]) for r in found] == [(1, -20000), (2, 760000)]


def test_cut_at_the_first_position_uses_its_own_score(spark):
    rows = make(spark, [(1, 1, 202001, "BAJA+2", 0.9), (1, 2, 202001, "CONTINUA", 0.8), (1, 3, 202001, None, 0.7)])
    cut = curves.best_cut(curves.ranked_profit(rows), 0, 3).first()
    assert (cut["k_opt"], cut["gain_max"], cut["thr_opt"]) == (0, 780000, 0.9)


def test_first_of_equal_maxima(spark):
    labels = ["CONTINUA"] * 39 + ["BAJA+2"] + ["CONTINUA"] * 39 + ["BAJA+2"]
    rows = make(spark, [(1, i, 202001, label, 1 - i / 100) for i, label in enumerate(labels)])
    ranking = curves.ranked_profit(rows)
    assert curves.max_gain(ranking).first()["k_max"] == 40
    cut = curves.best_cut(ranking, 10, 80).first()
    assert (cut["k_opt"], cut["thr_opt"]) == (39, pytest.approx(1 - 38 / 100))


def test_missing_label_costs_money(spark):
    rows = make(spark, [(1, 1, 202001, None, 0.9)])
    assert curves.max_gain(curves.ranked_profit(rows)).first()["gain_max"] == -20000


def test_unneeded_buckets_stay_out_of_the_window(skewed):
    ranking = curves.ranked_profit(skewed, rows_per_bucket=200)
    kept = ranking.offsets().where((F.col("_n_before") + F.col("_n") >= 101) & (F.col("_n_before") < 300)).count()
    assert 0 < kept < ranking.offsets().count() / 5


@pytest.mark.parametrize("hits", ["n % 7 = 0", "n < 6000", "n > 14000", "n % 2 = 0 and n < 9000", "false", "true"])
def test_peak_is_found_in_the_buckets_kept(spark, hits):
    """Score falls with n, so the hits decide where the curve peaks."""
    n = F.col("n")
    label = F.when(F.expr(hits) & (F.pmod(F.xxhash64("n"), F.lit(30)) == 0), "BAJA+2").otherwise("CONTINUA")
    rows = spark.range(15_000).withColumnRenamed("id", "n").select(
        F.lit(1).alias("model"), n.alias("id"), F.lit(202001).alias("period"), label.alias("label"), (-n).alias("score")
    )
    small, large = (curves.ranked_profit(rows, rows_per_bucket=size) for size in (200, 10**9))
    assert curves.max_gain(small).first() == curves.max_gain(large).first()
    assert curves.plateau_gain(small, 300).first() == curves.plateau_gain(large, 300).first()
    if hits == "n < 6000":
        assert small.holding_the_peak().count() < small.offsets().count() / 2


def test_ensemble_of_copies_is_the_model(spark):
    rows = make(spark, [(m, i, 202001, None, i / 7) for m in (1, 2, 3) for i in range(5)])
    mean = curves.score_ensemble_mean(rows, keep=["label"])
    assert {(r["id"], round(r["score"], 12)) for r in mean.collect()} == {(i, round(i / 7, 12)) for i in range(5)}


def test_rank_of_an_empty_frame(spark):
    assert curves.topk_flag(rank(make(spark, []), "score", group=["model"]), 5).count() == 0


@pytest.mark.parametrize("rows_per_bucket", [100, 10**9])
def test_a_missing_group_is_a_group(spark, rows_per_bucket):
    n = F.col("n")
    rows = spark.range(2_000).withColumnRenamed("id", "n").select(
        F.when(n % 2 == 0, "m").alias("model"),
        n.alias("id"),
        F.lit(1).alias("period"),
        F.when(n % 30 < 2, "BAJA+2").alias("label"),
        (n % 50).alias("score"),
    )
    ranking = curves.ranked_profit(rows, rows_per_bucket=rows_per_bucket)
    columns = ["model", "id", "period", "rk", "cum"]
    assert curves.cumulative_gain(ranking).select(columns).exceptAll(plain(rows).select(columns)).count() == 0
    assert curves.cumulative_gain(ranking).count() == 2_000
    flags = curves.topk_flag(ranking, 70).groupBy("model").agg(F.sum("predicted").alias("n"), F.count(F.lit(1)).alias("all"))
    assert sorted(map(tuple, flags.collect()), key=str) == [("m", 70, 1000), (None, 70, 1000)]
    for f in (curves.best_cut, curves.max_gain, curves.plateau_gain, curves.cutoff_score):
        found = f(ranking, 10, 500) if f is curves.best_cut else f(ranking)
        assert {r["model"] for r in found.collect()} == {"m", None}


@pytest.mark.parametrize("score", ["cast(7 as decimal(20,2))", "9007199254740993", "'same'"])
def test_one_shared_score_with_text_ids_is_split(spark, score):
    rows = spark.range(1_000).select(
        F.lit(1).alias("model"), F.concat(F.lit("id"), "id").alias("id"), F.lit(1).alias("period"),
        F.lit(None).cast("string").alias("label"), F.expr(score).alias("score"),
    )
    ranking = curves.ranked_profit(rows, rows_per_bucket=100)
    largest = ranking.df.groupBy(*ranking.bucket_key).count().agg(F.max("count")).first()[0]
    assert largest <= 200
    found = curves.cumulative_gain(ranking).orderBy("rk").collect()
    assert [r["id"] for r in found] == sorted(f"id{i}" for i in range(1_000)) and found[-1]["rk"] == 1_000


def stored_scores(spark, skewed):
    path = fresh_path(spark, "scores")
    skewed.repartition(6).write.parquet(path)
    return spark.read.parquet(path)


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


@pytest.mark.parametrize("group", [("model",), ()])
def test_top_k_is_limited_before_its_exchange_and_writes_nothing(spark, skewed, monkeypatch, group):
    scores = stored_scores(spark, skewed)
    monkeypatch.setattr("tidepanel.operators.ranking.fresh_path", lambda *a: pytest.fail("scores are written"))
    ranking = curves.ranked_profit(scores, group=group, tie=("id", "period"))
    cut = final_plan(ranking.first(2500))
    # Limits stand on both sides of the first exchange, and of the second one where there are groups; without, Spark takes the first of all parts.
    assert cut.count("WindowGroupLimit") == (4 if group else 2) and len(re.findall(r"\bExchange ", cut)) == (2 if group else 1)
    flagged = curves.topk_flag(ranking, 2500)
    assert flagged.count() == 20_000
    k = curves.cutoff_score(ranking, 2500).collect()
    assert {r["k"] for r in k} == ({300, 2500} if group else {2500})


def test_curves_exchange_the_rows_once(spark, skewed, monkeypatch):
    """The plan that deals the rows has one exchange; the one that ranks them has none but a broadcast of the buckets."""
    scores, plans = stored_scores(spark, skewed), []
    real = spark.range(1).write.__class__.parquet
    monkeypatch.setattr(spark.range(1).write.__class__, "parquet", lambda self, path, **k: plans.append(self._df._jdf.queryExecution().executedPlan().toString()) or real(self, path, **k))
    ranking = curves.ranked_profit(scores)
    curve = curves.cumulative_gain(ranking)
    dealt = [p for p in plans if "MapInArrow" in p]
    assert len(dealt) == 1 and len(re.findall(r"\bExchange ", dealt[0])) == 1 and "Window" not in dealt[0]
    ranked = final_plan(curve)
    assert "Window" not in ranked and not re.findall(r"\bExchange ", ranked) and "BroadcastExchange" in ranked


@pytest.mark.parametrize("rows_per_bucket", [None, 70])
def test_peaks_read_no_rows(spark, skewed, rows_per_bucket):
    """The largest prefix sum comes from the buckets' sums alone."""
    ranking = curves.ranked_profit(stored_scores(spark, skewed), rows_per_bucket=rows_per_bucket)
    best = plain(skewed).groupBy("model").agg(F.max(F.struct(F.col("cum"), -F.col("rk"))).alias("t"))
    expected = {(r["model"], -r["t"][1], r["t"][0]) for r in best.collect()}
    peaks = curves.max_gain(ranking)
    assert {tuple(r) for r in peaks.collect()} == expected
    assert "FileScan" not in final_plan(peaks)


@pytest.mark.parametrize("batch", ["1", "3", "10000"])
def test_groups_and_batches_meet_anywhere(spark, batch):
    """Groups of one to four rows, NULL and NaN groups, over Arrow batches of any size."""
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        n = F.col("n")
        group = F.when(n % 11 == 0, None).when(n % 13 == 0, float("nan")).otherwise(F.floor(n / 3) / 4)
        label = F.when(n % 5 == 0, "BAJA+2").otherwise("x")
        rows = spark.range(200).withColumnRenamed("id", "n").select(
            group.alias("model"), n.alias("id"), F.lit(1).alias("period"), label.alias("label"), (n * 7 % 10).alias("score")
        )
        found = curves.cumulative_gain(curves.ranked_profit(rows, rows_per_bucket=40)).select("id", "rk", "cum")
        assert sorted(found.collect()) == sorted(plain(rows).select("id", "rk", "cum").collect())
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
