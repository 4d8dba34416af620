"""Labels and row windows on small inputs with known answers."""

import pytest
from pyspark.sql import functions as F

from tidepanel.operators import history, labels
from tidepanel.operators.labels import churn_label_gap, churn_label_rownum, with_gap_label


def panel(spark, rows):
    return spark.createDataFrame(rows, "id bigint, period bigint")


def by_key(df, column="label"):
    return {(r["id"], r["period"]): r[column] for r in df.collect()}


ANCHOR = [(99, m) for m in (202101, 202102, 202103, 202104, 202105, 202106)]


def test_leaves_for_good(spark):
    found = by_key(churn_label_gap(panel(spark, ANCHOR + [(1, 202101), (1, 202102), (1, 202103)])))
    assert [found[1, m] for m in (202101, 202102, 202103)] == ["CONTINUA", "BAJA+2", "BAJA+1"]


def test_gap_then_return(spark):
    found = by_key(churn_label_gap(panel(spark, ANCHOR + [(1, 202101), (1, 202103)])))
    assert found[1, 202101] == "BAJA+1"
    assert found[1, 202103] == "BAJA+1"


def test_open_outcome_has_no_label(spark):
    found = by_key(churn_label_gap(panel(spark, ANCHOR)))
    assert found[99, 202105] is None and found[99, 202106] is None
    assert found[99, 202104] == "CONTINUA"


def test_absent_in_last_month(spark):
    found = by_key(churn_label_gap(panel(spark, ANCHOR + [(1, 202104), (1, 202105)])))
    assert [found[1, m] for m in (202104, 202105)] == ["BAJA+2", "BAJA+1"]


def test_serial_crosses_the_year(spark):
    found = by_key(churn_label_gap(panel(spark, ANCHOR + [(1, 202011), (1, 202012), (1, 202101), (1, 202102)])))
    assert found[1, 202011] == "CONTINUA" and found[1, 202012] == "CONTINUA"


def test_label_on_the_panel_equals_joined_label(spark):
    rows = panel(spark, ANCHOR + [(1, 202101), (1, 202103), (2, 202102), (2, 202103), (2, 202104)])
    assert by_key(with_gap_label(rows)) == by_key(labels.join_labels(rows, churn_label_gap(rows)))


def test_labels_do_not_depend_on_partitions(spark):
    rows = panel(spark, ANCHOR + [(i, m) for i in range(1, 30) for m in (202101, 202102, 202104) if (i + m) % 3])
    before = by_key(churn_label_gap(rows))
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        assert by_key(churn_label_gap(rows.orderBy(F.rand(5)))) == before
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_rownum_labels(spark):
    found = by_key(churn_label_rownum(panel(spark, [(1, 202101), (1, 202102), (1, 202103), (2, 202108), (2, 202107)])))
    assert [found[1, m] for m in (202101, 202102, 202103)] == ["CONTINUA", "BAJA+2", "BAJA+1"]
    assert found[2, 202108] is None and found[2, 202107] is None


def values(spark, ys, id_=1):
    return spark.createDataFrame(
        [(id_, 202000 + i + 1, None if y is None else float(y)) for i, y in enumerate(ys)],
        "id bigint, period bigint, y double",
    )


def column(df, name):
    return [r[name] for r in df.orderBy("period").collect()]


def test_trend_skips_null_values_but_not_rows(spark):
    found = column(history.rolling(values(spark, [1, None, 5, 4]), ["y"], ["trend"]), "y_trend6")
    assert found[0] is None
    assert found[1] == pytest.approx(0.0)
    assert found[2] == pytest.approx(3.0)
    assert found[3] == pytest.approx(1.4222222)


def test_trend_equals_windowed_covariance(spark):
    ys = [3, None, 8, -2, 5, 5, None, 10, 0, 7, 1, None, None, None, None, None, None, 4]
    df = values(spark, ys)
    mine = column(history.rolling(df, ["y"], ["trend"]), "y_trend6")
    frame = history.by_entity().rowsBetween(-5, 0)
    indexed = history.with_row_index(df)
    ratio = F.covar_pop("y", "row_index").over(frame) / F.nullif(F.var_pop("row_index").over(frame), F.lit(0))
    for a, b in zip(mine, column(indexed.withColumn("t", ratio), "t")):
        assert (a is None) == (b is None) and (a is None or a == pytest.approx(b, abs=1e-9))


def test_all_null_column(spark):
    found = history.historical_features(values(spark, [None, None, None]), ["y"]).drop("id", "period")
    assert {v for r in found.collect() for v in r} == {None}


def test_single_row_entity(spark):
    row = history.historical_features(values(spark, [4]), ["y"]).first()
    assert (row["y_lag1"], row["y_delta1"], row["y_trend6"]) == (None, None, None)
    assert (row["y_avg6"], row["y_min6"], row["y_max6"], row["y_ratioavg6"]) == (4.0, 4.0, 4.0, 1.0)


def test_ratio_with_zero_denominator(spark):
    row = history.historical_features(values(spark, [0]), ["y"]).first()
    assert row["y_ratioavg6"] is None and row["y_ratiomax6"] is None


def test_rolling_bounds_and_width(spark):
    df = values(spark, [5, 1, None, 9, 2, 8, 7, 3, 3, 6])
    for r in history.historical_features(df, ["y"]).collect():
        assert r["y_min6"] <= r["y_avg6"] <= r["y_max6"]
    assert column(history.rolling(df, ["y"], ["max"], window=1), "y_max1") == column(df, "y")
    assert column(history.rolling(df, ["y"], ["mean"], window=2), "y_avg2")[:4] == [5.0, 3.0, 1.0, 9.0]


def test_lags_count_rows_not_months(spark):
    df = spark.createDataFrame([(1, 202101, 1), (1, 202105, 2), (1, 202106, 3)], "id bigint, period bigint, y bigint")
    assert column(history.lag_features(df, ["y"], 2), "y_lag2") == [None, None, 1]
    assert column(history.delta_features(df, ["y"], 1), "y_delta1") == [None, 1, 1]


def test_names_and_number_of_features(spark):
    df = values(spark, [1, 2]).withColumn("z", F.col("y"))
    out = history.historical_features(df, ["y", "z"])
    assert len(out.columns) == 4 + 2 * 10
    with pytest.raises(ValueError):
        history.rolling(df, ["y"], ["median"])


def test_blocks_of_rows_equal_windows(spark):
    """Features over the borders of small Arrow batches, with NULL, NaN, infinity and decimals, by one window that only numbers rows."""
    ys = [3.0, None, float("nan"), -2.0, 5.0, float("inf"), None, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 7.5, None, None, None, None, None, None, 4.0]
    rows = [(i, 202000 + k, None if y is None else y + i, None if y is None or k % 4 == 0 else k * i) for i in range(4) for k, y in enumerate(ys[i:])]
    df = spark.createDataFrame(rows, "id bigint, period bigint, y double, n bigint").withColumn("d", F.col("n").cast("decimal(10,2)") / 4)
    columns, names = ["y", "n", "d"], ["lag2", "delta1", "avg6", "min6", "max6", "ratioavg6", "ratiomax6"]
    along = history.by_entity()
    frame = along.rowsBetween(-5, 0)
    wanted = df
    for c in columns:
        x = F.col(c).cast("double")
        lags = [F.lag(x, k).over(along) for k in range(6)]
        mean, least, most = F.avg(x).over(frame), F.least(*lags), F.greatest(*lags)
        values = [lags[2], x - lags[1], mean, least, most, F.try_divide(x, mean), F.try_divide(x, most)]
        wanted = wanted.withColumns({f"{c}_{n}": v for n, v in zip(names, values)})
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        found = history.historical_features(df, columns)
        plan = found._jdf.queryExecution().executedPlan().toString()
        got = found.orderBy("id", "period").collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert "row_number()" in plan and "lag(" not in plan
    for a, b in zip(got, wanted.orderBy("id", "period").collect(), strict=True):
        for name in wanted.columns:
            assert (a[name] is None) == (b[name] is None), (name, a, b)
            assert a[name] is None or a[name] == pytest.approx(b[name], nan_ok=True), (name, a, b)


def test_history_of_nothing(spark):
    df = values(spark, [1, 2])
    assert history.historical_features(df.limit(0), ["y"]).count() == 0
    assert history.historical_features(df, []).columns == df.columns
