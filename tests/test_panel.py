"""The panel that the model jobs start from."""

import re
from datetime import datetime

from pyspark.sql import functions as F

from catalog import window_queries
from catalog.inputs import snap
from tidepanel.operators import history


def test_lines_are_exchanged_once(spark, tmp_path):
    """Two lines of an order in a month are one order; a line without a flag is neither returned nor open."""
    lines = [
        (1, 10, 2.0, 1.5, "R", "O", datetime(1995, 1, 31)),
        (1, 10, 3.0, 2.5, "N", "F", datetime(1995, 1, 1)),
        (2, 10, 1.0, 4.0, None, None, datetime(1995, 1, 2)),
        (1, 10, 1.0, 1.0, "R", "O", datetime(1995, 2, 1)),
        (1, 99, 1.0, 1.0, "R", "O", datetime(1995, 2, 1)),
    ]
    kinds = "l_orderkey bigint, l_suppkey bigint, l_quantity double, l_extendedprice double, l_returnflag string, l_linestatus string"
    spark.createDataFrame(lines, f"{kinds}, l_shipdate timestamp").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(10, 7)], "s_suppkey bigint, s_nationkey int").write.parquet(f"{tmp_path}/supplier.parquet")
    found = snap(spark, str(tmp_path))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 1
    rows = sorted(map(tuple, found.collect()))
    assert rows == [(10, 199501, 3, 2, 6, 800, 150, 1, 7), (10, 199502, 1, 1, 1, 100, 100, 1, 7)]


def test_wide_history_computes_its_columns_after_the_exchange(spark):
    """The exchange and the sort by entity carry the two measures the 77 columns are made of, not the columns."""
    found = window_queries.history_of_77_columns(spark, "/root/testdata/sf0.001")
    plan = found._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.index("AS c0#") < plan.index("Window") < plan.index("Exchange")


def test_derived_columns_give_the_features_of_stored_ones(spark):
    rows = [(i, 202101 + m, float(i * m) if m % 4 else None, i + m) for i in range(1, 9) for m in range(9)]
    panel = spark.createDataFrame(rows, "id bigint, period bigint, a double, b bigint")
    mixes = {"x": F.col("a") * 2 + F.col("b"), "y": F.col("b") - 1}
    stored = history.historical_features(panel.withColumns(mixes), ["x", "a", "y"])
    later = history.historical_features(panel, ["x", "a", "y"], derived=mixes)
    assert later.schema == stored.schema and sorted(map(repr, later.collect())) == sorted(map(repr, stored.collect()))
