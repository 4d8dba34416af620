"""Scans and sinks: every query writes to a fresh path and returns what it reads back."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalog.inputs import SNAP_COLUMNS, TOP, ensemble, importances, snap, sql
from catalog.registry import query
from tidepanel.operators.curves import topk_flag
from tidepanel.operators.ranking import rank
from tidepanel.operators.selection import canary_cut, importance_mean
from tidepanel.sources import csv, tables
from tidepanel.sources.scratch import fresh_path

MONTHS = (199605, 199812, 200003)
_MONTHS = "(199605, 199812, 200003)"
_ALL = ", ".join(SNAP_COLUMNS)
_TOP = f"SELECT id, CASE WHEN rk <= {TOP} THEN 1 ELSE 0 END AS flag FROM ranked_mean"


@query(sql("snap", body=f"SELECT {_ALL}, '{', '.join(['whole'] * len(SNAP_COLUMNS))}' AS kinds FROM snap"))
def csv_scan_inferred(spark, d):
    path = fresh_path(spark, "snap") + ".csv.gz"
    csv.write_csv(snap(spark, d), path, compression="gzip")
    read = csv.read_csv_inferred(spark, path)
    kinds = ["whole" if isinstance(f.dataType, T.IntegralType) else f.dataType.simpleString() for f in read.schema]
    return read.select(*[F.col(c).cast("bigint").alias(c) for c in read.columns], F.lit(", ".join(kinds)).alias("kinds"))


@query(
    sql(
        "snap",
        body="SELECT id, period, n_lines, n_orders, q_units, CAST(m_price AS double) AS m_price, "
        "CAST(m_returned AS double) AS m_returned, n_open, s_nationkey FROM snap",
    )
)
def csv_scan_sampled_schema(spark, d):
    path = fresh_path(spark, "snap")
    csv.write_csv(snap(spark, d), path)
    return csv.read_csv_fitted(spark, path)


@query(sql("snap", body=f"SELECT {_ALL} FROM snap"))
def table_replace_load(spark, d):
    path = fresh_path(spark, "snap")
    tables.replace_table(snap(spark, d).select("id", "period"), path)
    tables.replace_table(snap(spark, d), path)
    return spark.read.parquet(path)


@query(sql("snap", body=f"SELECT {_ALL} FROM snap"))
def table_write_partitioned(spark, d):
    path = fresh_path(spark, "snap")
    tables.write_period_table(snap(spark, d), path)
    return tables.read_periods(spark, path, columns=SNAP_COLUMNS)


@query(sql("snap", body=f"SELECT {_ALL} FROM snap WHERE period IN {_MONTHS}"))
def scan_periods(spark, d):
    path = fresh_path(spark, "snap")
    tables.write_period_table(snap(spark, d), path)
    return tables.read_periods(spark, path, MONTHS, columns=SNAP_COLUMNS)


@query(sql("snap", body=f"SELECT {_ALL} FROM snap WHERE period IN {_MONTHS}"))
def scan_periods_of_calendar(spark, d):
    """The months come from a table, known only when the query runs."""
    path = fresh_path(spark, "snap")
    tables.write_period_table(snap(spark, d), path)
    calendar = snap(spark, d).select("period").where(F.col("period").isin(*MONTHS)).distinct()
    return tables.read_periods(spark, path, calendar, columns=SNAP_COLUMNS)


@query(sql("snap", body=f"SELECT id, period, m_price, m_returned FROM snap WHERE period IN {_MONTHS}"))
def scan_periods_pruned_cols(spark, d):
    path = fresh_path(spark, "snap")
    tables.write_period_table(snap(spark, d), path)
    wanted = [c for c in SNAP_COLUMNS if c in ("id", "period") or c.startswith("m_")]
    return tables.read_periods(spark, path, MONTHS, columns=wanted)


@query(sql("snap", body=f"SELECT {_ALL} FROM snap"))
def parquet_export(spark, d):
    path = fresh_path(spark, "export")
    tables.export_parquet(snap(spark, d), path)
    return spark.read.parquet(path)


@query(sql("snap", body=f"SELECT {_ALL} FROM snap WHERE period IN {_MONTHS} ORDER BY period, id LIMIT 10"))
def parquet_glob_scan(spark, d):
    path = fresh_path(spark, "export")
    tables.export_parquet(snap(spark, d), path)
    return tables.read_parquet_glob(spark, f"{path}/*.parquet", periods=MONTHS, limit=10)


@query(sql("ranked_mean", body=f'SELECT id, CAST(flag AS bigint) AS "Predicted" FROM ({_TOP})'))
def prediction_csv_sink(spark, d):
    ranking = rank(ensemble(spark, d), "score")
    path = csv.write_predictions(topk_flag(ranking, TOP), fresh_path(spark, "predictions"), "run", ranks=[1, 2])
    return spark.read.csv(path, header=True, schema="id bigint, Predicted bigint")


@query(sql("kept_features", body="SELECT feature FROM kept_features"))
def feature_list_sink(spark, d):
    path = fresh_path(spark, "features")
    kept = canary_cut(importance_mean(importances(spark, d)), gain="mean_gain")
    csv.write_feature_list(kept, path)
    return csv.read_feature_list(spark, path)


@query(sql("ranked_mean", body="SELECT id, CAST(score AS double) AS score FROM ranked_mean"))
def prediction_csv_scan(spark, d):
    path = fresh_path(spark, "scores")
    csv.write_csv(ensemble(spark, d).select("period", "id", F.col("score").alias("y_pred")), path)
    return csv.read_predictions(spark, path)
