"""Aggregations: means, importances, profits, counts."""

from pyspark.sql import functions as F

from catalog.inputs import (
    CEILING,
    DELTA_FEATURES,
    FLOOR,
    MEASURES,
    TOP,
    deltas,
    importances,
    labelled,
    r,
    rounded,
    runs,
    scores,
    snap,
    sparse,
    sql,
)
from catalog.merge_queries import _MEANS, _long
from catalog.registry import query
from tidepanel.functions.features import confusion_profit as profit_of
from tidepanel.operators import curves, drift, labels, profiling, sampling, selection, trials

_DELTAS = [f"{c}_delta_{k}" for c in DELTA_FEATURES for k in range(1, 6)]
_Z = """(SELECT period, feature, lvl, value,
  (value - avg(value) OVER (PARTITION BY lvl)) / nullif(stddev_samp(value) OVER (PARTITION BY lvl), 0) AS z FROM (
  SELECT period, regexp_extract(col_name, '^(.*)_delta_[0-9]+$', 1) AS feature,
    CAST(regexp_extract(col_name, '_delta_([0-9]+)$', 1) AS bigint) AS lvl, value
  FROM (WITH means AS ({means}) {long})))"""
Z_BY_PERIOD = _Z.format(means=_MEANS, long=_long())
Z_TOTAL = _Z.format(
    means="SELECT 0 AS period, " + ", ".join(f"avg({c}) AS {c}" for c in _DELTAS) + " FROM deltas", long=_long()
)
PIVOT = ", ".join(f"{r(f'avg(CASE WHEN lvl = {i} THEN z END)', 4)} AS delta_{i}" for i in range(1, 6))


@query(
    sql(
        "snap",
        body="SELECT max(p)::bigint AS last_serial, (max(p) - 1)::bigint AS previous_serial "
        "FROM (SELECT (period // 100) * 12 + period % 100 AS p FROM snap)",
    )
)
def max_period_scalar(spark, d):
    return labels.last_periods(snap(spark, d))


@query(sql("snap", body="SELECT count(*) AS n FROM (SELECT id, period FROM snap UNION ALL SELECT id, period FROM snap)"))
def row_count(spark, d):
    panel = snap(spark, d).select("id", "period")
    return panel.union(panel).agg(F.count(F.lit(1)).alias("n"))


@query(sql("deltas", body="SELECT " + ", ".join(f"{r(f'avg({c})')} AS {c}" for c in _DELTAS) + " FROM deltas"))
def avg_many_columns(spark, d):
    frame = deltas(spark, d)
    return rounded(drift.mean_of_each(frame, drift.delta_columns(frame.columns)), 6, *_DELTAS)


@query(
    sql(
        "deltas",
        body="SELECT period, " + ", ".join(f"{r(f'avg({c})')} AS {c}" for c in _DELTAS) + " FROM deltas GROUP BY period",
    )
)
def avg_many_columns_by_period(spark, d):
    frame = deltas(spark, d)
    return rounded(drift.mean_of_each(frame, drift.delta_columns(frame.columns), ["period"]), 6, *_DELTAS)


_RAW_PIVOT = ", ".join(f"{r(f'avg(CASE WHEN lvl = {i} THEN value END)')} AS delta_{i}" for i in range(1, 6))


@query(sql("deltas", body=f"SELECT period, feature, {_RAW_PIVOT} FROM {Z_BY_PERIOD} GROUP BY period, feature"))
def conditional_pivot(spark, d):
    means = drift.mean_of_each(deltas(spark, d), _DELTAS, ["period"])
    long = drift.long_means(means, _DELTAS, ["period"]).withColumnRenamed("value", "z_score")
    return rounded(drift.pivot_levels(long, by=["period"]), 6, *[f"delta_{i}" for i in range(1, 6)])


@query(
    sql(
        "importances",
        body=f"""SELECT feature, {r('avg(gain)')} AS mean, {r('stddev_samp(gain)', 4)} AS std, count(gain) AS count
  FROM importances GROUP BY feature""",
    )
)
def importance_summary(spark, d):
    return rounded(rounded(selection.importance_summary(importances(spark, d)), 6, "mean"), 4, "std")


@query(sql("importances", body=f"SELECT feature, {r('avg(gain)')} AS mean_gain FROM importances GROUP BY feature"))
def importance_mean(spark, d):
    return rounded(selection.importance_mean(importances(spark, d)), 6, "mean_gain")


@query(
    sql(
        "importances",
        body=f"""SELECT {r('m', 4)} AS mean_gain, {r('m * 1.45::double', 4)} AS upper, {r('m * 0.55::double', 4)} AS lower
  FROM (SELECT avg(gain) AS m FROM importances WHERE feature LIKE '%canary%')""",
    )
)
def canary_gain_band(spark, d):
    return rounded(selection.canary_gain_band(importances(spark, d)), 4, "mean_gain", "upper", "lower")


@query(sql("ensemble", body="SELECT id, period, score, n_models FROM ensemble"))
def score_ensemble_mean(spark, d):
    return curves.score_ensemble_mean(scores(spark, d))


@query(
    sql(
        "ranked",
        body=f"""SELECT (rk - 1)::bigint AS k, {r('avg(cum)')} AS mean_gain FROM ranked
  WHERE rk > {FLOOR} AND rk <= {CEILING} GROUP BY rk""",
    )
)
def mean_gain_curve(spark, d):
    ranking = curves.ranked_profit(scores(spark, d))
    return rounded(curves.mean_gain_curve(ranking, FLOOR, CEILING), 6, "mean_gain")


@query(
    sql(
        "ranked",
        body=f"""SELECT (rk - 1)::bigint AS k_opt, {r('g')} AS gain_max, {r('t')} AS mean_thr FROM (
  SELECT rk, avg(cum) AS g, avg(prev) AS t FROM ranked WHERE rk > {FLOOR} AND rk <= {CEILING} GROUP BY rk)
  ORDER BY g DESC, rk LIMIT 1""",
    )
)
def mean_threshold_at_k(spark, d):
    ranking = curves.ranked_profit(scores(spark, d))
    return rounded(curves.mean_best_cut(ranking, FLOOR, CEILING), 6, "gain_max", "mean_thr")


@query(
    sql(
        "sparse",
        body="""SELECT string_agg(p, ', ' ORDER BY p) AS title, string_agg(p, '_' ORDER BY p) AS name
  FROM (SELECT DISTINCT CAST(period AS varchar) AS p FROM sparse)""",
    )
)
def distinct_periods(spark, d):
    return trials.distinct_periods(sparse(spark, d))


_ACTUAL = "CASE WHEN label = 'BAJA+2' THEN 1 ELSE 0 END"


def _profit(predicted: str) -> str:
    return f"""SELECT model, CAST(sum(CASE WHEN {predicted} AND {_ACTUAL} = 1 THEN 780000
  WHEN {predicted} THEN -20000 ELSE 0 END) AS bigint) AS profit FROM scores GROUP BY model"""


@query(sql("scores", body=_profit("id % 3 = 0")))
def confusion_profit(spark, d):
    actual = F.when(F.col("label") == "BAJA+2", 1).otherwise(0)
    predicted = F.when(F.col("id") % 3 == 0, 1).otherwise(0)
    return scores(spark, d).groupBy("model").agg(profit_of(actual, predicted).alias("profit"))


@query(sql("scores", body=_profit("score / 1300.0::double > 0.025::double")))
def threshold_profit(spark, d):
    return curves.threshold_profit(scores(spark, d).withColumn("score", F.col("score") / 1300.0))


@query(
    sql(
        "ranked",
        body=f"""SELECT model, max(rk) AS k, max(score) AS score_max, min(score) AS score_cut
  FROM ranked WHERE rk <= {TOP} GROUP BY model""",
    )
)
def cutoff_score(spark, d):
    return curves.cutoff_score(curves.ranked_profit(scores(spark, d)), TOP)


@query(
    sql(
        "runs",
        body=f"""SELECT trial, {r('avg(best_iter)')} AS mean_best_iter, CAST(trunc(avg(best_iter)) AS bigint) AS rounds,
  {r('avg(plateau_gain)', 4)} AS plateau_gain, max(gain_max) AS gain_max,
  max(CASE WHEN place = 1 THEN peak END) AS peak FROM (
    SELECT *, row_number() OVER (PARTITION BY trial ORDER BY gain_max DESC, peak) AS place FROM runs) GROUP BY trial""",
    )
)
def trial_summary(spark, d):
    found = trials.trial_summary(runs(spark, d))
    return rounded(rounded(found, 6, "mean_best_iter"), 4, "plateau_gain")


@query(
    sql(
        "labelled",
        body="""SELECT s.split, count(l.id) AS n, count(l.id) = 0 AS is_empty
  FROM (SELECT unnest(['train', 'test', 'pred', 'empty', 'rest']) AS split) s
  LEFT JOIN labelled l ON s.split = CASE WHEN period <= 199912 THEN 'train' WHEN period <= 200006 THEN 'test'
    WHEN period = 200007 THEN 'pred' ELSE 'rest' END GROUP BY 1""",
    )
)
def split_counts(spark, d):
    month = F.col("period")
    split = F.when(month <= 199912, "train").when(month <= 200006, "test").when(month == 200007, "pred")
    return sampling.split_counts(labelled(spark, d).withColumn("split", split), ["train", "test", "pred", "empty"])


@query(
    sql(
        "snap",
        body=" UNION ALL ".join(
            f'SELECT \'{c}\' AS "column", min({c})::double AS "min", max({c})::double AS "max" FROM snap' for c in MEASURES
        ),
    )
)
def column_ranges(spark, d):
    return profiling.column_ranges(snap(spark, d), MEASURES)
