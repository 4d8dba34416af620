"""Joins, merges, set operations and reshaping."""

from pyspark.sql import functions as F

from catalog.inputs import (
    DELTA_FEATURES,
    SNAP_COLUMNS,
    deltas,
    importances,
    r,
    rounded,
    scores,
    snap,
    sparse,
    sql,
    summary,
)
from catalog.registry import SQL, query
from tidepanel.operators import combine, drift, labels
from tidepanel.sources import stored
from tidepanel.sources.scratch import fresh_path

_ALL = ", ".join(SNAP_COLUMNS)
_DELTAS = [f"{c}_delta_{k}" for c in DELTA_FEATURES for k in range(1, 6)]
KEYS = ["experiment", "model"]
SPLIT = 199806
NOW = "2024-02-01 00:00:00"


@query(sql("labelled", body=f"SELECT {_ALL}, label FROM labelled"))
def label_left_join(spark, d):
    panel = snap(spark, d)
    return labels.join_labels(panel, labels.churn_label_gap(panel))


@query(
    sql(
        "sparse",
        body="""SELECT id, period, (m)::bigint AS last_serial, (m - 1)::bigint AS previous_serial
  FROM sparse, (SELECT max((period // 100) * 12 + period % 100) AS m FROM sparse)""",
    )
)
def scalar_cross_join(spark, d):
    panel = sparse(spark, d)
    return labels.with_last_periods(panel.select("id", "period"), panel)


@query(
    sql(
        "scores",
        "sparse_labels",
        body="""SELECT s.model, s.id, s.period, s.score, t.label FROM scores s
  JOIN sparse_labels t ON s.id = t.id AND s.period = t.period""",
    )
)
def score_target_inner_join(spark, d):
    targets = labels.churn_label_gap(sparse(spark, d)).select("id", "period", "label")
    return scores(spark, d).drop("label").join(targets, ["id", "period"]).select("model", "id", "period", "score", "label")


@query(
    sql(
        "summary_old",
        "summary_new",
        body=f"""SELECT coalesce(n.experiment, o.experiment) AS experiment, coalesce(n.model, o.model) AS model,
  coalesce(n.k_opt, o.k_opt) AS k_opt, coalesce(n.gain_max, o.gain_max) AS gain_max,
  CASE WHEN n.model IS NULL THEN o.updated ELSE '{NOW}' END AS updated
  FROM summary_old o FULL JOIN summary_new n ON o.experiment = n.experiment AND o.model = n.model""",
    )
)
def summary_upsert(spark, d):
    return combine.upsert(summary(spark, d, "NA"), summary(spark, d, "R"), KEYS, updated=F.lit(NOW))


@query(
    sql(
        "summary_old",
        "summary_new",
        body="""SELECT experiment, model, k_opt, gain_max, updated FROM (
  SELECT *, row_number() OVER (PARTITION BY experiment, model ORDER BY batch DESC) AS rn FROM (
    SELECT *, 0 AS batch FROM summary_old UNION ALL SELECT *, 1 AS batch FROM summary_new)) WHERE rn = 1""",
    )
)
def summary_keep_last(spark, d):
    batches = [summary(spark, d, flag).withColumn("batch", F.lit(i)) for i, flag in enumerate(("NA", "R"))]
    return combine.keep_last(combine.union_positional(*batches), KEYS, ["batch"]).drop("batch")


@query(
    sql(
        "summary_old",
        "summary_new",
        body="""SELECT concat(experiment, '/', model) AS model_path, k_opt, gain_max FROM (
  SELECT * FROM summary_old UNION ALL
  SELECT * FROM summary_new n WHERE NOT EXISTS (
    SELECT 1 FROM summary_old o WHERE o.experiment = n.experiment AND o.model = n.model))""",
    )
)
def insert_if_absent(spark, d):
    def metadata(flag):
        path = F.concat_ws("/", "experiment", "model").alias("model_path")
        return summary(spark, d, flag).select(path, "k_opt", "gain_max")

    return combine.insert_if_absent(metadata("NA"), metadata("R"), ["model_path"])


@query(
    sql(
        "snap",
        body=f"""SELECT id, period, n_lines, n_orders, q_units,
  CASE WHEN period >= {SPLIT} AND id % 10 = 0 THEN NULL ELSE CAST(m_price AS double) END AS m_price,
  m_returned, n_open, s_nationkey FROM snap""",
    )
)
def union_all_aligned(spark, d):
    """Second table: other column order, an extra column, a text column with junk in it."""
    panel = snap(spark, d)
    text = F.when(F.col("id") % 10 == 0, "junk").otherwise(F.col("m_price").cast("string"))
    later = panel.where(F.col("period") >= SPLIT).withColumn("m_price", text).withColumn("extra", F.lit(1))
    later = later.select(*reversed(later.columns))
    return combine.union_aligned(panel.where(F.col("period") < SPLIT), later, types={"m_price": "double"})


@query(sql("snap", body=f"SELECT {_ALL} FROM snap"))
def union_all_positional(spark, d):
    panel = snap(spark, d)
    later = panel.where(F.col("period") >= SPLIT).toDF(*[f"c{i}" for i in range(len(SNAP_COLUMNS))])
    return combine.union_positional(panel.where(F.col("period") < SPLIT), later)


@query(sql("importances", body="SELECT concat('m', model) AS model, feature, gain FROM importances"))
def concat_model_frames(spark, d):
    """One stored table per model, as many as there are models."""
    path = fresh_path(spark, "importances")
    importances(spark, d).write.partitionBy("model").parquet(path)
    models = [r["model"] for r in spark.read.parquet(path).select("model").distinct().collect()]
    frames = {f"m{i}": spark.read.parquet(f"{path}/model={i}") for i in sorted(models)}
    return combine.stack_models(frames).select("model", "feature", "gain")


_MEANS = "SELECT period, " + ", ".join(f"avg({c}) AS {c}" for c in _DELTAS) + " FROM deltas GROUP BY period"


def _long(value: str = "value") -> str:
    parts = [f"SELECT period, '{c}' AS col_name, {c} AS {value} FROM means" for c in _DELTAS]
    return f"SELECT * FROM ({' UNION ALL '.join(parts)}) WHERE {value} IS NOT NULL"


@query(
    sql("deltas", body=f"SELECT period, col_name, {r('value')} AS value FROM (WITH means AS ({_MEANS}) {_long()})")
)
def unpivot_columns(spark, d):
    means = drift.mean_of_each(deltas(spark, d), _DELTAS, ["period"])
    return rounded(combine.unpivot_columns(means, _DELTAS, keys=["period"]), 6, "value")


@query(
    sql(
        "deltas",
        body=f"""SELECT period, regexp_extract(col_name, '^(.*)_delta_[0-9]+$', 1) AS feature,
  CAST(regexp_extract(col_name, '_delta_([0-9]+)$', 1) AS bigint) AS lvl, {r('value')} AS value
  FROM (WITH means AS ({_MEANS}) {_long()})""",
    )
)
def parse_feature_name(spark, d):
    means = drift.mean_of_each(deltas(spark, d), _DELTAS, ["period"])
    return rounded(drift.long_means(means, _DELTAS, ["period"]), 6, "value")


@query(SQL["summary_upsert"])
def summary_upsert_stored(spark, d):
    """The table is kept as files and merged twice; the second time changes nothing."""
    path = fresh_path(spark, "summary")
    stored.upsert_stored(summary(spark, d, "NA"), path, KEYS, partition="experiment")
    for _ in range(2):
        stored.upsert_stored(summary(spark, d, "R").withColumn("updated", F.lit(NOW)), path, KEYS, partition="experiment")
    return stored.read_stored(summary(spark, d, "R"), path)


@query(sql("summary_old", "summary_new", body="""SELECT experiment, model, k_opt, gain_max, updated FROM summary_old UNION ALL
  SELECT experiment, model, k_opt, gain_max, updated FROM summary_new n WHERE NOT EXISTS (
    SELECT 1 FROM summary_old o WHERE o.experiment = n.experiment AND o.model = n.model)"""))
def insert_if_absent_stored(spark, d):
    path = fresh_path(spark, "summary")
    for flags in ("NA", "R", "NA"):
        stored.insert_stored(summary(spark, d, flags), path, KEYS, partition="experiment")
    return stored.read_stored(summary(spark, d, "R"), path)
