"""Projections, filters and column sets chosen from the schema."""

from pyspark.sql import functions as F

from catalog.inputs import (
    BAD,
    DELTA_FEATURES,
    SNAP_COLUMNS,
    deltas,
    importances,
    labelled,
    r,
    raw_text,
    rounded,
    snap,
    sparse,
    sql,
    table,
)
from catalog.registry import query
from tidepanel.functions import features as X
from tidepanel.functions.names import groups_by_substring
from tidepanel.functions import periods
from tidepanel.operators import frames, profiling, sampling
from tidepanel.operators.drift import with_momentum
from tidepanel.operators.history import with_row_index
from tidepanel.operators.selection import canary_rows

GROUPS = {"master": "m_", "visa": "n_"}
NOT_COUNTED = ["id", "period", "label"]
_ALL = ", ".join(SNAP_COLUMNS)


@query(
    sql(
        "raw_text",
        body="""SELECT id, try_cast(amount_txt AS double) AS amount_txt, try_cast(flag_txt AS bigint) AS flag_txt, fecha_txt
  FROM raw_text""",
    )
)
def safe_cast_overrides(spark, d):
    return frames.cast_columns(raw_text(spark, d), {"amount_txt": "double", "flag_txt": "bigint"})


@query("SELECT c_custkey, CAST(c_nationkey AS bigint) AS c_nationkey FROM customer")
def select_numeric_columns(spark, d):
    found = frames.select_numeric(table(spark, d, "customer"), exclude=["c_acctbal"])
    return found.withColumn("c_nationkey", F.col("c_nationkey").cast("bigint"))


@query(sql("labelled", body="SELECT id, period, n_lines, n_orders, q_units, m_price, m_returned, n_open FROM labelled"))
def drop_tolerant(spark, d):
    return frames.drop_targets(labelled(spark, d), ["s_nationkey", "no_such_column"])


@query(
    sql(
        "deltas",
        body=f"SELECT {_ALL}, " + ", ".join(f"{c}_delta_{k}" for c in DELTA_FEATURES for k in (1, 2)) + " FROM deltas",
    )
)
def lag_delta_depth_filter(spark, d):
    return frames.select_depth(deltas(spark, d), 2)


@query(
    sql(
        "snap",
        body="""SELECT 'master' AS grp, 2::bigint AS n_columns, sum(m_price + m_returned)::bigint AS total FROM snap
  UNION ALL SELECT 'visa', 3, sum(n_lines + n_orders + n_open)::bigint FROM snap
  UNION ALL SELECT 'general', 2, sum(q_units + s_nationkey)::bigint FROM snap""",
    )
)
def column_groups_by_name(spark, d):
    """Groups found by name, each with the total of its columns."""
    panel = snap(spark, d)
    groups = groups_by_substring(panel.columns, GROUPS, "general", NOT_COUNTED)
    totals = panel.agg(*[sum((F.sum(c) for c in members), F.lit(0)).alias(g) for g, members in groups.items()])
    sizes = F.create_map(*[F.lit(v).cast(t) for g, m in groups.items() for v, t in ((g, "string"), (len(m), "bigint"))])
    return totals.unpivot([], list(groups), "grp", "total").select("grp", sizes[F.col("grp")].alias("n_columns"), "total")


def _nonzero(*columns: str) -> str:
    return "(" + " + ".join(f"CASE WHEN {c} <> 0 THEN 1 ELSE 0 END" for c in columns) + ")::bigint"


@query(
    sql(
        "snap",
        body=f"""SELECT {_ALL}, {_nonzero("m_price", "m_returned")} AS q_master,
  {_nonzero("n_lines", "n_orders", "n_open")} AS q_visa, {_nonzero("q_units", "s_nationkey")} AS q_general FROM snap""",
    )
)
def nonzero_count(spark, d):
    return frames.product_counts(snap(spark, d), GROUPS, "general", NOT_COUNTED)


@query(sql("snap", body=f"SELECT {_ALL} FROM snap WHERE period NOT IN {BAD}"))
def exclude_periods(spark, d):
    return frames.exclude_periods(snap(spark, d), BAD)


@query(
    sql(
        "labelled",
        body="""SELECT id, period, label FROM labelled WHERE period IN (200007, 200008)
  OR (label IN ('BAJA+1', 'BAJA+2') AND period >= 199601) OR (label = 'CONTINUA' AND period >= 199801)""",
    )
)
def business_train_filter(spark, d):
    kept = sampling.business_filter(labelled(spark, d), [200007, 200008], first_churn=199601, first_stay=199801)
    return kept.select("id", "period", "label")


@query(
    sql(
        "sparse",
        body="""SELECT c.period, coalesce(n, 0)::bigint AS n FROM (
  SELECT unnest(generate_series((lo//100)*12 + lo%100 - 1, (hi//100)*12 + hi%100 - 1)) AS s
  FROM (SELECT min(period) AS lo, max(period) AS hi FROM sparse)) AS g,
  LATERAL (SELECT ((s//12)*100 + s%12 + 1)::bigint AS period) AS c
  LEFT JOIN (SELECT period, count(*) AS n FROM sparse GROUP BY 1) AS k ON k.period = c.period""",
    )
)
def period_calendar(spark, d):
    """Every month of the table's range with its number of rows."""
    panel = sparse(spark, d)
    counted = panel.groupBy("period").agg(F.count(F.lit(1)).alias("n"))
    months = frames.period_calendar(panel)
    return months.join(counted, "period", "left").select("period", F.coalesce("n", F.lit(0)).alias("n"))


@query(sql("snap", body="SELECT id, period, period % 100 AS kmonth FROM snap"))
def month_of_year(spark, d):
    return snap(spark, d).select("id", "period", periods.month_of_year(F.col("period")).alias("kmonth"))


@query(
    sql(
        "snap",
        body="""SELECT id, period, CAST(CASE tenure WHEN 1 THEN n_lines * 5.0 WHEN 2 THEN n_lines * 2.0
  WHEN 3 THEN n_lines * CAST(1.2 AS double) ELSE n_lines END AS double) AS scaled
  FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY period) AS tenure FROM snap)""",
    )
)
def tenure_scaled(spark, d):
    aged = with_row_index(snap(spark, d), "tenure")
    return aged.select("id", "period", X.tenure_scaled(F.col("n_lines"), F.col("tenure")).alias("scaled"))


@query(
    sql(
        "snap",
        body=f"SELECT id, period, {r('CAST(m_price AS double) / nullif(s_nationkey, 0)')} AS ratio FROM snap",
    )
)
def guarded_ratio(spark, d):
    ratio = X.guarded_ratio(F.col("m_price"), F.col("s_nationkey")).alias("ratio")
    return rounded(snap(spark, d).select("id", "period", ratio), 6, "ratio")


@query(sql("labelled", body="SELECT id, period, n_lines, n_orders, m_price, m_returned, n_open, label FROM labelled"))
def label_last_projection(spark, d):
    mixed = labelled(spark, d).select("label", *SNAP_COLUMNS)
    return frames.label_last(mixed, "q_units", "s_nationkey")


@query(
    sql(
        "labelled",
        body="""SELECT id, period, label,
  CASE WHEN label IN ('BAJA+1', 'BAJA+2') THEN 1 WHEN label = 'CONTINUA' THEN 0 END::bigint AS y,
  CASE label WHEN 'BAJA+2' THEN 1.00002::double WHEN 'BAJA+1' THEN 1.00001::double
    WHEN 'CONTINUA' THEN 1.0::double END AS w FROM labelled""",
    )
)
def binary_target_weight(spark, d):
    label = F.col("label")
    return labelled(spark, d).select(
        "id", "period", label, X.binary_target(label).alias("y"), X.class_weight(label).alias("w")
    )


@query(
    sql(
        "labelled",
        body="""SELECT id, period, label, CASE WHEN label = 'BAJA+2' THEN 1 ELSE 0 END::bigint AS y1,
  CASE WHEN label = 'CONTINUA' THEN 0 ELSE 1 END::bigint AS y2,
  CASE WHEN label = 'BAJA+2' THEN 1.00002::double WHEN label = 'BAJA+1' THEN 1.00001::double ELSE 1.0::double END AS w
  FROM labelled""",
    )
)
def binary_target_variants(spark, d):
    label = F.col("label")
    return labelled(spark, d).select(
        "id",
        "period",
        label,
        X.hit_target(label).alias("y1"),
        X.not_staying_target(label).alias("y2"),
        X.class_weight(label, 1.0).alias("w"),
    )


@query(sql("sparse", body="SELECT id, period, (period // 100) * 12 + period % 100 AS p0 FROM sparse"))
def period_serial(spark, d):
    return sparse(spark, d).select("id", "period", periods.month_serial(F.col("period")).alias("p0"))


@query(
    sql(
        "deltas",
        body="SELECT id, period, "
        + ", ".join(f"3*{c}_delta_1 + 2*{c}_delta_2 + {c}_delta_3 AS {c}_momentum" for c in DELTA_FEATURES)
        + " FROM deltas",
    )
)
def weighted_momentum(spark, d):
    found = with_momentum(deltas(spark, d), DELTA_FEATURES)
    return found.select("id", "period", *[f"{c}_momentum" for c in DELTA_FEATURES])


_CLEAN = """id, CASE WHEN trim(amount_txt) NOT IN ('', 'None', 'NULL', 'NaN') THEN trim(amount_txt) END
  AS amount_txt, flag_txt, fecha_txt FROM raw_text"""


@query(sql("raw_text", body=f"SELECT id, amount_txt, flag_txt, fecha_txt FROM (SELECT {_CLEAN})"))
def null_token_normalise(spark, d):
    return profiling.normalise_null_tokens(raw_text(spark, d), ["amount_txt", "flag_txt", "fecha_txt"])


@query(
    sql(
        "raw_text",
        body="""SELECT id, CASE WHEN upper(flag_txt) IN ('S', 'SI') THEN 1.0::double ELSE 0.0::double END AS flag_txt
  FROM raw_text""",
    )
)
def yes_no_to_number(spark, d):
    text = profiling.normalise_null_tokens(raw_text(spark, d), ["amount_txt", "flag_txt", "fecha_txt"])
    flags = profiling.yes_no_columns(text, ["amount_txt", "flag_txt", "fecha_txt"])
    return profiling.coerce_text(text.select("id", *flags))


@query(
    sql(
        "raw_text",
        body="""SELECT id, CAST(date_diff('day', DATE '1970-01-01', try_cast(fecha_txt AS date)) AS double) AS fecha_txt
  FROM raw_text""",
    )
)
def date_to_epoch_day(spark, d):
    return profiling.coerce_text(raw_text(spark, d).select("id", "fecha_txt"))


@query(sql("raw_text", body="SELECT id, try_cast(replace(trim(amount_txt), ',', '.') AS double) AS amount_txt FROM raw_text"))
def decimal_comma_to_number(spark, d):
    return profiling.coerce_text(raw_text(spark, d).select("id", "amount_txt"))


@query(sql("labelled", body="SELECT id, period, label FROM labelled WHERE label IS NOT NULL"))
def drop_null_label(spark, d):
    return labelled(spark, d).dropna(subset=["label"]).select("id", "period", "label")


@query(sql("importances", body="SELECT model, feature, gain FROM importances WHERE lower(feature) LIKE '%canary%'"))
def name_contains_filter(spark, d):
    return canary_rows(importances(spark, d))


@query(sql("snap", body="SELECT m_price, 0.0::double AS absent, q_units FROM snap"))
def align_to_model_features(spark, d):
    return frames.align_to_features(snap(spark, d), ["m_price", "absent", "q_units"], on_missing="zero")
