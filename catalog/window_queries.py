"""Labels, row windows over an entity's history, z-scores."""

from pyspark.sql import functions as F

from catalog.aggregate_queries import PIVOT, Z_BY_PERIOD, Z_TOTAL, _DELTAS
from catalog.inputs import (
    BAD,
    SNAP_COLUMNS,
    deltas,
    r,
    rounded,
    rounded_doubles,
    snap,
    sparse,
    sql,
)
from catalog.registry import SQL, query
from tidepanel.operators import drift, frames, history, labels
from tidepanel.sources import tables
from tidepanel.sources.scratch import fresh_path, materialise

_ALL = ", ".join(SNAP_COLUMNS)
# Row windows run on the panel without the bad months, so a lag can span two of them.
_KEPT = f"(SELECT * FROM snap WHERE period NOT IN {BAD})"
_LAG = "WINDOW w AS (PARTITION BY id ORDER BY period)"
_SIX = (
    "WINDOW w AS (PARTITION BY id ORDER BY period), "
    "f AS (PARTITION BY id ORDER BY period ROWS BETWEEN 5 PRECEDING AND CURRENT ROW)"
)
COLUMNS = ["m_price", "q_units"]
HISTORY = ["n_lines", "n_orders", "q_units", "m_price", "m_returned"]
_EXPRESSIONS = {
    "avg6": (6, "avg({c}::double) OVER f"),
    "min6": (6, "min({c}::double) OVER f"),
    "max6": (6, "max({c}::double) OVER f"),
    "trend6": (4, "covar_pop({c}::double, rn) OVER f / nullif(var_pop(rn) OVER f, 0)"),
    "ratioavg6": (6, "{c}::double / nullif(avg({c}::double) OVER f, 0)"),
    "ratiomax6": (6, "{c}::double / nullif(max({c}::double) OVER f, 0)"),
}


def _rolled(columns, suffixes) -> str:
    return ", ".join(
        f"{r(_EXPRESSIONS[s][1].format(c=c), _EXPRESSIONS[s][0])} AS {c}_{s}" for c in columns for s in suffixes
    )


def _rolling_sql(*suffixes: str) -> str:
    return sql(
        "snap",
        body=f"""SELECT id, period, {_rolled(COLUMNS, suffixes)} FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY period) AS rn FROM {_KEPT}) {_SIX}""",
    )


def _panel(spark, d):
    return frames.exclude_periods(snap(spark, d), BAD)


def _round_all(df, columns, suffixes):
    for digits in (4, 6):
        names = [f"{c}_{s}" for c in columns for s in suffixes if _EXPRESSIONS[s][0] == digits]
        df = rounded_doubles(df, digits, *names) if names else df
    return df


def _rolling(spark, d, statistic, suffix):
    found = history.rolling(_panel(spark, d).select("id", "period", *COLUMNS), COLUMNS, [statistic]).drop(*COLUMNS)
    return _round_all(found, COLUMNS, [suffix])


@query(
    sql(
        "sparse_labels",
        body="SELECT period, id, p0, p1, p2 FROM sparse_labels_leads",
    )
)
def lead_periods(spark, d):
    return labels.lead_periods(sparse(spark, d))


@query(sql("labels", body="SELECT period, id, p0, p1, p2, label FROM labels"))
def churn_label_gap(spark, d):
    return labels.churn_label_gap(snap(spark, d))


@query(sql("sparse_labels", body="SELECT period, id, p0, p1, p2, label FROM sparse_labels"))
def churn_label_gap_sparse(spark, d):
    return labels.churn_label_gap(sparse(spark, d))


@query(
    sql(
        "sparse",
        body="""SELECT period, id, CASE WHEN rn = 1 AND period < 200108 THEN 'BAJA+1'
  WHEN rn = 2 AND period < 200107 THEN 'BAJA+2' WHEN rn >= 3 THEN 'CONTINUA' END AS label
  FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY period DESC) AS rn FROM sparse)""",
    )
)
def churn_label_rownum(spark, d):
    return labels.churn_label_rownum(sparse(spark, d), gone_in_one_before=200108, gone_in_two_before=200107)


@query(sql("sparse", body=f"SELECT id, period, row_number() OVER w AS row_index FROM sparse {_LAG}"))
def row_index(spark, d):
    found = history.with_row_index(sparse(spark, d).select("id", "period"))
    return found.withColumn("row_index", F.col("row_index").cast("bigint"))


def _lags(columns, levels):
    return ", ".join(f"lag({c}, {k}) OVER w AS {c}_lag{k}" for c in columns for k in levels)


def _changes(columns, levels):
    return ", ".join(f"{c} - lag({c}, {k}) OVER w AS {c}_delta{k}" for c in columns for k in levels)


@query(sql("sparse", body=f"SELECT *, {_lags(['n_orders', 'm_price'], (1, 2, 3))} FROM sparse {_LAG}"))
def lag_features(spark, d):
    return history.lag_features(sparse(spark, d), ["n_orders", "m_price"], 3)


@query(sql("sparse", body=f"SELECT *, {_changes(['n_orders', 'm_price'], (1, 2))} FROM sparse {_LAG}"))
def delta_features(spark, d):
    return history.delta_features(sparse(spark, d), ["n_orders", "m_price"], 2)


@query(
    sql(
        "snap",
        body="SELECT id, period, "
        + ", ".join(f"m_price::double - lag(m_price, {k}) OVER w AS m_price_delta_{k}" for k in (1, 2))
        + f" FROM {_KEPT} {_LAG}",
    )
)
def delta_from_lag_cols(spark, d):
    """Lags stored as text, as an earlier run may have left them."""
    stored = history.lag_features(_panel(spark, d).select("id", "period", "m_price"), ["m_price"], 2, separator="_")
    text = stored.withColumns({c: F.col(c).cast("string") for c in stored.columns if "_lag_" in c})
    return drift.delta_from_lags(text, ["m_price"], 2).select("id", "period", "m_price_delta_1", "m_price_delta_2")


@query(
    sql(
        "snap",
        body=f"""SELECT id, period, m_price AS m_price_lag_0, lag(q_units, 1) OVER w AS q_units_lag_1,
  lag(n_open, 2) OVER w AS n_open_lag_2 FROM {_KEPT} {_LAG}""",
    )
)
def lag_by_position(spark, d):
    found = history.lag_by_position(_panel(spark, d), ["m_price", "q_units", "n_open", "no_such_column"])
    return found.select("id", "period", "m_price_lag_0", "q_units_lag_1", "n_open_lag_2")


@query(_rolling_sql("avg6"))
def rolling_mean(spark, d):
    return _rolling(spark, d, "mean", "avg6")


@query(_rolling_sql("min6"))
def rolling_min(spark, d):
    return _rolling(spark, d, "min", "min6")


@query(_rolling_sql("max6"))
def rolling_max(spark, d):
    return _rolling(spark, d, "max", "max6")


@query(_rolling_sql("trend6"))
def rolling_trend(spark, d):
    return _rolling(spark, d, "trend", "trend6")


@query(_rolling_sql("ratioavg6"))
def ratio_to_rolling_mean(spark, d):
    return _rolling(spark, d, "ratio_mean", "ratioavg6")


@query(_rolling_sql("ratiomax6"))
def ratio_to_rolling_max(spark, d):
    return _rolling(spark, d, "ratio_max", "ratiomax6")


_HISTORY_LAGS = ", ".join(
    f"lag({c}::double, {k}) OVER w AS {c}_lag{k}, {c}::double - lag({c}::double, {k}) OVER w AS {c}_delta{k}"
    for c in HISTORY
    for k in (1, 2)
)


@query(
    sql(
        "snap",
        body=f"""SELECT {_ALL}, {_HISTORY_LAGS}, {_rolled(HISTORY, _EXPRESSIONS)} FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY period) AS rn FROM {_KEPT}) {_SIX}""",
    )
)
def historical_features(spark, d):
    return _round_all(history.historical_features(_panel(spark, d), HISTORY), HISTORY, _EXPRESSIONS)


WIDE = [f"c{i}" for i in range(77)]
_MIXES = ", ".join(f"m_price * {i + 1} + q_units AS {c}" for i, c in enumerate(WIDE))
_WIDE_LAGS = ", ".join(
    f"lag({c}, {k})  OVER w AS {c}_lag{k}, {c} - lag({c}, {k}) OVER w AS {c}_delta{k}" for c in WIDE for k in (1, 2)
)


@query(
    sql(
        "snap",
        body=f"""SELECT id, period, {', '.join(WIDE)}, {_WIDE_LAGS}, {_rolled(WIDE, _EXPRESSIONS)} FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY period) AS rn FROM (SELECT id, period, {_MIXES} FROM snap)) {_SIX}""",
    )
)
def history_of_77_columns(spark, d):
    """The full width of the monthly job: 77 columns in, 770 features out."""
    mixes = {c: F.col("m_price") * (i + 1) + F.col("q_units") for i, c in enumerate(WIDE)}
    panel = snap(spark, d).select("id", "period", *COLUMNS)
    return _round_all(history.historical_features(panel, WIDE, derived=mixes).drop(*COLUMNS), WIDE, _EXPRESSIONS)


@query(sql("deltas", body=f"SELECT period, feature, lvl, {r('value')} AS value, {r('z', 4)} AS z_score FROM {Z_BY_PERIOD}"))
def zscore_by_level(spark, d):
    means = drift.mean_of_each(deltas(spark, d), _DELTAS, ["period"])
    scored = drift.zscore_by_level(drift.long_means(means, _DELTAS, ["period"]))
    return rounded(rounded(scored, 6, "value"), 4, "z_score")


_CELLS = [f"delta_{i}" for i in range(1, 6)]


@query(sql("deltas", body=f"SELECT feature, {PIVOT} FROM {Z_TOTAL} GROUP BY feature"))
def delta_zscore_matrix(spark, d):
    return rounded(drift.delta_zscore_matrix(deltas(spark, d)), 4, *_CELLS)


@query(sql("deltas", body=f"SELECT period, feature, {PIVOT} FROM {Z_BY_PERIOD} GROUP BY period, feature"))
def delta_zscore_matrix_by_period(spark, d):
    return rounded(drift.delta_zscore_matrix(deltas(spark, d), by=["period"]), 4, *_CELLS)


@query(
    sql("deltas", body=f"SELECT period, feature, {PIVOT} FROM {Z_BY_PERIOD} GROUP BY period, feature ORDER BY 1, 2")
)
def ordered_output(spark, d):
    return rounded(drift.delta_zscore_matrix(deltas(spark, d), by=["period"]), 4, *_CELLS).orderBy("period", "feature")


def _by_entity(spark, df):
    """The frame as a table bucketed by entity."""
    path = fresh_path(spark, "entities")
    return tables.write_entity_table(df, path.rsplit("/", 1)[-1].replace("-", "_"), path, buckets=16)


@query(SQL["historical_features"])
def entity_table_history(spark, d):
    found = history.historical_features(_by_entity(spark, _panel(spark, d)), HISTORY)
    return _round_all(found, HISTORY, _EXPRESSIONS)


@query(SQL["churn_label_gap"])
def entity_table_labels(spark, d):
    return labels.churn_label_gap(_by_entity(spark, snap(spark, d)))


@query(sql("labelled", body=f"SELECT {_ALL}, label FROM labelled"))
def entity_table_label_join(spark, d):
    panel = _by_entity(spark, snap(spark, d))
    return labels.join_labels(panel, labels.churn_label_gap(panel))


_LATE = "period >= 200105"


@query(SQL["historical_features"].replace(f"SELECT {_ALL},", f"SELECT * FROM (SELECT {_ALL},", 1) + f") WHERE {_LATE}")
def history_by_month(spark, d):
    """The panel up to a month as one batch, then every later month from the state alone."""
    panel = materialise(_panel(spark, d))
    state = materialise(history.history_state(panel.where(f"NOT {_LATE}"), HISTORY))
    out = []
    for r_ in panel.where(_LATE).select("period").distinct().orderBy("period").collect():  # a row for each month
        features, state = history.history_step(state, panel.where(F.col("period") == r_["period"]), HISTORY)
        out.append(features)
        state = materialise(state)
    found = out[0]
    for features in out[1:]:
        found = found.unionByName(features)
    return _round_all(found, HISTORY, _EXPRESSIONS)


@query(sql("labels", body="SELECT id, period, label FROM labels"))
def labels_by_month(spark, d):
    """Labels of the panel up to a month, then those that every later month settles, and what is open at the end."""
    panel = materialise(snap(spark, d).select("id", "period"))
    first = labels.churn_label_gap(panel.where(f"NOT {_LATE}")).select("id", "period", "label")
    found, still = first.where("label IS NOT NULL"), materialise(first.where("label IS NULL"))
    for r_ in panel.where(_LATE).select("period").distinct().orderBy("period").collect():  # a row for each month
        settled, still = labels.label_step(still, panel.where(F.col("period") == r_["period"]))
        found, still = found.unionByName(settled), materialise(still)
    return found.unionByName(still)
