"""Panels and result tables derived from the given tables, as DataFrames and as SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepanel.operators.curves import score_ensemble_mean
from tidepanel.operators.history import delta_features
from tidepanel.operators.labels import with_gap_label
from tidepanel.sources.scratch import materialise

MEASURES = ["n_lines", "n_orders", "q_units", "m_price", "m_returned", "n_open"]
SNAP_COLUMNS = ["id", "period", *MEASURES, "s_nationkey"]
DELTA_FEATURES = ["m_price", "q_units", "n_lines", "n_orders"]
BAD = (199605, 199610, 199706)
MODELS = 5
FLOOR, CEILING, HALF_WIDTH, TOP = 100, 1000, 50, 700


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def month(ts: str) -> Column:
    return (F.year(ts) * 100 + F.month(ts)).cast("bigint")


def cents(amount: str) -> Column:
    """Nearest whole number of cents; cheaper than round(), which goes through decimals."""
    return F.floor(F.col(amount) * 100 + 0.5)


def big(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("bigint")


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    """Doubles cut to ``digits``; adding 0.0 turns a negative zero into zero."""
    return df.withColumns({c: F.round(F.col(c), digits) + F.lit(0.0) for c in columns})


def rounded_doubles(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    """``rounded`` without its decimals, for very many values; NaN and what is too large for whole numbers go through it."""

    def cut(c: str) -> Column:
        plain = F.signum(c) * (F.floor(F.abs(c) * 10**digits + 0.5) / F.lit(10.0**digits))
        return F.when(F.abs(c) < 1e9, plain).otherwise(F.round(c, digits)) + F.lit(0.0)

    return df.withColumns({c: cut(c) for c in columns})


def snap(spark: SparkSession, d: str) -> DataFrame:
    """Dense supplier-month panel.

    Lines are dealt by supplier and month before they are counted: hardly two lines share an order, so counting by order first would
    exchange nearly all of them twice.
    """
    lines = (
        table(spark, d, "lineitem")
        .select(
            F.col("l_suppkey").alias("id"),
            month("l_shipdate").alias("period"),
            "l_orderkey",
            big("l_quantity").alias("quantity"),
            cents("l_extendedprice").alias("price"),
            (F.col("l_returnflag") == "R").alias("is_returned"),
            (F.col("l_linestatus") == "O").alias("is_open"),
        )
        .repartition("id", "period")
    )
    panel = lines.groupBy("id", "period").agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.count_distinct("l_orderkey").alias("n_orders"),
        F.sum("quantity").alias("q_units"),
        F.sum("price").alias("m_price"),
        F.sum(F.when(F.col("is_returned"), F.col("price")).otherwise(0)).alias("m_returned"),
        F.sum(F.when(F.col("is_open"), 1).otherwise(0)).alias("n_open"),
    )
    nation = table(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), big("s_nationkey").alias("s_nationkey"))
    return panel.join(nation, "id").select(*SNAP_COLUMNS)


def sparse(spark: SparkSession, d: str) -> DataFrame:
    """Customer-month panel with many gaps."""
    return (
        table(spark, d, "orders")
        .groupBy(F.col("o_custkey").alias("id"), month("o_orderdate").alias("period"))
        .agg(F.count(F.lit(1)).alias("n_orders"), F.sum(cents("o_totalprice")).alias("m_price"))
    )


def labelled(spark: SparkSession, d: str) -> DataFrame:
    """``snap`` with its gap label."""
    return with_gap_label(snap(spark, d))


def deltas(spark: SparkSession, d: str, depth: int = 5) -> DataFrame:
    """``snap`` with ``<feature>_delta_<1..depth>``."""
    return delta_features(snap(spark, d), DELTA_FEATURES, depth, separator="_")


def scores(spark: SparkSession, d: str) -> DataFrame:
    """Long scores of five models with many ties and some missing labels."""
    key = F.col("o_orderkey")
    label = (
        F.when(key % 60 == 0, "BAJA+2").when(key % 60 == 1, "BAJA+1").when(key % 60 != 2, "CONTINUA").alias("label")
    )
    score = (key * 7919 + F.col("model") * 104729) % 1000 + F.when(key % 60 == 0, 300).otherwise(0)
    models = F.explode(F.array(*[big(F.lit(i)) for i in range(1, MODELS + 1)])).alias("model")
    rows = table(spark, d, "orders").select("o_orderkey", "o_orderdate", models)
    return rows.select(
        "model", key.alias("id"), month("o_orderdate").alias("period"), label, big(score).alias("score")
    )


def ensemble(spark: SparkSession, d: str) -> DataFrame:
    """One mean score per row over the five models, written once because ranking reads it several times."""
    return materialise(score_ensemble_mean(scores(spark, d), keep=["label"]))


def importances(spark: SparkSession, d: str) -> DataFrame:
    canary = F.concat(F.lit("canary_"), (F.col("p_partkey") % 3).cast("string"))
    probe = F.col("p_partkey") % 7 == 0
    return (
        table(spark, d, "part")
        .groupBy(
            big(F.col("p_size") % 5).alias("model"), F.when(probe, canary).otherwise(F.col("p_brand")).alias("feature")
        )
        .agg(F.sum(cents("p_retailprice") * F.when(probe, 6).otherwise(10)).alias("gain"))
    )


def trials(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").select(
        F.col("p_partkey").alias("trial"),
        cents("p_retailprice").alias("value"),
        big(F.col("p_size") * 10).alias("best_iter"),
    )


def runs(spark: SparkSession, d: str) -> DataFrame:
    """Several seeds per trial."""
    return table(spark, d, "lineitem").select(
        F.col("l_partkey").alias("trial"),
        big("l_linenumber").alias("seed"),
        big("l_quantity").alias("best_iter"),
        cents("l_extendedprice").alias("plateau_gain"),
        (cents("l_extendedprice") + big("l_quantity")).alias("gain_max"),
        big(F.col("l_suppkey") * 10).alias("peak"),
    )


def summary(spark: SparkSession, d: str, flags: str) -> DataFrame:
    """Gain summary rows by (experiment, model) of the lines with these flags; different flags share some keys."""
    lines = table(spark, d, "lineitem").where(F.col("l_returnflag").isin(*flags))
    return lines.groupBy(
        F.concat(F.lit("exp_"), F.col("l_linenumber").cast("string")).alias("experiment"),
        F.concat(F.lit("m_"), F.col("l_partkey").cast("string")).alias("model"),
    ).agg(
        F.count(F.lit(1)).alias("k_opt"),
        F.sum(cents("l_extendedprice")).alias("gain_max"),
        F.lit(f"2024-01-0{2 if flags == 'R' else 1} 00:00:00").alias("updated"),
    )


def raw_text(spark: SparkSession, d: str) -> DataFrame:
    key = F.col("o_orderkey")

    def choice(n: int, *values: str) -> Column:
        out = F.lit(values[-1])
        for i, v in reversed(list(enumerate(values[:-1]))):
            out = F.when(key % n == i, v).otherwise(out)
        return out

    return table(spark, d, "orders").select(
        key.alias("id"),
        choice(5, " 12,5 ", "NULL", "junk", "", "7").alias("amount_txt"),
        choice(4, "S", "N", "si", "0").alias("flag_txt"),
        choice(3, "2021-03-04", "not a date", "1970-01-02").alias("fecha_txt"),
    )


_SNAP = """snap AS (SELECT p.*, CAST(s.s_nationkey AS bigint) AS s_nationkey FROM (
  SELECT l_suppkey AS id, CAST(year(l_shipdate)*100 + month(l_shipdate) AS bigint) AS period,
         count(*) AS n_lines, count(DISTINCT l_orderkey) AS n_orders,
         CAST(sum(CAST(l_quantity AS bigint)) AS bigint) AS q_units,
         CAST(sum(CAST(round(l_extendedprice*100) AS bigint)) AS bigint) AS m_price,
         CAST(sum(CASE WHEN l_returnflag='R' THEN CAST(round(l_extendedprice*100) AS bigint) ELSE 0 END) AS bigint)
           AS m_returned,
         CAST(sum(CASE WHEN l_linestatus='O' THEN 1 ELSE 0 END) AS bigint) AS n_open
  FROM lineitem GROUP BY 1, 2) p JOIN supplier s ON s.s_suppkey = p.id)"""

_SPARSE = """sparse AS (SELECT o_custkey AS id, CAST(year(o_orderdate)*100 + month(o_orderdate) AS bigint) AS period,
         count(*) AS n_orders, CAST(sum(CAST(round(o_totalprice*100) AS bigint)) AS bigint) AS m_price
  FROM orders GROUP BY 1, 2)"""


def _labels(name: str, panel: str) -> str:
    return f"""{name}_p0 AS (SELECT id, period, (period//100)*12 + period%100 AS p0 FROM {panel}),
{name}_leads AS (SELECT *, lead(p0, 1) OVER w AS p1, lead(p0, 2) OVER w AS p2 FROM {name}_p0
  WINDOW w AS (PARTITION BY id ORDER BY period)),
{name} AS (SELECT period, id, p0, p1, p2, CASE
    WHEN p0 < m - 1 AND p0 + 1 = p1 AND (p2 IS NULL OR p0 + 2 < p2) THEN 'BAJA+2'
    WHEN p0 < m AND (p1 IS NULL OR p0 + 1 < p1) THEN 'BAJA+1'
    WHEN p0 < m - 1 THEN 'CONTINUA' END AS label
  FROM {name}_leads, (SELECT max(p0) AS m FROM {name}_p0))"""


_SCORES = """scores AS (SELECT m.model, o.o_orderkey AS id,
       CAST(year(o.o_orderdate)*100 + month(o.o_orderdate) AS bigint) AS period,
       CASE WHEN o.o_orderkey % 60 = 0 THEN 'BAJA+2' WHEN o.o_orderkey % 60 = 1 THEN 'BAJA+1'
            WHEN o.o_orderkey % 60 = 2 THEN NULL ELSE 'CONTINUA' END AS label,
       CAST(((o.o_orderkey * 7919 + m.model * 104729) % 1000)
            + CASE WHEN o.o_orderkey % 60 = 0 THEN 300 ELSE 0 END AS bigint) AS score
  FROM orders o CROSS JOIN (SELECT unnest([1, 2, 3, 4, 5])::bigint AS model) m)"""

_DELTAS = "deltas AS (SELECT snap.*, {} FROM snap WINDOW w AS (PARTITION BY id ORDER BY period))".format(
    ", ".join(f"{c} - lag({c}, {k}) OVER w AS {c}_delta_{k}" for c in DELTA_FEATURES for k in range(1, 6))
)


def _summary(name: str, flags: str, stamp: str) -> str:
    return f"""{name} AS (SELECT concat('exp_', l_linenumber) AS experiment, concat('m_', l_partkey) AS model,
  count(*) AS k_opt, CAST(sum(CAST(round(l_extendedprice*100) AS bigint)) AS bigint) AS gain_max, '{stamp}' AS updated
  FROM lineitem WHERE l_returnflag IN ({', '.join(map(repr, flags))}) GROUP BY 1, 2)"""


_CTES = {
    "snap": ((), _SNAP),
    "sparse": ((), _SPARSE),
    "labels": (("snap",), _labels("labels", "snap")),
    "sparse_labels": (("sparse",), _labels("sparse_labels", "sparse")),
    "labelled": (
        ("labels",),
        "labelled AS (SELECT snap.*, labels.label FROM snap LEFT JOIN labels USING (id, period))",
    ),
    "deltas": (("snap",), _DELTAS),
    "scores": ((), _SCORES),
    "ranked": (
        ("scores",),
        """ranked AS (SELECT *, CASE WHEN label = 'BAJA+2' THEN 780000 ELSE -20000 END AS gain,
  row_number() OVER w AS rk,
  CAST(sum(CASE WHEN label = 'BAJA+2' THEN 780000 ELSE -20000 END) OVER w AS bigint) AS cum,
  coalesce(lag(score) OVER w, score) AS prev
  FROM scores WINDOW w AS (PARTITION BY model ORDER BY score DESC, id, period))""",
    ),
    "ensemble": (
        ("scores",),
        """ensemble AS (SELECT id, period, label, CAST(sum(score) AS bigint) / count(*) AS score, count(*) AS n_models
  FROM scores GROUP BY id, period, label)""",
    ),
    "ranked_mean": (
        ("ensemble",),
        """ranked_mean AS (SELECT *, row_number() OVER w AS rk,
  CAST(sum(CASE WHEN label = 'BAJA+2' THEN 780000 ELSE -20000 END) OVER w AS bigint) AS cum,
  coalesce(lag(score) OVER w, score) AS prev
  FROM ensemble WINDOW w AS (ORDER BY score DESC, id, period))""",
    ),
    "importances": (
        (),
        """importances AS (SELECT CAST(p_size % 5 AS bigint) AS model,
  CASE WHEN p_partkey % 7 = 0 THEN concat('canary_', p_partkey % 3) ELSE p_brand END AS feature,
  CAST(sum(CAST(round(p_retailprice*100) AS bigint) * CASE WHEN p_partkey % 7 = 0 THEN 6 ELSE 10 END) AS bigint) AS gain
  FROM part GROUP BY 1, 2)""",
    ),
    "mean_importances": (
        ("importances",),
        """mean_importances AS (SELECT feature, avg(gain) AS mean_gain,
  row_number() OVER (ORDER BY avg(gain) DESC, feature) AS rk FROM importances GROUP BY 1)""",
    ),
    "kept_features": (
        ("mean_importances",),
        """kept_features AS (SELECT feature FROM mean_importances WHERE rk < coalesce(
  (SELECT min(rk) FROM mean_importances WHERE feature LIKE '%canary%'), 1000000000))""",
    ),
    "trials": (
        (),
        """trials AS (SELECT p_partkey AS trial, CAST(round(p_retailprice*100) AS bigint) AS value,
  CAST(p_size*10 AS bigint) AS best_iter FROM part)""",
    ),
    "runs": (
        (),
        """runs AS (SELECT l_partkey AS trial, CAST(l_quantity AS bigint) AS best_iter,
  CAST(round(l_extendedprice*100) AS bigint) AS plateau_gain,
  CAST(round(l_extendedprice*100) AS bigint) + CAST(l_quantity AS bigint) AS gain_max,
  CAST(l_suppkey*10 AS bigint) AS peak FROM lineitem)""",
    ),
    "summary_old": ((), _summary("summary_old", "NA", "2024-01-01 00:00:00")),
    "summary_all": ((), _summary("summary_all", "NAR", "2024-01-01 00:00:00")),
    "summary_new": ((), _summary("summary_new", "R", "2024-01-02 00:00:00")),
    "raw_text": (
        (),
        """raw_text AS (SELECT o_orderkey AS id,
  CASE o_orderkey % 5 WHEN 0 THEN ' 12,5 ' WHEN 1 THEN 'NULL' WHEN 2 THEN 'junk' WHEN 3 THEN '' ELSE '7' END AS amount_txt,
  CASE o_orderkey % 4 WHEN 0 THEN 'S' WHEN 1 THEN 'N' WHEN 2 THEN 'si' ELSE '0' END AS flag_txt,
  CASE o_orderkey % 3 WHEN 0 THEN '2021-03-04' WHEN 1 THEN 'not a date' ELSE '1970-01-02' END AS fecha_txt
  FROM orders)""",
    ),
}


def sql(*needs: str, body: str) -> str:
    """``body`` after the named inputs and what they are built from."""
    chosen: list[str] = []

    def add(name: str) -> None:
        before, text = _CTES[name]
        for b in before:
            add(b)
        if text not in chosen:
            chosen.append(text)

    for n in needs:
        add(n)
    return f"WITH {', '.join(chosen)} {body}"


def r(expression: str, digits: int = 6) -> str:
    """SQL twin of ``rounded``."""
    return f"(round({expression}, {digits}) + 0.0)"
