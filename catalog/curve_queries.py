"""Gain curves, cuts and top-k lists."""

from pyspark.sql import functions as F

from catalog.inputs import (
    CEILING,
    FLOOR,
    HALF_WIDTH,
    TOP,
    ensemble,
    importances,
    scores,
    sql,
    summary,
    trials,
)
from catalog.registry import query
from tidepanel.operators import curves, selection
from tidepanel.operators import trials as trial_tables
from tidepanel.operators.ranking import rank


@query(sql("ranked", body="SELECT model, id, period, score, gain::bigint AS gain, rk, cum FROM ranked"))
def cumulative_gain(spark, d):
    return curves.cumulative_gain(curves.ranked_profit(scores(spark, d)))


@query(
    sql(
        "ranked",
        body=f"""SELECT model, id, period, score, gain::bigint AS gain, (rk - 1)::bigint AS k, cum FROM ranked
  WHERE rk > {FLOOR} AND rk <= {CEILING}""",
    )
)
def gain_curve_segment(spark, d):
    return curves.gain_curve_segment(curves.ranked_profit(scores(spark, d)), FLOOR, CEILING)


_BEST = """SELECT {keep} (rk - 1)::bigint AS k_opt, cum AS gain_max, prev AS thr_opt FROM (
  SELECT *, row_number() OVER ({part} ORDER BY cum DESC, rk) AS best FROM {table} WHERE rk > {lo} AND rk <= {hi})
  WHERE best = 1"""


@query(
    sql("ranked", body=_BEST.format(keep="model,", part="PARTITION BY model", table="ranked", lo=FLOOR, hi=CEILING))
)
def best_cut(spark, d):
    return curves.best_cut(curves.ranked_profit(scores(spark, d)), FLOOR, CEILING)


_TEXT_IDS = """texts AS (SELECT model, concat('c', id) AS id, period, label, CAST(score // 100 AS decimal(12, 2)) AS score FROM base),
text_ranked AS (SELECT *, row_number() OVER w AS rk, coalesce(lag(score) OVER w, score) AS prev,
  CAST(sum(CASE WHEN label = 'BAJA+2' THEN 780000 ELSE -20000 END) OVER w AS bigint) AS cum
  FROM texts WINDOW w AS (PARTITION BY model ORDER BY score DESC, id, period))"""


def _text_sql(body: str) -> str:
    return f"WITH base AS ({sql('scores', body='SELECT * FROM scores')}), {_TEXT_IDS} {body}"


def _text_ids(spark, d):
    """Text ids, and decimal scores that very many rows share."""
    score = F.floor(F.col("score") / 100).cast("decimal(12,2)").alias("score")
    rows = scores(spark, d).select("model", F.concat(F.lit("c"), "id").alias("id"), "period", "label", score)
    return curves.ranked_profit(rows)


@query(_text_sql("SELECT model, id, period, rk, cum FROM text_ranked"))
def cumulative_gain_text_ids(spark, d):
    return curves.cumulative_gain(_text_ids(spark, d)).select("model", "id", "period", "rk", "cum")


@query(
    _text_sql(
        _BEST.format(keep="model,", part="PARTITION BY model", table="text_ranked", lo=FLOOR, hi=CEILING).replace(
            "prev AS thr_opt", "CAST(prev AS double) AS thr_opt"
        )
    )
)
def best_cut_decimal_scores(spark, d):
    found = curves.best_cut(_text_ids(spark, d), FLOOR, CEILING)
    return found.withColumn("thr_opt", F.col("thr_opt").cast("double"))


@query(sql("ranked_mean", body=_BEST.format(keep="", part="", table="ranked_mean", lo=FLOOR, hi=CEILING)))
def ensemble_best_cut(spark, d):
    return curves.best_cut(curves.ranked_profit(ensemble(spark, d), group=()), FLOOR, CEILING)


@query(
    sql(
        "ranked",
        body="""SELECT model, rk AS k_max, cum AS gain_max FROM (
  SELECT *, row_number() OVER (PARTITION BY model ORDER BY cum DESC, rk) AS best FROM ranked) WHERE best = 1""",
    )
)
def max_gain_full(spark, d):
    return curves.max_gain(curves.ranked_profit(scores(spark, d)))


@query(
    sql(
        "ranked",
        body=f"""SELECT r.model, (round(avg(r.cum), 4) + 0.0) AS plateau_gain, max(p.rk - 1)::bigint AS peak,
  max(p.cum) AS gain_max FROM ranked r JOIN (
    SELECT *, row_number() OVER (PARTITION BY model ORDER BY cum DESC, rk) AS best FROM ranked) p
  ON p.best = 1 AND p.model = r.model AND r.rk - 1 >= p.rk - 1 - {HALF_WIDTH} AND r.rk - 1 < p.rk - 1 + {HALF_WIDTH}
  GROUP BY r.model""",
    )
)
def plateau_gain(spark, d):
    found = curves.plateau_gain(curves.ranked_profit(scores(spark, d)), HALF_WIDTH)
    return found.withColumn("plateau_gain", F.round("plateau_gain", 4) + F.lit(0.0))


@query(
    sql(
        "ranked_mean",
        body=f"""SELECT id, period, label, score, n_models, CASE WHEN rk <= {TOP} THEN 1 ELSE 0 END::bigint AS predicted
  FROM ranked_mean""",
    )
)
def topk_flag(spark, d):
    return curves.topk_flag(rank(ensemble(spark, d), "score"), TOP)


PICKED = [1, 3, 8, 40]
_RANKED_TRIALS = "(SELECT *, row_number() OVER (ORDER BY value DESC, trial) AS rank FROM trials)"


@query(sql("trials", body=f"SELECT trial, value, best_iter, rank FROM {_RANKED_TRIALS} WHERE rank <= 20"))
def trial_rank_topk(spark, d):
    return trial_tables.top_trials(trials(spark, d), 20)


@query(
    sql(
        "trials",
        body=f"""SELECT concat('top', rank, '_seed_', trial) AS model, trial, value, best_iter, rank
  FROM {_RANKED_TRIALS} WHERE rank IN (1, 3, 8, 40)""",
    )
)
def trial_rank_select(spark, d):
    """Trials of hand-picked ranks, then model names filtered by the rank written in them."""
    best = trial_tables.top_trials(trials(spark, d), max(PICKED))
    name = F.concat(F.lit("top"), F.col("rank"), F.lit("_seed_"), F.col("trial")).alias("model")
    named = best.select(name, "trial", "value", "best_iter")
    picked = trial_tables.pick_trials(trials(spark, d), PICKED).select("trial", "rank")
    return trial_tables.pick_models(named, PICKED).join(picked, "trial").select(
        "model", "trial", "value", "best_iter", "rank"
    )


@query(sql("mean_importances", body="SELECT feature, mean_gain FROM mean_importances WHERE rk <= 20"))
def importance_topk(spark, d):
    return selection.importance_topk(selection.importance_mean(importances(spark, d)), 20, gain="mean_gain")


@query(
    sql(
        "summary_all",
        body="""SELECT experiment, model, k_opt, gain_max, updated FROM summary_all
  ORDER BY gain_max DESC, experiment, model, k_opt, updated LIMIT 5""",
    )
)
def summary_ranked(spark, d):
    return trial_tables.summary_ranked(summary(spark, d, "NAR"), 5)
