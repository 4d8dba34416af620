"""Sampling, splits, scenarios and model jobs."""

from pyspark.sql import functions as F

from catalog.inputs import MEASURES, SNAP_COLUMNS, TOP, importances, labelled, r, rounded, scores, snap, sql
from catalog.registry import query
from tidepanel.functions.features import binary_target, class_weight
from tidepanel.operators import history, sampling, selection
from tidepanel.operators import trials as trial_tables
from tidepanel.operators.labels import with_gap_label
from tidepanel.operators.scalars import with_scalars
from tidepanel.plans import models, runs, stages
from tidepanel.sources import tables
from tidepanel.sources.scratch import fresh_path, materialise

SEED, RATE = 7, 0.2
TRAIN = [y * 100 + m for y in range(1995, 2000) for m in range(1, 13)]
TEST = [199912, 200001, 200002, 200003, 200004, 200005, 200006]
PREDICTION = [200007]


def _uniform(*parts: str) -> str:
    text = ", ".join(parts)
    return f"((CAST('0x' || substr(md5(concat_ws('|', {text})), 1, 8) AS bigint) % 1000000) / 1000000.0::double)"


_SAMPLED = f"{_uniform('id', f'{SEED!r}')} <= {RATE}::double"


@query(
    sql(
        "labelled",
        body=f"""SELECT id, period, label FROM labelled
  WHERE label <> 'CONTINUA' OR (label = 'CONTINUA' AND {_SAMPLED})""",
    )
)
def hash_undersample(spark, d):
    return sampling.hash_undersample(labelled(spark, d), RATE, SEED).select("id", "period", "label")


def _months(months) -> str:
    return "(" + ", ".join(map(str, months)) + ")"


@query(
    sql(
        "labelled",
        body=f"""SELECT id, period, label, split, y, w FROM (SELECT *,
    CASE WHEN label IN ('BAJA+1', 'BAJA+2') THEN 1 WHEN label = 'CONTINUA' THEN 0 END::bigint AS y,
    CASE WHEN label = 'BAJA+2' THEN 1.00002::double WHEN label = 'BAJA+1' THEN 1.00001::double
      ELSE 1.0::double END AS w FROM (
    SELECT *, 'train' AS split FROM labelled WHERE period IN {_months(TRAIN)}
      AND (label <> 'CONTINUA' OR (label = 'CONTINUA' AND {_SAMPLED}))
    UNION ALL SELECT *, 'test' FROM labelled WHERE period IN {_months(TEST)}
    UNION ALL SELECT *, 'pred' FROM labelled WHERE period IN {_months(PREDICTION)}))""",
    )
)
def period_split(spark, d):
    found = sampling.period_split(labelled(spark, d), TRAIN, TEST, PREDICTION, rate=RATE, seed=SEED)
    return found.select("id", "period", "label", "split", "y", "w")


@query(sql("labelled", body=f"SELECT id, period, label, period IN {_months(TEST)} AS is_validation FROM labelled"))
def period_holdout(spark, d):
    return sampling.period_holdout(labelled(spark, d), TEST).select("id", "period", "label", "is_validation")


@query(
    sql(
        "labelled",
        body="""SELECT id, period, m_price, m_price_lag1, m_price_delta1 FROM (SELECT *,
  lag(m_price) OVER w AS m_price_lag1, m_price - lag(m_price) OVER w AS m_price_delta1
  FROM labelled WINDOW w AS (PARTITION BY id ORDER BY period)) WHERE period = 200007""",
    )
)
def prediction_frame(spark, d):
    path = fresh_path(spark, "features")
    panel = labelled(spark, d).select("id", "period", "m_price", "label")
    both = history.delta_features(history.lag_features(panel, ["m_price"], 3), ["m_price"], 3)
    tables.write_period_table(both, path)
    found = stages.prediction_frame(spark, path, 200007, 1)
    return found.select("id", "period", "m_price", "m_price_lag1", "m_price_delta1")


SCENARIOS = [
    stages.Scenario("first_group", 199607, ("a",)),
    stages.Scenario("all_groups", 199607, ("a", "b")),
    stages.Scenario("later_month", 199801, ("a", "b")),
]
SENDS = 40


@query(
    sql(
        "scores",
        body=f"""SELECT scenario, id, period, score, CASE WHEN rk <= {SENDS} THEN 1 ELSE 0 END::bigint AS predicted FROM (
  SELECT *, row_number() OVER (PARTITION BY scenario ORDER BY score DESC, id, period) AS rk FROM (
    SELECT scenario, id, s.period, sum(score)::bigint / count(*) AS score
    FROM scores s JOIN (VALUES ('first_group', 199607, 'a'), ('all_groups', 199607, 'a'), ('all_groups', 199607, 'b'),
      ('later_month', 199801, 'a'), ('later_month', 199801, 'b')) AS c(scenario, period, experiment)
    ON s.period = c.period AND c.experiment = CASE WHEN model <= 2 THEN 'a' ELSE 'b' END GROUP BY 1, 2, 3))""",
    )
)
def scenario_predictions(spark, d):
    tagged = scores(spark, d).withColumn("experiment", F.when(F.col("model") <= 2, "a").otherwise("b"))
    return stages.scenario_predictions(tagged, SCENARIOS, SENDS)


CANARIES = 20


def _uniform_word(i: int) -> str:
    digest = f"sha256(concat_ws('|', id, period, '42:{i // 8}'))"
    return f"(CAST('0x' || substr({digest}, {8 * (i % 8) + 1}, 8) AS bigint) / 4294967296.0::double)"


_SOURCES = selection.canary_sources([*MEASURES, "s_nationkey"], CANARIES, 42)
_NOISE = ", ".join(
    f"""{r(f"(SELECT min({c})::double FROM snap) + ((SELECT max({c})::double FROM snap) - (SELECT min({c})::double FROM snap))"
           f" * {_uniform_word(i)}")} AS canary_{i}"""
    for i, c in enumerate(_SOURCES)
)


@query(sql("snap", body=f"SELECT {', '.join(SNAP_COLUMNS)}, {_NOISE} FROM snap"))
def add_canaries(spark, d):
    found = selection.add_canaries(snap(spark, d), CANARIES)
    return rounded(found, 6, *[f"canary_{i}" for i in range(CANARIES)])


@query(
    sql(
        "importances",
        body="""SELECT model, feature, gain FROM (SELECT *, min(CASE WHEN feature LIKE '%canary%' THEN rk END)
    OVER (PARTITION BY model) AS b FROM (
      SELECT *, row_number() OVER (PARTITION BY model ORDER BY gain DESC, feature) AS rk FROM importances))
  WHERE rk < b OR b IS NULL""",
    )
)
def canary_cut(spark, d):
    return selection.canary_cut(importances(spark, d), group=["model"])


FEATURES = [*MEASURES, "s_nationkey", "m_price_lag1", "m_price_delta1", "q_units_lag1", "q_units_delta1"]
# All five parameters, and rounds enough for patience to act; depth and leaf size fit the small panel.
SEARCH = models.SEARCH_SPACE | {"maxDepth": ("int", 2, 4), "minInstancesPerNode": ("int", 5, 50), "stepSize": ("log", 0.05, 0.5)}
TRIALS, SEEDS, ROUNDS, PATIENCE = 2, [1, 2], 24, 3
_TRAINED = f"period IN ({', '.join(map(str, TRAIN))}) AND label IS NOT NULL"


def _training_frame(spark, d):
    """Labelled panel with short history, targets, and a column that follows the target three times out of four. Written once: a job reads it
    several times."""
    # The label also needs the last month of all.
    known = with_gap_label(materialise(snap(spark, d)))
    panel = history.historical_features(known, ["m_price", "q_units"], lags=1, statistics=[])
    y = binary_target(F.col("label"))
    noise = sampling.hashed_uniform(F.col("id"), F.col("period"), F.lit("planted"))
    planted = F.when(noise < 0.75, F.coalesce(y, F.lit(0))).otherwise(1 - F.coalesce(y, F.lit(0))) + noise
    return materialise(panel.withColumns({"y": y, "w": class_weight(F.col("label"), 1.0), "planted": planted}))


def _search(frame):
    return models.hyperparameter_trials(
        frame.where(F.col("period").isin([m for m in TRAIN if m not in TEST])),
        frame.where(F.col("period").isin(TEST)),
        FEATURES,
        n_trials=TRIALS,
        seeds=SEEDS,
        rounds=ROUNDS,
        patience=PATIENCE,
        half_width=50,
        space=SEARCH,
        parallelism=2,
    )


def _ensemble(spark, frame, seeds):
    """Models of the trials that a search returned, best first."""
    best = trial_tables.top_trials(_search(frame), TRIALS)
    known = frame.where(F.col("period").isin(TRAIN))
    return models.train_seed_ensemble(known, FEATURES, best, seeds, fresh_path(spark, "models"), parallelism=2)


@query(
    sql(
        "labelled",
        body="SELECT count(label) AS n_rows, TRUE AS planted_kept, CAST(0 AS bigint) AS canaries_kept FROM labelled",
    )
)
def canary_selection(spark, d):
    """The selection of the published job, on features among which one is known to matter: it stays, no canary does."""
    columns = [*FEATURES, "planted"]
    frame = _training_frame(spark, d).select("id", "period", *columns, "y", "w")
    kept = models.canary_selection(frame, columns, n=CANARIES, rounds=150)
    facts = kept.agg(
        F.coalesce(F.bool_or(F.col("feature") == "planted"), F.lit(False)).alias("planted_kept"),
        F.count(F.when(selection.is_canary(), 1)).alias("canaries_kept"),
    )
    return with_scalars(frame.agg(F.count("y").alias("n_rows")), facts)


@query(
    sql(
        "labelled",
        body=f"""SELECT rank, seed, n_rows, TRUE AS has_its_trees, TRUE AS separates
  FROM (SELECT unnest(range(1, {TRIALS + 1})) AS rank), (SELECT unnest({SEEDS})::bigint AS seed),
  (SELECT count(*) AS n_rows FROM labelled WHERE {_TRAINED})""",
    )
)
def train_seed_ensemble(spark, d):
    """Facts about the fits: trees as asked for, and a higher mean score on rows with the target than on those without."""
    frame = _training_frame(spark, d)
    scorers, metadata = _ensemble(spark, frame, SEEDS)
    known = frame.where(F.col("period").isin(TRAIN) & F.col("y").isNotNull())
    scored = models.score_models(known, scorers, keep=["y"])
    means = [F.avg(F.when(F.col("y") == y, F.col("score"))) for y in (1, 0)]
    facts = scored.groupBy("model").agg(F.count(F.lit(1)).alias("n_rows"), (means[0] > means[1]).alias("separates"))
    trees = spark.createDataFrame([(s.name, s.model.getNumTrees) for s in scorers], "model string, trees int")
    named = metadata.withColumn("model", F.concat(F.lit("top"), "top_rank", F.lit("_seed_"), "seed"))
    return named.join(facts, "model").join(trees, "model").select(
        F.col("top_rank").alias("rank"), "seed", "n_rows", (F.col("trees") == F.col("best_iter")).alias("has_its_trees"), "separates"
    )


@query(
    sql(
        "labelled",
        body=f"""SELECT id, period, concat('top', rank, '_seed_1') AS model, TRUE AS in_range
  FROM labelled, (SELECT unnest(range(1, {TRIALS + 1})) AS rank)""",
    )
)
def score_models(spark, d):
    """Every row scored by every model; the scores are probabilities."""
    frame = _training_frame(spark, d)
    scorers, _ = _ensemble(spark, frame, [1])
    found = models.score_models(frame, scorers)
    return found.select("id", "period", "model", F.col("score").between(0, 1).alias("in_range"))


@query(
    sql(
        "labelled",
        body=f"""SELECT trial, CAST({len(SEEDS)} AS bigint) AS seeds, TRUE AS rounds_in_range, TRUE AS plateau_below_peak, TRUE AS peak_in_list
  FROM (SELECT unnest(range(0, {TRIALS})) AS trial)""",
    )
)
def hyperparameter_trials(spark, d):
    """One row a trial: rounds within the limit, the plateau not above the peak, the peak within the holdout."""
    frame = _training_frame(spark, d)
    held = frame.where(F.col("period").isin(TEST)).agg(F.count(F.lit(1)).alias("n"))
    return with_scalars(_search(frame), held).select(
        "trial",
        "seeds",
        F.col("best_iter").between(1, ROUNDS).alias("rounds_in_range"),
        (F.col("value") <= F.col("gain_max")).alias("plateau_below_peak"),
        F.col("peak").between(0, F.col("n") - 1).alias("peak_in_list"),
    )


@query()
def search_values(spark, d):
    """The search itself: value, rounds, profit and parameters of every trial."""
    return _search(_training_frame(spark, d))


@query()
def round_profits(spark, d):
    """Highest profit and plateau on the test months after every round of one fit."""
    frame = _training_frame(spark, d)
    kept = ["id", "period", "label", "y", "w"]
    train = models.with_vector(frame.where(F.col("period").isin([m for m in TRAIN if m not in TEST]) & F.col("y").isNotNull()), FEATURES, kept)
    held = materialise(models.with_vector(frame.where(F.col("period").isin(TEST)), FEATURES, kept))
    model = models.classifier(models.sample_params(0, 0, SEARCH), ROUNDS, SEEDS[0]).fit(materialise(train.select("y", "w", models.VECTOR)))
    return models.round_profits(held, model, half_width=50)


@query()
def ensemble_scores(spark, d):
    """Scores of the test months by every model of the trained ensemble."""
    frame = _training_frame(spark, d)
    scorers, _ = _ensemble(spark, frame, SEEDS)
    return models.score_models(frame.where(F.col("period").isin(TEST)), scorers)


@query()
def selected_features(spark, d):
    """Features that rank above every canary, with their gain."""
    columns = [*FEATURES, "planted"]
    return models.canary_selection(_training_frame(spark, d).select("id", "period", *columns, "y", "w"), columns, n=CANARIES, rounds=150)


@query()
def staged_runs(spark, d):
    """Features chosen, models trained and the month after predicted, each run on what the one before left: (id, Predicted)."""
    path, work = fresh_path(spark, "feature_table"), runs.Workspace(fresh_path(spark, "study"))
    tables.write_period_table(_training_frame(spark, d).drop("y", "w"), path)
    train = [m for m in TRAIN if m not in TEST]
    runs.selection_run(spark, path, work, train, rate=RATE, seed=SEED, canaries=5, rounds=10)
    runs.training_run(
        spark, path, work, "study", train=train, validation=TEST[:3], test=TEST[3:], trials=TRIALS, seeds=SEEDS[:1], final_seeds=SEEDS, top=1,
        rate=RATE, seed=SEED, rounds=8, patience=2, half_width=50, floor=0, ceiling=TOP, space=SEARCH,
    )
    sent = runs.prediction_run(spark, path, work, "next", period=PREDICTION[0], experiments=["study"], k=SENDS)
    return spark.read.csv(sent, header=True, schema="id bigint, Predicted bigint")
