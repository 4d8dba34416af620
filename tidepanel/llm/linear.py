"""What the two trained classifiers share: a bounded labelled sample and logistic regression on vectors."""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SAMPLE_ROWS = 20_000
_PARTS = 1_000_003


def labelled_sample(docs: DataFrame, labels: DataFrame, columns: list[str], rows: int, key: str = "doc_id") -> DataFrame:
    """About ``rows`` labelled documents at most, drawn by a hash of the key: the same ones whatever the order.

    Labels of a key that occurs more than once are averaged and rounded; documents or labels without a key take no part.
    """
    known = labels.where(F.col(key).isNotNull()).groupBy(key).agg(
        *[F.round(F.avg(c)).cast("double").alias(c) for c in columns]
    )
    known = known.dropna(subset=columns)
    n = known.count()
    if n > rows:
        known = known.where(F.pmod(F.xxhash64(key, F.lit(1)), F.lit(_PARTS)) < int(_PARTS * rows / n))
    return docs.join(known, key)


def fit_logistic(train: DataFrame, label: str, features: str = "features", *, penalty: float, lasso: bool = False, rounds: int = 40) -> LogisticRegressionModel | float:
    """A model with an L2 or (lasso) L1 penalty, or the label's only value if it has one (0 without rows)."""
    low, high = train.agg(F.min(label), F.max(label)).first()
    if low is None or low == high:
        return float(low or 0.0)
    shape = LogisticRegression(featuresCol=features, labelCol=label, maxIter=rounds, tol=1e-5)
    return shape.setRegParam(penalty).setElasticNetParam(float(lasso)).fit(train)


def with_probability(df: DataFrame, model: LogisticRegressionModel | float, name: str, features: str = "features") -> DataFrame:
    """``df`` with the probability of label 1."""
    if isinstance(model, float):
        return df.withColumn(name, F.lit(model))
    model = model.copy().setFeaturesCol(features).setPredictionCol("").setRawPredictionCol("").setProbabilityCol("_both")
    return model.transform(df).withColumn(name, vector_to_array("_both")[1]).drop("_both")


def logit(p: Column | str) -> Column:
    """Log odds, finite at 0 and 1."""
    p = F.col(p) if isinstance(p, str) else p
    p = F.least(F.greatest(p, F.lit(1e-6)), F.lit(1 - 1e-6))
    return F.log(p / (1 - p))
