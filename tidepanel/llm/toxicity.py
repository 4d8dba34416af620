"""Toxicity by a classifier chain.

Categories are predicted one after the other by logistic regressions over the presence of words and word beginnings; each also gets
the probabilities of the categories before it. It is trained on out-of-fold probabilities, so it sees earlier
predictions of the quality they will have on new texts. Folds are a hash of the key. The vocabulary holds the tokens that
are most associated with each category in the labelled sample.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegressionModel
from pyspark.ml.feature import CountVectorizerModel, VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepanel.llm.common import query, stored, table
from tidepanel.llm.linear import SAMPLE_ROWS, fit_logistic, labelled_sample, logit, with_probability

TOKENS_PER_CATEGORY = 1000
LEAST_DOCUMENTS = 3
BEGINNING = 4
FOLDS = 3
PENALTY = 5e-4  # of absolute weights: few words carry a category, chance company of rare words must not
THRESHOLD = 0.5


def with_tokens(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the distinct words of the lowered text and their beginnings; a null text has none."""
    words = F.array_distinct(F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), r"[^\p{L}\p{N}]+"))
    words = F.filter(words, lambda w: w != "")
    begun = F.array_distinct(F.transform(words, lambda w: F.concat(F.substring(w, 1, BEGINNING), F.lit("*"))))
    return docs.withColumn("tokens", words).withColumn("tokens", F.concat("tokens", begun))


def vocabulary(train: DataFrame, labels: list[str], size: int = TOKENS_PER_CATEGORY) -> list[str]:
    """The ``size`` tokens of highest chi-square with each label, of those in a few documents at least."""
    rows = train.select(F.explode("tokens").alias("token"), *labels)
    counts = rows.groupBy("token").agg(F.count(F.lit(1)).cast("double").alias("n"), *[F.sum(c).alias(c) for c in labels])
    counts = stored(counts.where(F.col("n") >= LEAST_DOCUMENTS), "token_counts")
    total = train.agg(F.count(F.lit(1)).alias("n"), *[F.coalesce(F.sum(c), F.lit(0.0)).alias(c) for c in labels]).first()
    chosen: set[str] = set()
    for c in labels:
        n, ones, both = F.col("n"), total[c], F.col(c)
        gap = both * (total.n - ones) - (n - both) * ones
        margins = F.greatest(n * (total.n - n) * ones * (total.n - ones), F.lit(1.0))
        ranked = counts.select("token", (total.n * gap * gap / margins).alias("x")).where("x > 0")
        chosen |= {r.token for r in ranked.orderBy(F.desc("x"), "token").limit(size).collect()}
    return sorted(chosen)


def _inputs(df: DataFrame, earlier: list[str]) -> DataFrame:
    """Words and the log odds of earlier categories as one vector."""
    odds = df.withColumns({f"_odds_{c}": logit(f"p_{c}") for c in earlier})
    names = ["words", *[f"_odds_{c}" for c in earlier]]
    return VectorAssembler(inputCols=names, outputCol="_inputs").transform(odds).drop(*names[1:])


@dataclass(frozen=True)
class Chain:
    words: CountVectorizerModel
    categories: list[str]
    models: list[LogisticRegressionModel | float]

    def predict(self, df: DataFrame) -> DataFrame:
        """``df`` (with tokens) and p_<category> for each category."""
        df = self.words.transform(df).drop("tokens")
        for i, (name, model) in enumerate(zip(self.categories, self.models)):
            df = with_probability(_inputs(df, self.categories[:i]), model, f"p_{name}", "_inputs").drop("_inputs")
        return df


def fit_chain(train: DataFrame, categories: dict[str, str], *, folds: int = FOLDS, penalty: float = PENALTY) -> Chain:
    """Chain over ``categories`` (name -> 0/1 column), in their order, on rows with tokens and a fold number."""
    names, models = list(categories), []
    known = vocabulary(train, sorted(set(categories.values()))) or ["*"]
    words = CountVectorizerModel.from_vocabulary(known, inputCol="tokens", outputCol="words").setBinary(True)
    train = words.transform(train).drop("tokens")
    for i, (name, label) in enumerate(categories.items()):
        inputs = stored(_inputs(train, names[:i]), "chain_inputs")
        models.append(fit_logistic(inputs, label, "_inputs", penalty=penalty, lasso=True))
        if i + 1 < len(names):
            outside = None
            for fold in range(folds):
                model = fit_logistic(inputs.where(F.col("fold") != fold), label, "_inputs", penalty=penalty, lasso=True)
                part = with_probability(inputs.where(F.col("fold") == fold), model, f"p_{name}", "_inputs")
                outside = part if outside is None else outside.unionByName(part)
            train = outside.drop("_inputs")
    return Chain(words, names, models)


def fit(docs: DataFrame, labels: DataFrame, categories: dict[str, str], *, sample: int = SAMPLE_ROWS) -> Chain:
    """Chain on about ``sample`` labelled documents at most."""
    columns = sorted(set(categories.values()))
    train = labelled_sample(docs.select("doc_id", "text"), labels, columns, sample)
    fold = F.pmod(F.xxhash64("doc_id", F.lit(2)), F.lit(FOLDS)).alias("fold")
    train = stored(with_tokens(train).select("doc_id", "tokens", fold, *columns), "chain_training")
    return fit_chain(train, categories)


def score(docs: DataFrame, chain: Chain, *, keep: tuple[str, ...] = ("doc_id",), threshold: float = THRESHOLD) -> DataFrame:
    """Columns ``keep`` of every row with p_<category> and is_<category>.

    A null or empty text has no words and gets the chain's base rates. Repeated rows are scored alike, an empty table gives no rows;
    other columns are ignored.
    """
    out = chain.predict(with_tokens(docs.select(*keep, "text")))
    flags = [(F.col(f"p_{c}") >= threshold).alias(f"is_{c}") for c in chain.categories]
    return out.select(*keep, *[f"p_{c}" for c in chain.categories], *flags)


@query()
def op1_toxicity_chain(spark: SparkSession, d: str) -> DataFrame:
    """Every document's probabilities of being junk and, given that, of being toxic."""
    docs, labels = table(spark, d, "documents"), table(spark, d, "labels")
    labels = labels.withColumn("junk", 1 - F.col("quality"))
    return score(docs, fit(docs, labels, {"junk": "junk", "toxic": "toxic"}))
