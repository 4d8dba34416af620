"""Document quality by hierarchical empirical Bayes over sites.

A document classifier on surface statistics gives every document a probability of being good. These, or the label where there is one,
are summed by host and by path of a host. A host's posterior mean shrinks towards the global mean, a path's
towards its host's, each by a prior strength estimated from the spread of the group means (method of moments), so sparse sites
fall back to the level above. The path's posterior shifts the log odds of its documents.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegressionModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepanel.llm.common import query, stored, table
from tidepanel.llm.linear import SAMPLE_ROWS, fit_logistic, labelled_sample, logit, with_probability

KEEP_FROM = 0.5
PENALTY = 1e-4
SITE_WEIGHT = 0.25  # of the site's shift: most of it is already in the documents' own evidence
MIN_STRENGTH, MAX_STRENGTH = 1.0, 1e6
SYMBOLS = "%$#&*!|{}<>=~^\\"
FEATURES = ["symbols", "capitals", "digits", "repeated", "word_length", "length", "sentences"]


def features(docs: DataFrame, text: str = "text") -> DataFrame:
    """Surface statistics of each text, from built-in expressions; a null text counts as empty."""
    t = F.coalesce(F.col(text), F.lit(""))
    n = F.greatest(F.length(t), F.lit(1))

    def share(characters: str) -> Column:
        return (F.length(t) - F.length(F.translate(t, characters, ""))) / n

    words = F.filter(F.split(t, r"\s+"), lambda w: w != "")
    out = docs.withColumns({"_words": words})
    n_words = F.greatest(F.size("_words"), F.lit(1))
    return out.withColumns(
        {
            "symbols": F.sqrt(share(SYMBOLS)),
            "capitals": F.sqrt(share("ABCDEFGHIJKLMNOPQRSTUVWXYZÄÖÜÉÈÊÇÑÓÍ")),
            "digits": F.sqrt(share("0123456789")),
            "repeated": 1 - F.size(F.array_distinct("_words")) / n_words,
            "word_length": F.log1p(n / n_words),
            "length": F.log1p(F.size("_words")),
            "sentences": F.sqrt(share(".!?\n")),
        }
    ).drop("_words")


@dataclass(frozen=True)
class QualityModel:
    classifier: LogisticRegressionModel | float

    def evidence(self, docs: DataFrame, name: str = "p_doc") -> DataFrame:
        """``docs`` with the classifier's probability of being good."""
        vector = VectorAssembler(inputCols=FEATURES, outputCol="_features").transform(features(docs))
        return with_probability(vector, self.classifier, name, "_features").drop("_features", *FEATURES)


def fit(docs: DataFrame, labels: DataFrame, *, sample: int = SAMPLE_ROWS) -> QualityModel:
    """Classifier on about ``sample`` labelled documents at most."""
    train = labelled_sample(docs.select("doc_id", "text"), labels, ["quality"], sample)
    vector = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(features(train))
    train = stored(vector.select("features", "quality"), "quality_training")
    return QualityModel(fit_logistic(train, "quality", penalty=PENALTY))


def _strength(groups: DataFrame, mean: float) -> float:
    """Prior rows of a beta distribution whose spread explains the groups' means beyond chance."""
    x = F.col("good") / F.col("n")
    row = groups.agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("k"), F.sum(F.col("n") * (x - mean) ** 2).alias("ss"), F.sum(F.col("n") ** 2).alias("n2")
    ).first()
    if not row.n or row.k < 2:
        return MAX_STRENGTH
    between = (row.ss - (row.k - 1) * mean * (1 - mean)) / max(row.n - row.n2 / row.n, 1e-9)
    if between <= 0:
        return MAX_STRENGTH
    return min(max(mean * (1 - mean) / between - 1, MIN_STRENGTH), MAX_STRENGTH)


def site_posteriors(scored: DataFrame) -> tuple[DataFrame, float]:
    """(host, path, host_posterior, path_posterior) from rows (host, path, good), and the global mean.

    Three grouped aggregations with partial sums; a host with a third of all rows is a few sums a task.
    """
    paths = scored.groupBy("host", "path").agg(F.sum("good").alias("good"), F.count(F.lit(1)).cast("double").alias("n"))
    paths = stored(paths, "site_counts")
    hosts = paths.groupBy("host").agg(F.sum("good").alias("good"), F.sum("n").alias("n"))
    total = paths.agg(F.sum("good").alias("good"), F.sum("n").alias("n")).first()
    mean = total.good / total.n if total.n else 0.5
    by_host, by_path = _strength(hosts, mean), _strength(paths, mean)
    hosts = hosts.select("host", ((F.col("good") + by_host * mean) / (F.col("n") + by_host)).alias("host_posterior"))
    joined = paths.join(hosts, "host")
    shrunk = (F.col("good") + by_path * F.col("host_posterior")) / (F.col("n") + by_path)
    return joined.select("host", "path", "host_posterior", shrunk.alias("path_posterior")), mean


def assess(docs: DataFrame, labels: DataFrame, model: QualityModel, *, host: Column, path: Column, site_weight: float = SITE_WEIGHT, store: bool = True) -> DataFrame:
    """``docs`` with p_doc, host_posterior, path_posterior, quality (combined probability) and keep.

    A null host or path is the empty one. Labels count as evidence for the site only, not for their own document. Null and
    empty texts are judged by their statistics, repeated rows alike, texts of any length whole; an empty table gives no rows. Columns of
    these names are replaced. The texts with their evidence are written once, or, without ``store``, judged twice instead.
    """
    sites = [F.coalesce(c.cast("string"), F.lit("")).alias(n) for c, n in ((host, "_host"), (path, "_path"))]
    inner = [c if c in ("doc_id", "text") else f"_{i}" for i, c in enumerate(docs.columns)]  # any names are fine
    at = docs.select(*sites, "*").toDF("host", "path", *inner)
    known = labels.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.avg("quality").alias("_label"))
    scored = stored(model.evidence(at), "evidence") if store else model.evidence(at)
    good = scored.select("doc_id", "host", "path", "p_doc").join(known, "doc_id", "left")
    posteriors, mean = site_posteriors(good.select("host", "path", F.coalesce("_label", "p_doc").alias("good")))
    out = scored.join(posteriors, ["host", "path"])
    odds = logit("p_doc") + F.lit(site_weight) * (logit("path_posterior") - logit(F.lit(mean)))
    out = out.withColumn("quality", 1 / (1 + F.exp(-odds))).withColumn("keep", F.col("quality") >= KEEP_FROM)
    added = ["host", "path", "p_doc", "host_posterior", "path_posterior", "quality", "keep"]
    kept = [(i, c) for i, c in zip(inner, docs.columns) if c not in added]
    return out.select(*[F.col(i).alias(c) for i, c in kept], *added)


@query()
def op2_quality_sites(spark: SparkSession, d: str) -> DataFrame:
    """Quality of every document; its source is the host, the source's texts of a language a path."""
    docs, labels = table(spark, d, "documents"), table(spark, d, "labels")
    found = assess(docs, labels, fit(docs, labels), host=F.col("source"), path=F.concat_ws("/", "source", "lang"))
    return found.select("doc_id", "host", "path", "p_doc", "host_posterior", "path_posterior", "quality", "keep")
