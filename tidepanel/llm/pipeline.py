"""The corpus pipeline: five stages over ``documents``, each written as Parquet and read by the next."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepanel.llm import quality
from tidepanel.llm.common import remove, stored, table
from tidepanel.llm.decontamination import decontaminate
from tidepanel.llm.jaccard import keep_one
from tidepanel.llm.packing import pack
from tidepanel.llm.pii import QUERY_KEY, pseudonymise

LEAST_WORDS = 8
Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def reject_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality model does not reject."""
    labels = table(spark, sf_dir, "labels")
    names = [f"_{i}_{c}" for i, c in enumerate(docs.columns)]  # the assessment adds columns of its own
    inner = docs.toDF(*names)
    inner = inner.select("*", *[F.col(names[docs.columns.index(c)]).alias(c) for c in ("doc_id", "text", "source", "lang")])
    model = quality.fit(inner, labels)
    found = quality.assess(inner, labels, model, host=F.col("source"), path=F.concat_ws("/", "source", "lang"), store=False)
    return found.where("keep").select(names).toDF(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: five-word shingles, Jaccard similarity of 0.8 or more."""
    return keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark; items too short to tell a passage from chance are named in a warning."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"), least_words=LEAST_WORDS)


def replace_personal_values(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal values as pseudonyms."""
    return pseudonymise(docs, QUERY_KEY)


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in windows, mixed by source."""
    return pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality", reject_low_quality),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("pseudonyms", replace_personal_values),
    ("packing", pack_windows),
]
# Model fits, fingerprints and token ids have no SQL; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for the documents of a folder. A stage's output goes when the next one is written."""
    docs = table(spark, sf_dir, "documents")
    made: list[str] = []
    for name, stage in STAGES:
        before, made = made, []
        docs = stored(stage(spark, docs, sf_dir), name, made)
        remove(spark, before)
    return docs
