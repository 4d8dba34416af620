"""Language identification by nearest centroid.

A text is a vector of hashed byte n-grams (one to three bytes of the lowered text, blanks for everything that
is no letter), weighted by (1 + log count) * idf and normalised. Document frequencies come from all training rows. Each
language gets several centroids by spherical k-means on a bounded, hashed sample of its rows; a text goes to the language
of the centroid with the highest cosine, and is marked as rejected if that is farther than almost all of the
centroid's own sample.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidepanel.llm.common import query, table, texts

BUCKETS = 4096
CENTROIDS = 4
SAMPLE_PER_LANGUAGE = 800
REJECTED_SHARE = 0.001
UNKNOWN = "und"

_FOLD = bytes(c if c >= 0x80 or chr(c).isalpha() else 0x20 for c in range(256))


def gram_counts(rows: list[str]) -> np.ndarray:
    """Rows of hashed n-gram counts."""
    out = np.zeros((len(rows), BUCKETS), np.float32)
    for i, text in enumerate(rows):
        raw = np.frombuffer(b" " + text.lower().encode().translate(_FOLD) + b" ", np.uint8).astype(np.uint32)
        pairs = raw[:-1] | raw[1:] << np.uint32(8)
        triples = pairs[:-1] | raw[2:] << np.uint32(16)
        total = np.bincount(raw * np.uint32(0x9E3779B1) >> np.uint32(20), minlength=BUCKETS)
        total += np.bincount((pairs | np.uint32(1 << 24)) * np.uint32(0x9E3779B1) >> np.uint32(20), minlength=BUCKETS)
        total += np.bincount((triples | np.uint32(2 << 24)) * np.uint32(0x9E3779B1) >> np.uint32(20), minlength=BUCKETS)
        out[i] = total
    return out


def vectors(rows: list[str], idf: np.ndarray) -> np.ndarray:
    """Normalised TF-IDF vectors of texts; zero without n-grams of any weight."""
    counts = gram_counts(rows)
    found = np.where(counts > 0, 1 + np.log(np.maximum(counts, 1)), 0).astype(np.float32) * idf
    length = np.linalg.norm(found, axis=1, keepdims=True)
    return found / np.where(length > 0, length, 1)


def cluster(points: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Spherical k-means; starts from the points farthest from those chosen before, so it is deterministic."""
    chosen = [points.mean(axis=0)]
    nearest = points @ chosen[0]
    centres = [points[int(nearest.argmin())]]
    best = points @ centres[0]
    while len(centres) < min(k, len(points)):
        centres.append(points[int(best.argmin())])
        best = np.maximum(best, points @ centres[-1])
    centres = np.stack(centres)
    for _ in range(rounds):
        of = (points @ centres.T).argmax(axis=1)
        for c in range(len(centres)):
            if (of == c).any():
                centre = points[of == c].mean(axis=0)
                centres[c] = centre / max(np.linalg.norm(centre), 1e-12)
    return centres


@dataclass(frozen=True)
class Centroids:
    """A fitted model: one row per centroid."""

    idf: np.ndarray
    languages: list[str]
    centres: np.ndarray
    least: np.ndarray  # cosine below which a text is too far from its nearest centroid


def fit(
    train: DataFrame, *, centroids: int = CENTROIDS, sample: int = SAMPLE_PER_LANGUAGE, rejected: float = REJECTED_SHARE
) -> Centroids:
    """Model of (text, lang) rows. Rows without a language or without a letter do not count.

    Document frequencies are counted over all rows; ``sample`` bounds the number of distinct texts a language gives to clustering.
    They are those of smallest hash, so they do not depend on order, size or copies, and every language gives at least one.
    """
    rows = train.where(F.col("lang").isNotNull() & has_letter("text")).select("text", "lang")

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for _, docs in texts(batches, "text"):
            total += (gram_counts(docs) > 0).sum(axis=0)
        if total.any():
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(BUCKETS)), pa.array(total)], ["bucket", "df"])

    counted = rows.mapInArrow(frequencies, "bucket bigint, df bigint").groupBy("bucket").agg(F.sum("df").alias("df"))
    df = np.zeros(BUCKETS, np.int64)
    for r in counted.collect():  # BUCKETS rows
        df[r.bucket] = r.df
    sizes = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}  # one row a language
    idf = np.log((1 + sum(sizes.values())) / (1 + df)).astype(np.float32) + np.float32(0.05)
    if not sizes:
        return Centroids(idf, [], np.zeros((0, BUCKETS), np.float32), np.zeros(0))

    # Copies count once: the texts of smallest hash in each language, whatever their number. Ranks are cut before the exchange.
    key = F.xxhash64("text")
    distinct = rows.select("lang", key.alias("key")).distinct()
    ranked = distinct.withColumn("place", F.row_number().over(Window.partitionBy("lang").orderBy("key"))).where(F.col("place") <= sample)
    last = {r.lang: r.key for r in ranked.groupBy("lang").agg(F.max("key").alias("key")).collect()}  # one row a language
    chosen = F.create_map(*[F.lit(x) for pair in last.items() for x in pair])
    drawn = rows.withColumn("key", key).where(F.col("key") <= chosen[F.col("lang")]).groupBy("lang", "key").agg(F.min("text").alias("text"))

    def vectorise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, docs in texts(batches, "text"):
            found = [v.tobytes() for v in vectors(docs, idf)]
            yield pa.RecordBatch.from_arrays([part.column("lang"), pa.array(found, pa.binary())], ["lang", "v"])

    def group(pdf: pd.DataFrame) -> pd.DataFrame:
        points = np.stack([np.frombuffer(v, np.float32) for v in sorted(pdf["v"])])
        centres = cluster(points, centroids)
        cosine = points @ centres.T
        own = [cosine[cosine.argmax(axis=1) == c, c] for c in range(len(centres))]
        least = [float(np.quantile(o, rejected)) * 0.5 if len(o) else 0.0 for o in own]
        return pd.DataFrame({"lang": pdf["lang"].iloc[0], "v": [c.astype(np.float32).tobytes() for c in centres], "least": least})

    # At most ``sample`` vectors a language come together.
    sampled = drawn.select("text", "lang").mapInArrow(vectorise, "lang string, v binary")
    found = sampled.groupBy("lang").applyInPandas(group, "lang string, v binary, least double").collect()
    found = sorted(found, key=lambda r: (r.lang, bytes(r.v)))
    centres = np.array([np.frombuffer(r.v, np.float32) for r in found], np.float32).reshape(-1, BUCKETS)
    return Centroids(idf, [r.lang for r in found], centres, np.array([r.least for r in found]))


def has_letter(column: str) -> Column:
    return F.coalesce(F.col(column).rlike(r"\p{L}"), F.lit(False))


def identify(docs: DataFrame, model: Centroids, *, reject: bool = True, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Columns ``keep`` of every row with lang_pred, score (cosine of the nearest centroid, 0 to 1) and rejected.

    Without a letter, for a null text or from a model without languages, lang_pred is ``und`` and the score 0. With ``reject``, texts
    too far from every centroid also become ``und``. Equal cosines go to the first language by name. Texts of any length are read
    whole. Repeated rows are kept; other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for part, rows in texts(batches, "text"):
            cosine = vectors(rows, m.idf) @ m.centres.T if m.languages else np.zeros((len(rows), 0), np.float32)
            lettered = np.array(part.column("_lettered").to_pylist(), bool) & bool(m.languages)
            best = cosine.argmax(axis=1) if m.languages else np.zeros(len(rows), int)
            score = np.clip(cosine[np.arange(len(rows)), best], 0, 1).astype(float) if m.languages else np.zeros(len(rows))
            score[~lettered] = 0
            far = lettered & (score < m.least[best]) if m.languages else np.zeros(len(rows), bool)
            unknown = ~lettered | far if reject else ~lettered
            names = [UNKNOWN if u else m.languages[b] for u, b in zip(unknown, best)]
            added = [pa.array(names, pa.string()), pa.array(score), pa.array(far)]
            yield pa.RecordBatch.from_arrays([*[part.column(c) for c in keep], *added], [*keep, "lang_pred", "score", "rejected"])

    rows = docs.select(*keep, "text", has_letter("text").alias("_lettered"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*keep).schema)
    return rows.mapInArrow(predict, f"{kinds}, lang_pred string, score double, rejected boolean")


def remainder() -> Column:
    """Fold of a document: crc32 of the id's text modulo 3; null for a null id."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(3))


@query()
def op4_language_id(spark: SparkSession, d: str) -> DataFrame:
    """Language of every document, learned from the documents outside the held-out fold."""
    docs = table(spark, d, "documents").select(
        "doc_id", "text", "lang", F.coalesce(remainder() == 1, F.lit(False)).alias("held_out")
    )
    model = fit(docs.where(remainder() != 1))
    return identify(docs.select("doc_id", "text", "held_out"), model, reject=False, keep=("doc_id", "held_out"))
