"""Exact top-k by inner product with vector-approximation files.

Every distinct vector is stored twice: exactly, and as an approximation of one byte a component, the number of its
cell among ``CELLS`` equal ones. Blocks of queries scan blocks of approximations: the cell centres give the score up to
half a cell times the query's absolute components, so a lower and an upper bound. What cannot beat
the k-th best lower bound is dropped, first in the block, then over all blocks. Exact vectors are read only for the remaining
candidates, in order of their bound, until the k-th result is certain.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidepanel.llm.common import query, stored, table

K = 5
CELLS = 256
BLOCK = 8192
QUERY_BLOCK = 1024
SCALE = 256


def integer_vectors(df: DataFrame) -> DataFrame:
    """(vec_id, v): floor(256 x) of every component; vectors that are null or hold null or non-finite ones go.

    Components so large that a score might not fit a long are an error.
    """
    x = F.col("embedding").cast("array<double>")
    finite = F.forall(x, lambda c: F.coalesce((F.abs(c) < float("inf")), F.lit(False)) & ~F.isnan(c))
    rows = df.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).where(finite)
    largest = F.coalesce(F.array_max(F.transform(x, lambda c: F.abs(c * SCALE) + 1)), F.lit(0.0))
    fits = F.size(x) * largest * largest < 2.0**62
    refused = F.raise_error(F.concat(F.lit("components too large for exact scores: vec_id "), F.col("vec_id").cast("string")))
    v = F.when(fits, F.transform(x, lambda c: F.floor(c * SCALE))).otherwise(refused.cast("array<bigint>"))
    return rows.select("vec_id", v.alias("v")).distinct()


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), dim)


def _by_dimension(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[int, np.ndarray, pa.RecordBatch]]:
    """Row blocks of one dimension: (dimension, vectors, rows)."""
    for batch in batches:
        dims = batch.column("dim").to_numpy(zero_copy_only=False)
        for dim in np.unique(dims):
            part = batch.filter(pa.array(dims == dim))
            for at in range(0, part.num_rows, size):
                rows = part.slice(at, size)
                yield int(dim), _matrix(rows.column("v"), int(dim)), rows


def _blocks(df: DataFrame, id_column: str, size: int, low: int, width: float) -> DataFrame:
    """Blocks of up to ``size`` rows: ids, who they stand for if for one id only, and the cells (``width`` > 0) or the exact components."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, n = TaskContext.get().partitionId(), 0
        for dim, vectors, rows in _by_dimension(batches, size):
            body = np.minimum((vectors - low) / width, CELLS - 1).astype(np.uint8) if width else vectors
            ids = rows.column(id_column).to_numpy(zero_copy_only=False).astype(np.int64)
            own = rows.column("own").to_numpy(zero_copy_only=False).astype(np.int64)
            alone = rows.column("alone").to_numpy(zero_copy_only=False).astype(bool)
            columns = [[task << 24 | n], [dim], [ids.tobytes()], [own.tobytes()], [alone.tobytes()], [body.tobytes()]]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["block", "dim", "ids", "own", "alone", "body"])
            n += 1

    return df.mapInArrow(pack, "block bigint, dim bigint, ids binary, own binary, alone binary, body binary")


def _scan(k: int, low: int, width: float):
    """Candidates (query_id, rep, lower, upper) of pairs of a query block and a block of approximations."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                dim = row["dim"]
                query_ids, reps = (np.frombuffer(row[c], np.int64) for c in ("q_ids", "ids"))
                queries = np.frombuffer(row["q_body"], np.int64).reshape(len(query_ids), dim).astype(float)
                cells = np.frombuffer(row["body"], np.uint8).reshape(len(reps), dim)
                own, alone = np.frombuffer(row["own"], np.int64), np.frombuffer(row["alone"], bool)
                centres = low + (cells + 0.5) * width
                for at in range(0, len(queries), 128):
                    q, ids = queries[at : at + 128], query_ids[at : at + 128]
                    middle = q @ centres.T
                    slack = np.abs(q).sum(axis=1, keepdims=True) * width / 2
                    slack = slack + 1 + 1e-9 * (np.abs(middle).max(initial=0) + slack)  # rounding
                    middle[alone & (own == ids[:, None])] = -np.inf  # nobody but the query itself
                    kth = np.partition(middle, -k, axis=1)[:, -k] if middle.shape[1] > k else np.full(len(q), -np.inf)
                    of, rep = np.nonzero((middle + slack >= (kth - slack[:, 0])[:, None]) & (middle > -np.inf))
                    bounds = middle[of, rep]
                    columns = [ids[of], reps[rep], bounds - slack[of, 0], bounds + slack[of, 0]]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["query_id", "rep", "lower", "upper"])

    return scan


def _read_exact(k: int):
    """The k best of a query's candidates: exact vectors in order of their bound until the k-th is certain."""

    def read(pdf: pd.DataFrame) -> pd.DataFrame:
        query_id = int(pdf["query_id"].iloc[0])
        q = np.array(pdf["q"].iloc[0], np.int64)
        pdf = pdf.sort_values("upper", ascending=False)
        upper, best = pdf["upper"].to_numpy(), []
        for at in range(0, len(pdf), 64):
            if len(best) >= k and -best[k - 1][0] > upper[at]:
                break
            part = pdf.iloc[at : at + 64]
            exact = np.stack([np.asarray(v, np.int64) for v in part["v"]]) @ q
            best += [(-int(s), int(i)) for s, ids in zip(exact, part["ids"]) for i in ids if i != query_id]
            best = sorted(set(best))[:k]
        rows = [(query_id, n, i, -s) for n, (s, i) in enumerate(best, 1)]
        return pd.DataFrame(rows, columns=["query_id", "rank", "vec_id", "score"]).astype({"rank": "int32"})

    return read


def exact_topk(vectors: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` highest inner products for every query, fewer if there are fewer rows.

    ``vectors`` and ``queries`` are (vec_id, v) with whole-number arrays, distinct rows. A row is no candidate of the query of its
    own id; equal scores go to the smaller id. Vectors meet only those of their own length. Equal vectors
    are scanned once: of each, the k + 1 smallest ids can be results. Scores must fit a long. If an id comes
    with several vectors, its best counts; a query id with several gets one list for all. Empty tables give no rows.
    """
    smallest = Window.partitionBy("v").orderBy("vec_id")
    few = vectors.withColumn("n", F.row_number().over(smallest)).where(F.col("n") <= k + 1)
    grouped = few.groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    # A vector's place in the files; a repeated id would not be unique.
    reps = grouped.select(F.monotonically_increasing_id().alias("rep"), "ids", "v", F.size("v").cast("bigint").alias("dim"))
    reps = stored(reps, "exact_vectors")
    asked = stored(queries.select(F.col("vec_id").alias("query_id"), F.col("v"), F.size("v").cast("bigint").alias("dim")), "queries")
    low, high = reps.agg(F.min(F.array_min("v")), F.max(F.array_max("v"))).first()
    low, high = low or 0, high or 0
    width = (high - low + 1) / CELLS
    own = F.when(F.size("ids") == 1, F.col("ids")[0])
    approximations = _blocks(
        reps.select("rep", "dim", "v", own.isNotNull().alias("alone"), F.coalesce(own, F.lit(0)).alias("own")),
        "rep", BLOCK, low, width,
    )
    return _search(asked, reps, approximations, k, low, width)


def _search(asked: DataFrame, reps: DataFrame, approximations: DataFrame, k: int, low: int, width: float) -> DataFrame:
    files = stored(approximations, "approximations")
    numbered = files.select("block", "dim").distinct()
    asking = asked.withColumns({"own": F.col("query_id"), "alone": F.lit(True)})
    blocks = _blocks(asking, "query_id", QUERY_BLOCK, 0, 0.0).select(
        F.col("dim"), F.col("ids").alias("q_ids"), F.col("body").alias("q_body")
    )
    # Each query block goes to every block of approximations of its dimension, dealt out by block.
    pairs = blocks.join(numbered, "dim").repartition("block").join(files.drop("dim"), "block")
    found = pairs.select("dim", "q_ids", "q_body", "ids", "own", "alone", "body").mapInArrow(
        _scan(k, low, width), "query_id bigint, rep bigint, lower double, upper double"
    )
    found = stored(found, "candidates")
    order = Window.partitionBy("query_id").orderBy(F.desc("lower"))
    kth = found.select("query_id", "lower").withColumn("n", F.row_number().over(order)).where(F.col("n") == k)
    left = found.join(kth.select("query_id", F.col("lower").alias("least")), "query_id", "left").where(
        F.col("least").isNull() | (F.col("upper") >= F.col("least"))
    )
    exact = left.join(reps.select("rep", "ids", "v"), "rep").join(
        asked.select("query_id", F.col("v").alias("q")), "query_id"
    )
    return exact.select("query_id", "upper", "ids", "v", "q").groupBy("query_id").applyInPandas(
        _read_exact(k), "query_id bigint, rank int, vec_id bigint, score bigint"
    )


@query(
    f"""WITH v AS (SELECT DISTINCT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS double)) AS bigint)) AS v
  FROM embeddings WHERE len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
s AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
    CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS bigint) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id)
SELECT query_id, CAST(row_number() OVER w AS integer) AS rank, vec_id, score FROM s
WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id) QUALIFY rank <= {K}"""
)
def op8_exact_topk(spark: SparkSession, d: str) -> DataFrame:
    """The five best inner products among all embeddings for every row whose id is divisible by 50."""
    vectors = stored(integer_vectors(table(spark, d, "embeddings")), "vectors")
    return exact_topk(vectors, vectors.where(F.col("vec_id") % 50 == 0))
