"""Extendible hashing: splits a table into shards that each fit a byte limit.

A shard is a hash prefix. The directory starts with the empty prefix; a bucket over the limit splits on the next
hash bit, all others stay, so shards differ in depth. Rows are counted once per ``step`` bits in small cells of
the hash, and the bucket tree is built from the cells; only rows of cells that are still too large
are counted again on further bits.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepanel.llm.common import n_bytes, query, table
from tidepanel.sources.scratch import materialise

HASH_BITS = 60
SHARD_BYTES = 64 * 2**20


def key_hash(*columns: str) -> Column:
    """60 bits of the MD5 of the key's text; null counts as the empty text."""
    text = F.concat_ws("\x1f", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("bigint")


def assign_shards(
    df: DataFrame, size: Column, *, key: Sequence[str] = ("doc_id",), limit: int = SHARD_BYTES, step: int = 16
) -> DataFrame:
    """``df`` with ``shard`` (the bucket's hash prefix as bits), ``depth``, ``row_bytes`` and ``shard_bytes``.

    Every shard has at most ``limit`` bytes unless it is a single row that is larger. Rows whose keys hash alike
    (repeated rows, null keys) stay together while they fit. If a key alone exceeds the limit, its rows
    are written once, numbered, and split on by the hash of that number; ``shard`` is then the full prefix,
    a dot and the further bits. An empty table gives an empty result. Columns of these names are replaced.
    """
    rows = df.withColumns({"row_bytes": size.cast("bigint"), "_h": key_hash(*key)})
    done, rest = _split(rows, limit, step)
    if rest is not None:
        # Number the rows of oversized keys; written first, so that both passes see the same numbers.
        stuck = rest.withColumn("_n", F.monotonically_increasing_id())
        stuck = materialise(stuck).withColumns({"_first": F.lpad(F.bin("_h"), HASH_BITS, "0"), "_h": key_hash("_h", "_n")})
        more, last = _split(stuck.drop("shard", "depth", "shard_bytes"), limit, step, within="_first")
        done += [
            part.withColumns({"shard": F.concat_ws(".", "_first", "shard"), "depth": F.col("depth") + HASH_BITS})
            for part in (more if last is None else [*more, last])
        ]
    out = [*[c for c in df.columns if c not in ("shard", "depth", "row_bytes", "shard_bytes")], "row_bytes"]
    return reduce(DataFrame.unionByName, [p.select(*out, "shard", "depth", "shard_bytes") for p in done])


def _split(rows: DataFrame, limit: int, step: int, within: str | None = None) -> tuple[list[DataFrame], DataFrame | None]:
    """Rows with their bucket, level by level, and those whose whole hash is shared by too many bytes (or None)."""
    done: list[DataFrame] = []
    low, parents = 0, [within] if within else []
    while True:
        high = min(low + step, HASH_BITS)
        cell = F.shiftright("_h", HASH_BITS - high)
        # Small table: at most one row per hash cell, pre-aggregated before the shuffle.
        cells = materialise(
            rows.groupBy(*parents, cell.alias("_cell")).agg(
                F.sum("row_bytes").alias("_bytes"), F.count(F.lit(1)).alias("_rows")
            )
        )
        depths = F.explode(F.sequence(F.lit(low), F.lit(high)))
        paths = cells.withColumn("depth", depths).withColumn(
            "_prefix", F.expr(f"shiftright(_cell, {high} - depth)")
        )
        nodes = paths.groupBy(*parents, "depth", "_prefix").agg(
            F.sum("_bytes").alias("shard_bytes"), F.sum("_rows").alias("_node_rows")
        )
        fitting = nodes.where((F.col("shard_bytes") <= limit) | (F.col("_node_rows") == 1))
        # The first fitting bucket on the way down from the root is the shard of the cell.
        directory = (
            paths.join(fitting, [*parents, "depth", "_prefix"])
            .groupBy(*parents, "_cell")
            .agg(F.min_by(F.struct("depth", "_prefix", "shard_bytes"), "depth").alias("_at"))
        )
        oversized = cells.where((F.col("_bytes") > limit) & (F.col("_rows") > 1))
        keyed = rows.withColumn("_cell", cell)
        bits = F.expr("lpad(bin(_at._prefix), _at.depth, '0')")
        done.append(
            keyed.join(directory, [*parents, "_cell"])
            .withColumns({"shard": bits, "depth": F.col("_at.depth"), "shard_bytes": F.col("_at.shard_bytes")})
            .drop("_at", "_cell")
        )
        if oversized.isEmpty():
            return done, None
        rest = keyed.join(oversized.select(*parents, "_cell"), [*parents, "_cell"], "left_semi").drop("_cell")
        if high == HASH_BITS:
            return done, rest
        rows, low = rest, high


def _sql(limit: int) -> str:
    return f"""WITH h AS (SELECT doc_id, CAST(strlen(coalesce(text, '')) AS bigint) AS row_bytes,
    CAST('0x' || substr(md5(coalesce(CAST(doc_id AS varchar), '')), 1, 15) AS bigint) AS h FROM documents),
paths AS (SELECT h.*, CAST(t.depth AS integer) AS depth, h >> CAST({HASH_BITS} - t.depth AS integer) AS prefix
  FROM h, range(0, 41) t(depth)),
nodes AS (SELECT depth, prefix, CAST(sum(row_bytes) AS bigint) AS shard_bytes, count(*) AS n FROM paths GROUP BY 1, 2)
SELECT doc_id, row_bytes, depth, CASE WHEN depth = 0 THEN '' ELSE lpad(bin(prefix), depth, '0') END AS shard, shard_bytes
FROM paths JOIN nodes USING (depth, prefix) WHERE shard_bytes <= {limit} OR n = 1
QUALIFY depth = min(depth) OVER (PARTITION BY doc_id)"""


def _shards(spark: SparkSession, d: str, limit: int) -> DataFrame:
    rows = table(spark, d, "documents").select("doc_id", n_bytes().alias("_size"))
    return assign_shards(rows, F.col("_size"), limit=limit).select("doc_id", "row_bytes", "depth", "shard", "shard_bytes")


@query(_sql(SHARD_BYTES))
def op6_extendible_sharding(spark: SparkSession, d: str) -> DataFrame:
    """Every document with its shard of at most 64 MiB of text."""
    return _shards(spark, d, SHARD_BYTES)


SMALL_SHARD_BYTES = 2**16


@query(_sql(SMALL_SHARD_BYTES))
def small_shards(spark: SparkSession, d: str) -> DataFrame:
    """The same with 64 KiB, so that the small tables split as well."""
    return _shards(spark, d, SMALL_SHARD_BYTES)
