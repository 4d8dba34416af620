"""Result tables kept as files and merged in place, partition by partition.

A merge rewrites the partitions (experiments, say) that it changes and no others, by a dynamic partition overwrite. Rows to write are
settled before anything is replaced, a merge that has nothing to change writes nothing, and one that was cut short can be run again: the
result is the same. One writer at a time.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepanel.operators.combine import upsert
from tidepanel.sources.scratch import materialise


def path_exists(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def read_stored(df: DataFrame, path: str) -> DataFrame | None:
    """The stored table with the columns and types of ``df``; None if there is none."""
    spark = df.sparkSession
    return spark.read.schema(df.schema).parquet(path).select(*df.columns) if path_exists(spark, path) else None


def _replace_partitions(settled: DataFrame, path: str, keys: Sequence[str], partition: str) -> None:
    """Rows become all there is of the partitions that they have; the others keep their files. A large partition is written by several tasks."""
    dealt = settled.repartitionByRange(partition, *[k for k in keys if k != partition])
    dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path)


def _unlike(new: DataFrame, old: DataFrame) -> DataFrame:
    """Rows of ``new`` that are not in ``old`` as they are."""
    same = [F.col(f"n.{c}").eqNullSafe(F.col(f"o.{c}")) for c in new.columns]
    return new.alias("n").join(old.alias("o"), reduce(and_, same), "left_anti").select(*new.columns)


def _absent(new: DataFrame, old: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``new`` whose key ``old`` does not have. A key with NULL equals none, its row is known by all its columns."""
    whole = reduce(and_, [F.col(k).isNotNull() for k in keys])
    keyed = new.where(whole).join(old.select(*keys), list(keys), "left_anti").select(*new.columns)
    return keyed.unionByName(_unlike(new.where(~whole), old.where(~whole)))


def _merge(rows: DataFrame, path: str, keys: Sequence[str], partition: str, changes) -> None:
    if partition not in keys:
        raise ValueError(f"{partition} must be one of the keys {list(keys)}")
    # Written once: what the rows come from may be large.
    new = materialise(rows)
    upsert(new.limit(0), new, keys).limit(1).collect()  # a repeated key is an error here
    old = read_stored(new, path)
    if old is None:
        _replace_partitions(new, path, keys, partition)
        return

    def within(df: DataFrame) -> DataFrame:
        """Stored rows in the partitions of ``df``, the only ones that are read."""
        found = F.broadcast(df.select(F.col(partition).alias("_touched")).where(F.col(partition).isNotNull()).distinct())
        return old.join(found, F.col(partition) == F.col("_touched"), "left_semi")

    changed = materialise(changes(new, within(new)))
    if not changed.isEmpty():
        kept = within(changed).join(changed.select(*keys), list(keys), "left_anti").select(*new.columns)
        _replace_partitions(materialise(kept.unionByName(changed)), path, keys, partition)


def upsert_stored(new: DataFrame, path: str, keys: Sequence[str], *, partition: str) -> None:
    """Rows of ``new`` replace stored ones of equal key, the others are added. A key that ``new`` repeats is an error.

    ``partition`` is one of the keys, never NULL, with few values in a merge. The stored table has the columns of ``new``.
    """
    _merge(new, path, keys, partition, _unlike)


def insert_stored(new: DataFrame, path: str, keys: Sequence[str], *, partition: str) -> None:
    """Rows of ``new`` are added where the table does not have their key."""
    _merge(new, path, keys, partition, lambda rows, old: _absent(rows, old, keys))
