"""Parquet tables: replaced, partitioned by month, exported, scanned."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def replace_table(df: DataFrame, path: str) -> None:
    """Truncate and load. ``path`` must not be one that ``df`` reads from."""
    df.write.mode("overwrite").parquet(path)


def write_period_table(
    df: DataFrame, path: str, *, key: str = "id", period: str = "period", files: int | None = None
) -> None:
    """Replace a table partitioned by month and clustered by (month, id).

    Rows are range-partitioned on both columns: a month larger than its share is split over several files of
    adjoining ids, a small month shares a task with its neighbours.
    """
    keys = [F.col(period), F.col(key)]
    ranged = df.repartitionByRange(files, *keys) if files else df.repartitionByRange(*keys)
    ranged.sortWithinPartitions(*keys).write.mode("overwrite").partitionBy(period).parquet(path)


def write_entity_table(df: DataFrame, name: str, path: str, *, buckets: int, key: str = "id", period: str = "period") -> DataFrame:
    """Replace a table bucketed by entity and sorted by month, and read it.

    One exchange at writing: windows over the entity's rows then need none, and joins on (entity, month) need none where the session sets
    ``spark.sql.requireAllClusterKeysForCoPartition`` to false. ``buckets`` fixes how many tasks such a window has, so
    choose it for the table's final size. The table is known to the session's catalog by ``name``, its files lie under ``path``.
    """
    dealt = df.repartition(buckets, F.col(key))
    writer = dealt.write.mode("overwrite").option("path", path).bucketBy(buckets, key).sortBy(key, period)
    writer.saveAsTable(name)
    return df.sparkSession.table(name)


def read_periods(
    spark: SparkSession,
    path: str,
    periods: Sequence[int] | DataFrame | None = None,
    *,
    columns: Sequence[str] | None = None,
    period: str = "period",
) -> DataFrame:
    """Listed months (and columns) of a month-partitioned table; the other month folders are not opened.

    The months may come from a table with a month column (a calendar, scenarios): they are then found at run time, and pruned all the same.
    """
    table = spark.read.parquet(path)
    if isinstance(periods, DataFrame):
        # The months of a table are few: one row a month. Spark prunes by a joined table only if that is filtered.
        kind = table.schema[period].dataType
        months = periods.select(F.col(period).cast(kind).alias(period)).where(F.col(period) > 0).distinct()
        table = table.join(F.broadcast(months), period, "left_semi")
    elif periods is not None:
        table = table.where(F.col(period).isin(*[int(p) for p in periods]))
    table = table.withColumn(period, F.col(period).cast("bigint"))
    return table.select(*columns) if columns else table


def export_parquet(df: DataFrame, path: str) -> None:
    """Snappy parquet files, as many as the frame has partitions."""
    df.write.option("compression", "snappy").parquet(path)


def read_parquet_glob(
    spark: SparkSession,
    pattern: str,
    *,
    periods: Sequence[int] | None = None,
    limit: int | None = None,
    order: Sequence[str] = ("period", "id"),
    period: str = "period",
) -> DataFrame:
    """Files matching a pattern, optionally some months and the first rows in key order."""
    found = spark.read.parquet(pattern)
    if periods is not None:
        found = found.where(F.col(period).isin(*periods))
    return found if limit is None else found.orderBy(*order).limit(limit)
