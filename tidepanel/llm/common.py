"""What the operators of this package share: reading tables, written intermediates, text columns."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepanel.sources.scratch import fresh_path

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query of this package and, where SQL can express it, the SQL that must give the same rows."""

    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def stored(df: DataFrame, name: str, made: list[str] | None = None) -> DataFrame:
    """``df`` written once to the shared folder and read back: later steps restart from files. The path is noted in ``made``."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    if made is not None:
        made.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, made: list[str]) -> None:
    """Delete intermediate files that nothing reads any more."""
    for path in made:
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
    made.clear()


def n_bytes(text: str = "text") -> Column:
    """Length of a text in UTF-8 bytes, 0 for null."""
    return F.coalesce(F.octet_length(F.col(text)), F.lit(0)).cast("bigint")


def texts(batches: Iterator[pa.RecordBatch], column: str, rows: int = 512) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Slices of the batches with their texts, null read as empty."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            part = batch.slice(at, rows)
            yield part, [t or "" for t in part.column(column).to_pylist()]
