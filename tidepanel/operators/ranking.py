"""Ranks and running totals in score order without putting a whole score list into one task.

Order is (score desc, tie-break columns asc) within each group; (group, tie-break columns) must be unique. A NULL group is a
group like any other.

Rows are exchanged once: range-partitioned by (group, score, tie-break columns), sorted, and numbered and summed where they lie. They are
written with the number of their partition, the bucket, and their place, running gain and previous score inside it. Limits are tuples of
any ordered types, so a score shared by very many rows is split between its rows. What a bucket contributes is associative: its rows, its
gain, the largest running gain and its place. From these few rows per group, running sums tell every bucket where it starts and where the
curve peaks; a row's rank is then an addition. Buckets that cannot hold a wanted position are not read.

The limits come from the range partitioner's sample and only steer the balance; every row is ranked exactly. The first k rows
of each group need none of this: they are found by limits per group before and after an exchange.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepanel.operators.scalars import with_scalars
from tidepanel.sources.scratch import fresh_path, materialise

# Bucket tables and per-group tables are counted, broadcast up to this many rows, joined by shuffle beyond.
BROADCAST_ROWS = 500_000
# The first k rows of a group are found within so many parts of the partitions, then over the parts.
LIMIT_PARTS = 64
_LIMIT_SETTING = "spark.sql.optimizer.windowGroupLimitThreshold"

BUCKET = "_bucket"
RANK = "rk"
CUMULATIVE = "cum"
PREVIOUS_SCORE = "prev_score"
# Within the bucket: place from 1, running gain, score of the row before.
_PLACE, _RUNNING, _BEFORE = "_place", "_running", "_before"
OFFSETS = ("_n", "_n_before", "_g_before", "_low_before", "_n_group", "_peak_place", "_g_top", "_g_reached")


@dataclass(frozen=True)
class Ranking:
    """A frame and its order. Nothing runs before ranks are asked for."""

    source: DataFrame
    score: str
    group: tuple[str, ...]
    tie: tuple[str, ...]
    gain: str | None
    rows_per_bucket: int | None = None
    _kept: dict = field(default_factory=dict, compare=False)

    @property
    def df(self) -> DataFrame:
        """The frame, dealt out in score order and written with bucket, place, running gain and previous score."""
        if "df" not in self._kept:
            self._kept["df"] = self._dealt()
        return self._kept["df"]

    @property
    def bucket_key(self) -> list[str]:
        return [*self.group, BUCKET]

    @property
    def order(self) -> list[Column]:
        return [_ordered(self.source, self.score).desc_nulls_last(), *[F.asc(c) for c in self.tie]]

    def _dealt(self) -> DataFrame:
        order = [*[F.asc(c) for c in self.group], *self.order]
        # Without a wish for their size, buckets are as many as the session's shuffle partitions.
        parts = [max(1, math.ceil(self.source.count() / self.rows_per_bucket))] if self.rows_per_bucket else []
        dealt = self.source.repartitionByRange(*parts, *order).sortWithinPartitions(*order)
        dealt = dealt.withColumn(BUCKET, F.spark_partition_id().cast("bigint"))
        whole = self.gain and isinstance(self.source.schema[self.gain].dataType, T.IntegralType)
        kind = T.LongType() if whole or not self.gain else T.DoubleType()
        added = [(_PLACE, T.LongType()), (_RUNNING, kind), (_BEFORE, self.source.schema[self.score].dataType)]
        schema = T.StructType([*dealt.schema, *[T.StructField(n, t) for n, t in added]])
        path = fresh_path(self.source.sparkSession, "ranking")
        dealt.mapInArrow(_in_place(self.score, self.group, self.gain, whole or not self.gain), schema).write.parquet(path)
        return self.source.sparkSession.read.schema(schema).parquet(path)

    def offsets(self) -> DataFrame:
        """Per bucket: its rows, rows and gain before it, lowest score before it, rows of the group.

        ``_g_top`` is the highest running gain inside the bucket, first met at ``_peak_place``; ``_g_reached`` is the highest of the group.
        """
        if "offsets" in self._kept:
            return self._kept["offsets"]
        gain = F.col(self.gain) if self.gain else F.lit(0).cast("bigint")
        # Written once: every operator on this ranking starts from these few rows.
        totals = materialise(
            self.df.groupBy(*self.bucket_key).agg(
                F.count(F.lit(1)).alias("_n"),
                F.sum(gain).alias("_g"),
                F.max(F.struct(F.col(_RUNNING).alias("top"), (-F.col(_PLACE)).alias("place"))).alias("_peak"),
                F.min(self.score).alias("_low"),
            )
        )
        # One row per bucket and group.
        along = Window.partitionBy(*self.group).orderBy(BUCKET)
        before = along.rowsBetween(Window.unboundedPreceding, -1)
        whole = Window.partitionBy(*self.group)
        frame = totals.select(
            *self.bucket_key,
            "_n",
            "_peak",
            F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_n_before"),
            F.coalesce(F.sum("_g").over(before), F.lit(0)).alias("_g_before"),
            F.lag("_low").over(along).alias("_low_before"),
            F.sum("_n").over(whole).alias("_n_group"),
        )
        frame = frame.withColumn("_g_top", F.col("_g_before") + F.col("_peak.top")).select(
            *self.bucket_key,
            *["_n", "_n_before", "_g_before", "_low_before", "_n_group"],
            (-F.col("_peak.place")).alias("_peak_place"),
            "_g_top",
            F.max("_g_top").over(whole).alias("_g_reached"),
        )
        self._kept["offsets"] = materialise(frame)
        self._kept["few"] = self._kept["offsets"].count() <= BROADCAST_ROWS
        return self._kept["offsets"]

    def small(self, per_bucket: DataFrame) -> DataFrame:
        """A table of at most one row per bucket, broadcast if those were counted to be few."""
        self.offsets()
        return F.broadcast(per_bucket) if self._kept["few"] else per_bucket

    def ranked(self, offsets: DataFrame | None = None) -> DataFrame:
        """Rows of the given buckets (default all) with rank from 1, running gain and previous score."""
        starts = self.offsets() if offsets is None else offsets
        started = null_safe_join(self.df, self.small(starts), self.bucket_key)
        added = {RANK: F.col("_n_before") + F.col(_PLACE), PREVIOUS_SCORE: F.coalesce(_BEFORE, "_low_before", self.score)}
        if self.gain:
            added[CUMULATIVE] = F.col("_g_before") + F.col(_RUNNING)
        return started.withColumns(added).drop(*OFFSETS, BUCKET, _PLACE, _RUNNING, _BEFORE)

    def between(self, first: int, last: int | None) -> DataFrame:
        """Ranked rows with first <= rank <= last (no upper end for None)."""
        wanted = F.col(RANK) >= first
        if last is not None:
            wanted = wanted & (F.col(RANK) <= last)
        return self.ranked(self.overlapping(F.lit(first), F.lit(last))).where(wanted)

    def overlapping(self, first: Column, last: Column, per_group: DataFrame | None = None) -> DataFrame:
        """Offsets of the buckets that hold ranks first..last; the ends may be columns of ``per_group``."""
        starts = self.offsets()
        if per_group is not None:
            starts = self.with_group(starts, per_group)
        reaches = F.col("_n_before") + F.col("_n") >= first
        return starts.where(reaches & F.coalesce(F.col("_n_before") < last, F.lit(True))).select(self.offsets().columns)

    def holding_the_peak(self) -> DataFrame:
        """Offsets of the buckets in which the running gain is highest."""
        return self.offsets().where(F.col("_g_top") == F.col("_g_reached"))

    def with_group(self, df: DataFrame, per_group: DataFrame) -> DataFrame:
        """Add the columns of a one-row-per-group table (a one-row table without groups) to rows of the ranking."""
        if not self.group:
            return with_scalars(df, per_group)
        return null_safe_join(df, self.small(per_group), self.group)

    def first(self, k: int) -> DataFrame:
        """The first k rows of each group with their rank, from the frame as it is: no row beyond k leaves its task's partition."""
        return first_rows(self.source, self.order, k, self.group)


def first_rows(df: DataFrame, order: Sequence[Column], k: int, group: Sequence[str] = ()) -> DataFrame:
    """The first k rows of each group in this order, with their rank from 1.

    Spark limits a group before the exchange of a window if k is within a setting, which is raised where it is lower. Two
    steps, so that the last one sorts k rows of a few parts, not of every partition.
    """
    conf = df.sparkSession.conf
    if int(conf.get(_LIMIT_SETTING)) < k:
        conf.set(_LIMIT_SETTING, str(k))
    part, rank_ = F.pmod(F.spark_partition_id(), F.lit(LIMIT_PARTS)), F.row_number()
    placed = df.withColumn("_part", part)
    some = placed.withColumn(RANK, rank_.over(Window.partitionBy(*group, "_part").orderBy(*order))).where(F.col(RANK) <= k)
    whole = Window.partitionBy(*group).orderBy(*order)
    return some.drop(RANK, "_part").withColumn(RANK, rank_.over(whole)).where(F.col(RANK) <= k)


def rank(
    df: DataFrame,
    score: str,
    *,
    group: Sequence[str] = (),
    tie: Sequence[str] = ("id", "period"),
    gain: str | None = None,
    rows_per_bucket: int | None = None,
) -> Ranking:
    """A ranking of a frame; buckets hold about ``rows_per_bucket`` rows, by default as Spark deals them out."""
    return Ranking(df, score, tuple(group), tuple(tie), gain, rows_per_bucket)


def _in_place(score: str, group: Sequence[str], gain: str | None, whole: bool):
    """Place, running gain and previous score within each group of a sorted partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, place, total = None, 0, 0
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            held = pa.Table.from_batches([batch]) if last is None else pa.concat_tables([last, pa.Table.from_batches([batch])])
            new = np.zeros(n, bool)
            for c in group:
                new |= _changes(held.column(c).combine_chunks(), n)
            new[0] |= last is None
            starts = np.maximum.accumulate(np.where(new, np.arange(n), -1))  # -1: begun before this batch
            places = np.arange(n) - starts + np.where(starts < 0, place, 0) + (starts >= 0)
            gains = batch.column(gain).cast(pa.int64() if whole else pa.float64()).fill_null(0).to_numpy(zero_copy_only=False) if gain else np.zeros(n, np.int64)
            sums = np.cumsum(gains)
            running = sums - np.where(starts < 0, -total, np.r_[0, sums][np.maximum(starts, 0)])
            place, total = int(places[-1]), running[-1]
            before = held.column(score).combine_chunks().slice(0, n) if last is not None else pa.concat_arrays([pa.nulls(1, batch.column(score).type), batch.column(score).slice(0, n - 1)])
            before = pc.if_else(pa.array(new), pa.nulls(n, before.type), before)
            last = pa.Table.from_batches([batch.slice(n - 1)])
            added = [pa.array(places), pa.array(running), before]
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], [*batch.schema.names, _PLACE, _RUNNING, _BEFORE])

    return run


def _changes(column: pa.Array, n: int) -> np.ndarray:
    """Where each of the last n values differs from the one before; NULL equals NULL, NaN equals NaN."""
    a, b = column.slice(0, len(column) - 1), column.slice(1)
    out = pc.or_(pc.not_equal(a, b).fill_null(False), pc.xor(pc.is_null(a), pc.is_null(b)))
    if pa.types.is_floating(column.type):
        out = pc.and_(out, pc.invert(pc.and_(pc.is_nan(a), pc.is_nan(b)).fill_null(False)))
    found = out.to_numpy(zero_copy_only=False)
    return np.r_[np.zeros(n - len(found), bool), found]


def _ordered(df: DataFrame, score: str) -> Column:
    """The score as it is compared: a negative zero equals zero."""
    kind = df.schema[score].dataType
    return (F.col(score) + F.lit(0.0)).cast(kind) if isinstance(kind, (T.DoubleType, T.FloatType)) else F.col(score)


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner join on columns in which NULL equals NULL; the key columns stay once."""
    other = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_right_{k}")) for k in keys])
    return left.join(other, same).drop(*[f"_right_{k}" for k in keys])
