"""Churn labels from the gaps in an entity's months."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidepanel.constants import (
    GONE_IN_ONE,
    GONE_IN_TWO,
    ROWNUM_GONE_IN_ONE_BEFORE,
    ROWNUM_GONE_IN_TWO_BEFORE,
    STAYS,
)
from tidepanel.functions.periods import month_serial
from tidepanel.operators.history import by_entity
from tidepanel.operators.scalars import with_scalars


def lead_periods(df: DataFrame, *, key: str = "id", period: str = "period") -> DataFrame:
    """(period, id, p0, p1, p2): the row's month serial and those of the entity's next two rows."""
    order = by_entity(key, period)
    keys = df.select(period, key, month_serial(F.col(period)).cast("bigint").alias("p0"))
    return keys.select("*", F.lead("p0", 1).over(order).alias("p1"), F.lead("p0", 2).over(order).alias("p2"))


def last_periods(df: DataFrame, *, period: str = "period") -> DataFrame:
    """One row: the last month serial of the table and the one before it. Reads only the month column."""
    last = F.max(month_serial(F.col(period))).cast("bigint")
    return df.agg(last.alias("last_serial"), (last - 1).alias("previous_serial"))


def with_last_periods(df: DataFrame, panel: DataFrame, *, period: str = "period") -> DataFrame:
    """Every row of ``df`` with the two scalars of ``last_periods(panel)``."""
    return with_scalars(df, last_periods(panel, period=period))


def _gap_label(p0: Column, p1: Column, p2: Column, last: Column, previous: Column) -> Column:
    returns_next = p0 + 1 == p1
    misses_second = p2.isNull() | (p0 + 2 < p2)
    misses_next = p1.isNull() | (p0 + 1 < p1)
    return (
        F.when((p0 < previous) & returns_next & misses_second, GONE_IN_TWO)
        .when((p0 < last) & misses_next, GONE_IN_ONE)
        .when(p0 < previous, STAYS)
    )


def churn_label_gap(df: DataFrame, *, key: str = "id", period: str = "period") -> DataFrame:
    """(period, id, p0, p1, p2, label) from gaps between the entity's months.

    The last months of the table have no label where the outcome is still open.
    """
    leads = with_last_periods(lead_periods(df, key=key, period=period), df, period=period)
    columns = [F.col(c) for c in ("p0", "p1", "p2", "last_serial", "previous_serial")]
    return leads.select(period, key, "p0", "p1", "p2", _gap_label(*columns).alias("label"))


def with_gap_label(df: DataFrame, *, key: str = "id", period: str = "period") -> DataFrame:
    """The panel with its gap label. Leads are taken on the panel itself, so there is no join on the key."""
    order = by_entity(key, period)
    leads = df.select(
        "*", F.lead(period, 1).over(order).alias("_next"), F.lead(period, 2).over(order).alias("_second")
    )
    serials = [month_serial(F.col(c)) for c in (period, "_next", "_second")]
    label = _gap_label(*serials, F.col("last_serial"), F.col("previous_serial"))
    labelled = with_last_periods(leads, df, period=period).withColumn("label", label)
    return labelled.select(*df.columns, "label")


def churn_label_rownum(
    df: DataFrame,
    *,
    gone_in_one_before: int = ROWNUM_GONE_IN_ONE_BEFORE,
    gone_in_two_before: int = ROWNUM_GONE_IN_TWO_BEFORE,
    key: str = "id",
    period: str = "period",
) -> DataFrame:
    """(period, id, label) from the position counted from the entity's last row, ignoring gaps."""
    place = F.row_number().over(Window.partitionBy(key).orderBy(F.desc(period)))
    label = (
        F.when((F.col("_place") == 1) & (F.col(period) < gone_in_one_before), GONE_IN_ONE)
        .when((F.col("_place") == 2) & (F.col(period) < gone_in_two_before), GONE_IN_TWO)
        .when(F.col("_place") >= 3, STAYS)
    )
    return df.select(period, key, place.alias("_place")).select(period, key, label.alias("label"))


def join_labels(
    df: DataFrame, labels: DataFrame, *, key: str = "id", period: str = "period", label: str = "label"
) -> DataFrame:
    """Panel LEFT JOIN labels on (period, id); the label becomes the last column."""
    found = labels.select(period, key, label)
    return df.join(found, [period, key], "left").select(*df.columns, label)


def label_step(open_rows: DataFrame | None, month: DataFrame, *, key: str = "id", period: str = "period") -> tuple[DataFrame, DataFrame]:
    """Labels that one new month settles, and the rows that are still open: each (id, period, label).

    ``open_rows`` is what the step before returned (None at first), at most the rows of two months; ``month`` has the rows of one later
    month. Labels of all steps together with the last open rows are those of ``churn_label_gap`` over the whole table.
    """
    fresh = month.select(key, period)
    rows = fresh if open_rows is None else open_rows.select(key, period).unionByName(fresh)
    labels = churn_label_gap(rows, key=key, period=period).select(key, period, "label")
    return labels.where(F.col("label").isNotNull()), labels.where(F.col("label").isNull())
