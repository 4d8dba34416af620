"""Features over an entity's earlier rows: lags, deltas, rolling statistics, trend, ratios.

Frames count rows, not calendar months. The key (id, period) is unique, so one id never has more rows than
there are months and the per-id windows stay small however large the panel is.

All features of a call come from one Window node over one exchange on the id: the node only numbers the rows, which leaves an
entity's rows one behind the other, and the features are arithmetic on Arrow blocks of them (a few earlier rows are carried over).
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

STATISTICS = ("mean", "min", "max", "trend", "ratio_mean", "ratio_max")
_ROW = "__row"
_SUFFIXES = {"mean": "avg", "min": "min", "max": "max", "trend": "trend", "ratio_mean": "ratioavg", "ratio_max": "ratiomax"}
_PLAIN = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType)
# Values of a block that goes back to Spark, 16 MB.
BATCH_VALUES = 2_000_000


def by_entity(key: str = "id", period: str = "period"):
    return Window.partitionBy(key).orderBy(period)


def with_row_index(df: DataFrame, name: str = "row_index", key: str = "id", period: str = "period") -> DataFrame:
    return df.withColumn(name, F.row_number().over(by_entity(key, period)))


def _names(c: str, levels: Sequence[int], statistics: Sequence[str], window: int) -> list[str]:
    lags, deltas = [f"{c}_lag{k}" for k in levels], [f"{c}_delta{k}" for k in levels]
    return [*lags, *deltas, *[f"{c}_{_SUFFIXES[s]}{window}" for s in statistics]]


def _doubles(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values as doubles, and where there is one."""
    known = array.is_valid().to_numpy(zero_copy_only=False)
    whole = array.fill_null(0) if array.null_count else array
    return whole.cast(pa.float64(), safe=False).to_numpy(zero_copy_only=False), known


def _arrays(values: np.ndarray, known: np.ndarray) -> list[pa.Array]:
    """An Arrow column of each row of the matrix, over its memory."""
    bits = np.packbits(known, axis=1, bitorder="little")
    return [
        pa.Array.from_buffers(pa.float64(), values.shape[1], [pa.py_buffer(b), pa.py_buffer(v)])
        for b, v in zip(bits, np.ascontiguousarray(values))
    ]


def _divided(a: np.ndarray, b: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return a / b, known & (b != 0)


def _largest(seen: Sequence[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Of the values there are; NaN is above all others, as in greatest()."""
    out = np.full(seen[0][0].shape, -np.inf)
    for v, known in seen:
        np.copyto(out, v, where=known & ((v > out) | (v != v)))
    return out


def _smallest(seen: Sequence[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    out = np.full(seen[0][0].shape, np.nan)
    for v, known in seen:
        np.copyto(out, v, where=known & (v == v) & ~(v >= out))
    return out


def _rolled(seen: Sequence[tuple[np.ndarray, np.ndarray]], row: np.ndarray, statistics: Sequence[str]) -> dict:
    """Statistic: (values, where there is one), from the values of the frame, newest first."""
    window, (now, here) = len(seen), seen[0]
    n = np.sum([known for _, known in seen], axis=0, dtype=float)
    some = n > 0
    zeroed = [np.where(known, v, 0.0) for v, known in seen]
    # Oldest first, the order in which a running aggregate would add them.
    total = reduce(np.add, reversed(zeroed))
    mean = total / n
    out: dict = {"mean": (mean, some)}
    if {"max", "ratio_max"} & set(statistics):
        out["max"] = (_largest(seen), some)
        out["ratio_max"] = _divided(now, out["max"][0], here)
    if "min" in statistics:
        out["min"] = (_smallest(seen), some)
    if "ratio_mean" in statistics:
        out["ratio_mean"] = _divided(now, mean, here)
    if "trend" in statistics:
        # covar_pop(value, row) / var_pop(row): the covariance skips NULL values, the variance does not.
        # Both are unchanged by shifting the row axis, so positions relative to the current row are used;
        # the variance of m consecutive integers is (m * m - 1) / 12.
        cross = reduce(np.add, [z * -float(i) for i, z in enumerate(zeroed)])
        places = np.sum([known * -float(i) for i, (_, known) in enumerate(seen)], axis=0)
        m = np.minimum(row, window)
        out["trend"] = _divided((cross - total * (places / n)) / n, (m * m - 1) / 12.0, some)
    return out


def _featured(columns: Sequence[str], values: Sequence[str], kept: Sequence[str], levels, reach: int, window: int, statistics):
    """Rows in order of entity and period, with their place in it, to ``kept`` and the features of ``columns``; ``values`` hold their numbers."""
    per_column = 2 * len(levels) + len(statistics)
    names = [*kept, *[n for c in columns for n in _names(c, levels, statistics, window)]]
    step = max(64, BATCH_VALUES // len(names))

    def features(held: np.ndarray, known: np.ndarray, row: np.ndarray) -> list[pa.Array]:
        n = len(row)
        seen = [(held[:, reach - k : reach - k + n], known[:, reach - k : reach - k + n] & (row > k)) for k in range(reach + 1)]
        now, here = seen[0]
        found = [seen[k] for k in levels]
        found += [(now - seen[k][0], here & seen[k][1]) for k in levels]
        if statistics:
            rolled = _rolled(seen[:window], row, statistics)
            found += [rolled[s] for s in statistics]
        made = [_arrays(v, k) for v, k in found]
        return [made[i][c] for c in range(len(columns)) for i in range(per_column)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The last rows of the batch before, as far as a feature can look back.
        held, known = np.zeros((len(columns), reach)), np.zeros((len(columns), reach), bool)
        last = 0
        for batch in batches:
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                row = part.column(_ROW).to_numpy()
                if not np.all((row == 1) | (row == np.r_[last, row[:-1]] + 1)):
                    raise RuntimeError("rows are not in the order of their entity")
                last = row[-1]
                pairs = [_doubles(part.column(v)) for v in values]
                held = np.concatenate([held, [v for v, _ in pairs]], axis=1) if columns else held
                known = np.concatenate([known, [k for _, k in pairs]], axis=1) if columns else known
                with np.errstate(all="ignore"):
                    made = features(held, known, row) if columns else []
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in kept], *made], names)
                held, known = held[:, held.shape[1] - reach :].copy(), known[:, known.shape[1] - reach :].copy()

    return run


def historical_features(
    df: DataFrame,
    columns: Sequence[str],
    *,
    window: int = 6,
    lags: int | Sequence[int] = 2,
    statistics: Sequence[str] = STATISTICS,
    derived: Mapping[str, Column] | None = None,
    key: str = "id",
    period: str = "period",
) -> DataFrame:
    """All input columns plus, per listed column, its lags and deltas and the rolling statistics, as doubles.

    ``lags`` is a depth (levels 1..depth) or a list of levels. The window numbers the rows of each entity, and so puts them side by
    side; the features of all columns are then arithmetic on blocks of these rows. ``derived`` columns are expressions of a row's
    other columns: they follow those, and are computed once the rows are exchanged and sorted, which then carry only what they are made of.
    """
    unknown = [s for s in statistics if s not in STATISTICS]
    if unknown:
        raise ValueError(f"unknown statistic {unknown[0]!r}; known: {', '.join(STATISTICS)}")
    levels, reach = _levels(lags), _reach(lags, window, statistics)
    over = f"over (partition by `{key}` order by `{period}`)"
    placed = df.selectExpr("*", f"row_number() {over} as {_ROW}").withColumns(dict(derived or {}))
    known = T.StructType([f for f in placed.schema if f.name != _ROW])
    kept = known.names
    # Numbers go over as they are, other types (decimals, texts) are cast by Spark.
    cast = {c: f"__{c}_v" for c in columns if not isinstance(known[c].dataType, _PLAIN)}
    placed = placed.selectExpr("*", *[f"cast(`{c}` as double) as `{v}`" for c, v in cast.items()])
    names = [n for c in columns for n in _names(c, levels, statistics, window)]
    schema = T.StructType([*known, *[T.StructField(n, T.DoubleType()) for n in names]])
    values = [cast.get(c, c) for c in columns]
    return placed.mapInArrow(_featured(columns, values, kept, levels, reach, window, statistics), schema)


def lag_features(
    df: DataFrame,
    columns: Sequence[str],
    depth: int = 2,
    *,
    separator: str = "",
    key: str = "id",
    period: str = "period",
) -> DataFrame:
    """Lags 1..depth of each column, in the column's own type."""
    order = by_entity(key, period)
    lagged = [F.lag(c, k).over(order).alias(f"{c}_lag{separator}{k}") for c in columns for k in range(1, depth + 1)]
    return df.select("*", *lagged)


def delta_features(
    df: DataFrame,
    columns: Sequence[str],
    depth: int = 2,
    *,
    separator: str = "",
    key: str = "id",
    period: str = "period",
) -> DataFrame:
    """Change against the value 1..depth rows earlier."""
    order = by_entity(key, period)
    changes = [
        (F.col(c) - F.lag(c, k).over(order)).alias(f"{c}_delta{separator}{k}")
        for c in columns
        for k in range(1, depth + 1)
    ]
    return df.select("*", *changes)


def lag_by_position(
    df: DataFrame, columns: Sequence[str], *, key: str = "id", period: str = "period"
) -> DataFrame:
    """Compatibility form: the i-th listed column (from 0) gets its lag i. Unknown columns are skipped."""
    order = by_entity(key, period)
    lagged = [
        F.lag(c, i).over(order).alias(f"{c}_lag_{i}") for i, c in enumerate(columns) if c in df.columns
    ]
    return df.select("*", *lagged)


def rolling(
    df: DataFrame,
    columns: Sequence[str],
    statistics: Sequence[str],
    *,
    window: int = 6,
    key: str = "id",
    period: str = "period",
) -> DataFrame:
    """Only the named rolling statistics (see ``STATISTICS``)."""
    return historical_features(
        df, columns, window=window, lags=[], statistics=statistics, key=key, period=period
    )


def _levels(lags: int | Sequence[int]) -> list[int]:
    return list(range(1, lags + 1)) if isinstance(lags, int) else list(lags)


def _reach(lags: int | Sequence[int], window: int, statistics: Sequence[str]) -> int:
    """How many earlier rows a feature can look at."""
    return max([0, *_levels(lags), window - 1 if statistics else 0])


def history_state(
    df: DataFrame,
    columns: Sequence[str],
    *,
    window: int = 6,
    lags: int | Sequence[int] = 2,
    statistics: Sequence[str] = STATISTICS,
    key: str = "id",
    period: str = "period",
) -> DataFrame:
    """The last rows of every entity that features of a later month can look at: key, period and columns."""
    place = F.row_number().over(Window.partitionBy(key).orderBy(F.desc(period)))
    placed = df.select(key, period, *columns).withColumn("_place", place)
    return placed.where(F.col("_place") <= _reach(lags, window, statistics)).drop("_place")


def history_step(
    state: DataFrame | None,
    month: DataFrame,
    columns: Sequence[str],
    *,
    window: int = 6,
    lags: int | Sequence[int] = 2,
    statistics: Sequence[str] = STATISTICS,
    key: str = "id",
    period: str = "period",
) -> tuple[DataFrame, DataFrame]:
    """Features of one new month, and the state for the next.

    ``state`` is what ``history_state`` or the step before returned (None at first); ``month`` has the rows of one later month. A month
    costs one month and the state, not the history; month by month the features are those of ``historical_features`` over all months.
    """
    options = {"window": window, "lags": lags, "statistics": statistics, "key": key, "period": period}
    rows = month.withColumn("_new", F.lit(True))
    held = month.select(key, period, *columns)
    if state is not None:
        # Entities that are not in the month stay in the state only.
        earlier = state.join(month.select(key), key, "left_semi").select(key, period, *columns)
        rows = rows.unionByName(earlier.withColumn("_new", F.lit(False)), allowMissingColumns=True)
        held = state.select(key, period, *columns).unionByName(held)
    features = historical_features(rows, columns, **options)
    return features.where("_new").drop("_new"), history_state(held, columns, **options)
