"""CSV in and out: snapshots, predictions, feature lists."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepanel.functions.casts import text_to_double
from tidepanel.functions.names import is_money


def _spread(df: DataFrame, path: str) -> DataFrame:
    """A gzip file is read by one task, so the rows of a folder with one are dealt out before anything else happens."""
    return df.hint("rebalance") if any(f.endswith(".gz") for f in df.inputFiles()) else df


def read_csv_inferred(spark: SparkSession, path: str) -> DataFrame:
    """CSV with header, types taken from all values. Costs a pass; give a schema where one is known."""
    return _spread(spark.read.csv(path, header=True, inferSchema=True), path)


def fitting_schema(
    spark: SparkSession, path: str, *, types: Mapping[str, str] | None = None, period: str = "period"
) -> T.StructType:
    """Types that fit all values; integer money columns (by name) become double; ``types`` win over both."""
    types = types or {}
    text = spark.read.csv(path, header=True)

    def fits(kind: str, value) -> F.Column:
        return F.coalesce(F.bool_and(value.isNotNull() | F.col(kind).isNull()), F.lit(True))

    tests = []
    for c in text.columns:
        tests.append(fits(f"`{c}`", F.col(f"`{c}`").try_cast("bigint")))
        tests.append(fits(f"`{c}`", text_to_double(F.col(f"`{c}`"))))
    found = text.agg(*[t.alias(str(i)) for i, t in enumerate(tests)]).first()

    def kind(i: int, name: str) -> T.DataType:
        if name in types:
            return T.DataType.fromDDL(types[name])
        if found[2 * i] and not is_money(name, period):
            return T.LongType()
        return T.DoubleType() if found[2 * i] or found[2 * i + 1] else T.StringType()

    return T.StructType([T.StructField(c, kind(i, c)) for i, c in enumerate(text.columns)])


def read_csv_fitted(
    spark: SparkSession, path: str, *, types: Mapping[str, str] | None = None, period: str = "period"
) -> DataFrame:
    """CSV with the schema that fits all its values (one pass to find it); what does not fit ``types`` is an error."""
    schema = fitting_schema(spark, path, types=types, period=period)
    return _spread(spark.read.csv(path, header=True, schema=schema, mode="FAILFAST"), path)


def write_csv(df: DataFrame, path: str, *, compression: str = "none") -> None:
    df.write.csv(path, header=True, compression=compression)


def prediction_name(base: str, ranks: Sequence[int] = ()) -> str:
    """Output name; hand-picked ranks are marked so they do not replace the full ensemble."""
    return f"{base}_manual" if ranks else base


def write_predictions(
    df: DataFrame, folder: str, base: str, *, ranks: Sequence[int] = (), key: str = "id", flag: str = "predicted"
) -> str:
    """(id, Predicted) as CSV under ``folder``; returns the path."""
    path = f"{folder}/{prediction_name(base, ranks)}"
    write_csv(df.select(F.col(key).alias("id"), F.col(flag).alias("Predicted")), path)
    return path


def read_predictions(spark: SparkSession, path: str) -> DataFrame:
    """(id, score): the score may be stored as ``y_pred`` or ``Predicted``; a value that is no number is an error."""
    names = spark.read.csv(path, header=True).columns
    score = next((c for c in ("y_pred", "Predicted") if c in names), None)
    if score is None:
        raise ValueError(f"{path} has neither y_pred nor Predicted: {names}")
    schema = T.StructType(
        [
            T.StructField(c, T.LongType() if c == "id" else T.DoubleType() if c == score else T.StringType())
            for c in names
        ]
    )
    return spark.read.csv(path, header=True, schema=schema, mode="FAILFAST").select("id", F.col(score).alias("score"))


def write_feature_list(features: DataFrame, path: str, *, feature: str = "feature") -> None:
    """One feature name per line."""
    features.select(feature).write.text(path)


def read_feature_list(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).withColumnRenamed("value", "feature")
