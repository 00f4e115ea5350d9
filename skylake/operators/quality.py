"""Data-quality checks. Each returns the violations (or one summary row) as a DataFrame."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skylake.functions.numeric import nan_to_null


def _value(df: DataFrame, column: str) -> Column:
    """The column with NaN as NULL: both are missing."""
    floating = isinstance(df.schema[column].dataType, (T.DoubleType, T.FloatType))
    return nan_to_null(column) if floating else F.col(column)


def duplicates(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once, with their count."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(column).agg(F.count(F.lit(1)).alias("n_records")).where("n_records > 1")
    )


def missing(df: DataFrame, column: str) -> DataFrame:
    return df.where(_value(df, column).isNull())


def primary_key_violations(df: DataFrame, column: str) -> DataFrame:
    """Key values that are missing or repeated."""
    return (
        df.groupBy(column).agg(F.count(F.lit(1)).alias("n_records"))
        .where((F.col("n_records") > 1) | F.col(column).isNull())
    )


def _by_column(df: DataFrame, summaries: list, value: str) -> DataFrame:
    names = F.array(*[F.lit(c) for c in df.columns])
    one_row = df.agg(F.array(*summaries).alias("__v"))
    return one_row.select(F.explode(F.arrays_zip(names.alias("column_name"), F.col("__v").alias(value))).alias("r")) \
        .select("r.column_name", f"r.{value}")


def completeness(df: DataFrame) -> DataFrame:
    """Share of values that are neither NULL nor NaN per column, in one pass: (column_name, ratio)."""
    return _by_column(df, [F.count(_value(df, c)) / F.count(F.lit(1)) for c in df.columns], "ratio")


def columns_with_nulls(df: DataFrame) -> DataFrame:
    """Whether each column holds any NULL or NaN, in one pass: (column_name, has_null)."""
    return _by_column(df, [F.coalesce(F.bool_or(_value(df, c).isNull()), F.lit(False)) for c in df.columns], "has_null")


def column_mismatches(df: DataFrame, expected: list[str]) -> DataFrame:
    """Positions at which the columns differ from the expected ones: (position, found, expected)."""
    n = max(len(df.columns), len(expected))
    pairs = [(k, *(names[k] if k < len(names) else None for names in (df.columns, expected))) for k in range(n)]
    return df.sparkSession.createDataFrame([p for p in pairs if p[1] != p[2]], "position int, found string, expected string")


def require_columns(df: DataFrame, expected: list[str]) -> None:
    if df.columns != list(expected):
        raise ValueError(f"columns {df.columns} do not match {list(expected)}")


def unmatched_names(fact: DataFrame, lookup: DataFrame, on: str) -> DataFrame:
    """Distinct fact names without an equal lookup name (rows an exact join drops), with counts."""
    names = fact.groupBy(on).agg(F.count(F.lit(1)).alias("n_records"))
    return names.join(lookup.select(on).distinct(), on, "left_anti")
