"""Looking at tables: counts, types, missing values, distinct values, statistics."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, NumericType

from shelfwise.operators.quantiles import quantile_columns


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count of each table, rows (table, rows)."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table"), "rows")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def catalog_counts(spark: SparkSession, names: Sequence[str]) -> DataFrame:
    """Row count of catalog tables and views, rows (table, rows)."""
    return table_counts({name: spark.table(name) for name in names})


def describe_schema(df: DataFrame) -> DataFrame:
    """Column names and types in order."""
    rows = [(i, name, kind) for i, (name, kind) in enumerate(df.dtypes, start=1)]
    return df.sparkSession.createDataFrame(rows, "position int, column string, type string")


def null_counts(df: DataFrame) -> DataFrame:
    """Missing values per column, not-a-number included: rows (column, nulls)."""

    def missing(field):
        col = F.col(f"`{field.name}`")
        is_float = isinstance(field.dataType, FloatType | DoubleType)
        return col.isNull() | F.isnan(col) if is_float else col.isNull()

    counts = [F.count_if(missing(f)).alias(f.name) for f in df.schema.fields]
    return df.agg(*counts).unpivot([], df.columns, "column", "nulls")


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """Distinct values of a column, null included."""
    return df.select(column).distinct()


def n_distinct(df: DataFrame, column: str, exact: bool = True) -> DataFrame:
    """Number of distinct values, null excluded; a sketch if ``exact`` is off."""
    if not exact:
        return df.agg(F.approx_count_distinct(column).alias("distinct"))
    # Counting de-duplicated rows keeps every value's set off a single task.
    known = df.select(column).where(F.col(column).isNotNull()).distinct()
    return known.agg(F.count(F.lit(1)).alias("distinct"))


def numeric_columns(df: DataFrame) -> list[str]:
    """Names of all numeric columns, keys included."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]


def describe(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Count, mean, deviation, minimum, quartiles and maximum: one row per column."""
    cols = list(cols or numeric_columns(df))
    moments = {"mean": "avg(value)", "std": "stddev_samp(value)", "min": "min(value)", "max": "max(value)"}
    names = ("q25", "q50", "q75")
    found = quantile_columns(df, cols, (0.25, 0.5, 0.75), names, extra=moments)
    return found.withColumnRenamed("n", "count").select("column", "count", "mean", "std", "min", *names, "max")


def key_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values that occur more than once."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("count")).where("count > 1")


def value_counts(df: DataFrame, column: str, k: int = 10) -> DataFrame:
    """The ``k`` most frequent values, null excluded, ties in value order."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(
        F.count(F.lit(1)).alias("count")
    )
    return counts.orderBy(F.desc("count"), column).limit(k)
