"""Profiling: shape, columns, missing cells, first rows, value counts and shares."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnflow.functions.cells import cell, is_missing, literal, stacked


def shape(df: DataFrame) -> DataFrame:
    """One row: number of rows and of columns."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn(
        "n_columns", F.lit(len(df.columns)).cast("bigint")
    )


def column_profile(df: DataFrame) -> DataFrame:
    """One row per column in table order: position from 1, name, type, missing and filled cells."""
    lines = [
        (literal(i), literal(name), literal(kind), f"m{i}", f"n - m{i}")
        for i, (name, kind) in enumerate(df.dtypes, start=1)
    ]
    return df.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count_if(is_missing(df, c)).alias(f"m{i}") for i, c in enumerate(df.columns, start=1)],
    ).select(stacked(("position", "column", "type", "missing", "filled"), lines))


def missing_counts(df: DataFrame) -> DataFrame:
    """One row per column: how many cells are null or not-a-number."""
    return column_profile(df).select("column", "missing")


def head(df: DataFrame, key: str, n: int = 5) -> DataFrame:
    """The first ``n`` rows by ``key``; a table without an order has no other first rows."""
    return df.orderBy(cell(key)).limit(n)


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per non-null value, most frequent first."""
    return (
        df.where(cell(column).isNotNull())
        .groupBy(cell(column).alias("value"))
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.desc("count"), F.asc("value"))
    )


def value_shares(df: DataFrame, column: str) -> DataFrame:
    """Percentage of the non-null rows per value, largest first."""
    counts = value_counts(df, column)
    total = counts.agg(F.sum("count").cast("double")).scalar()
    return counts.select("value", (F.col("count") * 100.0 / total).alias("percent"))


def stored_missing_counts(spark: SparkSession, path: str) -> DataFrame:
    """(column, missing) and, under the name of no column, the rows, of a Parquet table, told by what its files say of themselves.

    Counts of rows and values are pushed down to the files' footers, so no column is read but those of floating point
    numbers, in which not-a-number counts as missing too.
    """
    # A session of its own: the settings are for this look alone.
    session = spark.newSession()
    session.conf.set("spark.sql.sources.useV1SourceList", "")
    session.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    table = session.read.parquet(path)
    counted = footer_counts(table).first()
    floats = [f.name for f in table.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    nans = table.agg(*[F.count_if(F.isnan(cell(c))).alias(c) for c in floats]).first() if floats else {}
    rows = [(c, counted["rows"] - counted[i + 1] + (nans[c] if c in floats else 0)) for i, c in enumerate(table.columns)]
    return spark.createDataFrame([*rows, (None, counted["rows"])], "column string, missing bigint")


def footer_counts(table: DataFrame) -> DataFrame:
    """Rows, and the values of each column."""
    return table.agg(F.count(F.lit(1)).alias("rows"), *[F.count(cell(c)).alias(f"n{i}") for i, c in enumerate(table.columns)])
