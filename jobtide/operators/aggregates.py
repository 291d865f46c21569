"""Counts, means and coverage. All are partially aggregated before they are shuffled."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def having(df: DataFrame, *columns: str) -> DataFrame:
    """Rows that have all ``columns``.

    Plain null tests, which Spark pushes into the Parquet scan and through joins (an outer join
    whose other side is required becomes an inner one); ``dropna`` is pushed nowhere.
    """
    for column in columns:
        df = df.where(F.col(column).isNotNull())
    return df


def coverage(df: DataFrame, column: str) -> DataFrame:
    """One row: how many rows there are, and how many have ``column``."""
    return df.agg(
        F.count("*").alias("total"), F.count(column).alias(f"non_null_{column}")
    )


def counts_by(df: DataFrame, keys: list[str], name: str = "nb_job_postings") -> DataFrame:
    """Rows per key, over the rows that have all ``keys``."""
    return having(df, *keys).groupBy(*keys).agg(F.count("*").alias(name))


def distinct_counts_by(
    df: DataFrame, key: str, counted: str, name: str = "nb_job_postings"
) -> DataFrame:
    """Exact number of different ``counted`` values per ``key``.

    Spark spreads this over (key, counted) first, so one dominant key is no single task.
    """
    return (
        having(df, key)
        .groupBy(key)
        .agg(F.countDistinct(counted).alias(name))
    )


def rounded_mean(c: Column) -> Column:
    """Mean of whole numbers rounded half away from zero, as DOUBLE.

    The sum stays an exact decimal; dividing once at the end avoids rounding first to the four
    digits of a decimal average and then again to none.
    """
    return F.round(F.sum(c).cast("double") / F.count(c), 0)
