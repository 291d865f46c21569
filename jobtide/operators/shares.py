"""Shares of a total and their expansion to unit blocks.

These run over the few rows of a finished top-n report. Their windows have no partition key,
so do not feed them an unbounded table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def share_of_total(df: DataFrame, measure: str, name: str = "pct") -> DataFrame:
    """Add ``measure / sum(measure)`` over all rows of ``df``."""
    total = F.sum(measure).over(Window.partitionBy())
    return df.withColumn(name, F.col(measure).cast("double") / total.cast("double"))


def repeat_rows(df: DataFrame, times: Column) -> DataFrame:
    """Each row ``times`` times; zero times drops it. Adds its number ``block`` from 0."""
    repeated = F.posexplode(F.array_repeat(F.lit(1), times)).alias("block", "value")
    return df.select("*", repeated)


def number_rows(df: DataFrame, order: list[Column], name: str = "id") -> DataFrame:
    """Add 0, 1, 2, … in ``order``."""
    return df.withColumn(name, (F.row_number().over(Window.orderBy(*order)) - 1).cast("bigint"))
