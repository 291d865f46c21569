"""Top-n, overall and per group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RANK = "__rank"


def top_n(df: DataFrame, order: list[Column], n: int) -> DataFrame:
    """First ``n`` rows in ``order``: each task keeps n, only those are merged."""
    return df.orderBy(*order).limit(n)


def top_n_per_group(df: DataFrame, group: list[str], order: list[Column], n: int) -> DataFrame:
    """First ``n`` rows of every group in ``order``.

    Spark limits each group inside the map tasks before the shuffle, so a group that holds most
    of the rows arrives as at most n rows per map task.
    """
    window = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(_RANK, F.row_number().over(window)).where(F.col(_RANK) <= n).drop(_RANK)
