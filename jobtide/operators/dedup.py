"""Duplicate removal.

``row_number() == 1`` makes Spark plan a ``WindowGroupLimit`` *below* the shuffle, so each map
task sends at most one row per key: a key that holds a third of the table reaches its reducer
as one row per map task. ``distinct_rows`` pre-aggregates the same way with a hash aggregate
and needs no sort.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_RANK = "__rank"


def _total_order(df: DataFrame, tie_break: Sequence[str | Column] | None) -> list[Column]:
    """Ascending order over ``tie_break``, by default over every column that can be sorted."""
    if tie_break is None:
        tie_break = [
            f.name
            for f in df.schema.fields
            if not isinstance(f.dataType, (T.VariantType, T.MapType))
        ]
    return [(F.col(c) if isinstance(c, str) else c).asc_nulls_first() for c in tie_break]


def _first_per_key(df: DataFrame, keys: Sequence[str | Column], order: list[Column]) -> DataFrame:
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(_RANK, F.row_number().over(window)).where(F.col(_RANK) == 1).drop(_RANK)


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str | Column],
    recency: Column,
    nulls: str = "first",
    tie_break: Sequence[str | Column] | None = None,
) -> DataFrame:
    """Keep the most recent row of each key.

    ``nulls="first"`` lets an undated row win over dated ones, ``"last"`` lets it lose. Rows of
    equal recency are settled by ``tie_break`` ascending, so the result does not depend on how
    the input was split.
    """
    if nulls not in ("first", "last"):
        raise ValueError(f"nulls must be 'first' or 'last', not {nulls!r}")
    newest = recency.desc_nulls_first() if nulls == "first" else recency.desc_nulls_last()
    return _first_per_key(df, keys, [newest, *_total_order(df, tie_break)])


def one_per_key(
    df: DataFrame,
    keys: Sequence[str | Column],
    tie_break: Sequence[str | Column] | None = None,
) -> DataFrame:
    """Keep one row of each key, the smallest by ``tie_break``; for rows wider than the key."""
    return _first_per_key(df, keys, _total_order(df, tie_break))


def distinct_rows(df: DataFrame, *columns: str | Column) -> DataFrame:
    """Keep one row of each key when the output is the key itself."""
    return df.select(*columns).distinct()
