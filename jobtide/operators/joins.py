"""Left outer joins that stay balanced when a few keys dominate, and code -> label lookup."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROWS_PER_SALT = 1_000_000
#: No salt is smaller than this part of all rows, so at most so many keys can be heavy.
PARTS = 10_000
_KEY, _SALT, _SALTS = "__key", "__salt", "__salts"


def heavy_keys(
    df: DataFrame,
    key: Column,
    rows_per_salt: int = ROWS_PER_SALT,
    fan_out: Column | float = 1.0,
) -> DataFrame:
    """The keys that own too many rows for one salt, and how many salts each should get.

    A salt holds ``rows_per_salt`` rows, or a ``PARTS``-th of all rows if that is more. So fewer
    than ``PARTS`` keys are heavy whatever the input: the list is small by construction, and no key
    is left out of it. Only the key column is read, and it is counted before it is shuffled.

    ``fan_out`` is by how much rows multiply before the join; counts are taken times it.
    """
    keys = df.select(key.alias(_KEY)).where(F.col(_KEY).isNotNull())
    part = keys.select(F.count("*") / F.lit(float(PARTS))).scalar()
    rows = F.col("__n") * F.lit(fan_out) if isinstance(fan_out, (int, float)) else F.col("__n") * fan_out
    salt = F.greatest(F.lit(float(rows_per_salt)), part)
    return (
        keys.groupBy(_KEY)
        .agg(F.count("*").alias("__n"))
        .select(_KEY, rows.alias("__rows"), salt.alias("__per_salt"))
        .where(F.col("__rows") > F.col("__per_salt"))
        .select(_KEY, F.ceil(F.col("__rows") / F.col("__per_salt")).cast("int").alias(_SALTS))
    )


def salted_left_join(
    left: DataFrame,
    right: DataFrame,
    left_key: Column,
    right_key: str,
    heavy: DataFrame,
    spread_by: list[str],
) -> DataFrame:
    """``left LEFT JOIN right ON left_key = right_key`` with heavy left keys cut into salts.

    Left rows of a heavy key are dealt over its salts by a hash of ``spread_by`` (stable, so a
    recomputed task deals them the same way); the matching right rows, and only those, are
    repeated once per salt. NULL keys match nothing and are dealt over all partitions.

    ``heavy`` comes from ``heavy_keys`` over ``left`` or any relation with the same keys. It only
    steers where rows go: keys missing from it, or listed though they are light, change nothing
    in the result. Keys just below the limit are left to adaptive execution, which splits
    oversized partitions of the left side. ``right_key`` is dropped from the result.
    """
    heavy = F.broadcast(heavy)  # fewer than PARTS rows by construction, see heavy_keys
    spread = F.xxhash64(*spread_by)
    salted_left = (
        left.withColumn(_KEY, left_key)
        .join(heavy, _KEY, "left")
        .withColumn(
            _SALT,
            F.when(F.col(_KEY).isNull(), spread).otherwise(
                F.pmod(spread, F.coalesce(F.col(_SALTS), F.lit(1)).cast("bigint"))
            ),
        )
        .drop(_SALTS)
    )
    last_salt = F.coalesce(F.col(_SALTS), F.lit(1)).cast("bigint") - 1
    salted_right = (
        right.where(F.col(right_key).isNotNull())
        .withColumnRenamed(right_key, _KEY)
        .join(heavy, _KEY, "left")
        .withColumn(_SALT, F.explode(F.sequence(F.lit(0).cast("bigint"), last_salt)))
        .drop(_SALTS)
    )
    return salted_left.join(salted_right, [_KEY, _SALT], "left").drop(_KEY, _SALT)


def lookup_label(
    df: DataFrame, dimension: DataFrame, key: str, label: str, default: str
) -> DataFrame:
    """Add ``label`` from a fixed small ``dimension``; codes it does not know get ``default``.

    The dimension is joined without a hint: a local relation carries its exact size, so Spark
    broadcasts it by the session's own threshold.
    """
    return (
        df.join(dimension, key, "left")
        .withColumn(label, F.coalesce(F.col(label), F.lit(default)))
    )
