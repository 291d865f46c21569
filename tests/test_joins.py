import random

import pytest
from pyspark.sql import functions as F

from jobtide.operators.joins import heavy_keys, lookup_label, salted_left_join


@pytest.fixture(scope="module")
def tables(spark):
    """A third of the rows share key 1, a third have no key; key 3 repeats on the right."""
    rng = random.Random(7)
    keys = [1] * 300 + [None] * 300 + [rng.randint(2, 60) for _ in range(300)]
    left = spark.createDataFrame([(i, k) for i, k in enumerate(keys)], "id int, k bigint")
    right = spark.createDataFrame(
        [(k, f"c{k}") for k in range(1, 40)] + [(3, "again"), (None, "nobody")], "rk bigint, name string"
    )
    return left, right


def joined(df):
    return sorted((tuple(r) for r in df.select("id", "k", "name").collect()), key=repr)


@pytest.mark.parametrize("rows_per_salt", [1, 10, 100, 10_000])
@pytest.mark.parametrize("broadcast", ["-1", "10485760"])
def test_salted_join_equals_plain_join(spark, tables, rows_per_salt, broadcast):
    left, right = tables
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        heavy = heavy_keys(left, F.col("k"), rows_per_salt)
        salted = salted_left_join(left, right, F.col("k"), "rk", heavy, ["id"])
        plain = left.join(right, F.col("k") == F.col("rk"), "left")
        assert salted.columns == ["id", "k", "name"]
        assert joined(salted) == joined(plain)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_heavy_keys_are_sized(tables):
    left, _ = tables
    heavy = {r[0]: r[1] for r in heavy_keys(left, F.col("k"), 10).collect()}
    assert heavy[1] == 30 and None not in heavy
    fanned = {r[0]: r[1] for r in heavy_keys(left, F.col("k"), 10, fan_out=4.0).collect()}
    assert fanned[1] == 120 and set(heavy) <= set(fanned)


def test_no_heavy_key_is_left_out(spark):
    """1,500 keys above the limit: all are listed; the list is bounded by a share of the rows."""
    left = spark.range(4500).select(F.col("id"), (F.col("id") % 1500).alias("k"))
    assert heavy_keys(left, F.col("k"), 2).count() == 1500
    one = spark.range(200_000).select(F.when(F.col("id") < 1000, 0).otherwise(F.col("id")).alias("k"))
    assert [tuple(r) for r in heavy_keys(one, F.col("k"), 1).collect()] == [(0, 50)]


def test_hot_and_null_keys_are_spread(spark, tables):
    left, right = tables
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        heavy = heavy_keys(left, F.col("k"), 5)
        salted = salted_left_join(left, right, F.col("k"), "rk", heavy, ["id"])
        sizes = salted.groupBy(F.spark_partition_id()).count().collect()
        assert max(r[1] for r in sizes) < salted.count() / 3
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)


def test_lookup_default(spark):
    dimension = spark.createDataFrame([(1, "one")], "c int, label string")
    codes = spark.createDataFrame([(1,), (2,), (None,)], "c int")
    got = {r.c: r.label for r in lookup_label(codes, dimension, "c", "label", "Other").collect()}
    assert got == {1: "one", 2: "Other", None: "Other"}
