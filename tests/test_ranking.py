from pyspark.sql import functions as F

from jobtide.operators.aggregates import coverage, counts_by, distinct_counts_by, having, rounded_mean
from jobtide.operators.ranking import top_n, top_n_per_group
from jobtide.operators.shares import number_rows, repeat_rows, share_of_total


def test_top_n_per_group_with_ties(spark):
    rows = [("a", i % 3, i) for i in range(9)] + [("b", 1, 1)]
    df = spark.createDataFrame(rows, "g string, m int, v int")
    got = top_n_per_group(df, ["g"], [F.desc("m"), F.asc("v")], 4).orderBy("g", F.desc("m"), "v")
    assert [tuple(r) for r in got.collect()] == [
        ("a", 2, 2), ("a", 2, 5), ("a", 2, 8), ("a", 1, 1), ("b", 1, 1),
    ]


def test_groups_are_limited_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("g"), "id")
    plan = top_n_per_group(df, ["g"], [F.desc("id")], 2)._jdf.queryExecution().executedPlan().toString()
    assert plan.rindex("WindowGroupLimit") > plan.index("Exchange hashpartitioning(g")


def test_top_n_merges_only_the_best(spark):
    plan = top_n(spark.range(100), [F.desc("id")], 3)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_counts(spark):
    df = spark.createDataFrame([(1, "x"), (1, "x"), (1, "y"), (None, "z")], "k int, v string")
    assert {tuple(r) for r in counts_by(df, ["k"], "n").collect()} == {(1, 3)}
    assert {tuple(r) for r in counts_by(df, ["k", "v"], "n").collect()} == {(1, "x", 2), (1, "y", 1)}
    assert [tuple(r) for r in distinct_counts_by(df, "k", "v", "n").collect()] == [(1, 2)]
    assert coverage(df, "k").first().asDict() == {"total": 4, "non_null_k": 3}
    assert having(df, "k", "v").count() == 3


def test_null_tests_are_pushed_to_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(1, "x", 2.0)], "k int, v string, w double").write.parquet(path)
    plan = counts_by(spark.read.parquet(path), ["k", "v"])._jdf.queryExecution().executedPlan().toString()
    assert "IsNotNull(k)" in plan and "IsNotNull(v)" in plan
    assert "ReadSchema: struct<k:int,v:string>" in plan


def test_mean_is_rounded_once(spark):
    df = spark.sql("SELECT CAST(v AS DECIMAL(38,0)) AS v FROM VALUES (1), (2), (NULL) AS t(v)")
    assert df.agg(rounded_mean(F.col("v"))).first()[0] == 2.0
    below_half = spark.range(30_000).select(
        F.when(F.col("id") < 14_999, 1).otherwise(0).cast("decimal(38,0)").alias("v")
    )
    assert below_half.agg(rounded_mean(F.col("v"))).first()[0] == 0.0
    negative = spark.sql("SELECT CAST(v AS DECIMAL(38,0)) AS v FROM VALUES (-1), (-2) AS t(v)")
    assert negative.agg(rounded_mean(F.col("v"))).first()[0] == -2.0


def test_share_repeat_and_number(spark):
    df = spark.createDataFrame([("a", 3), ("b", 1), ("c", 0)], "k string, n int")
    shares = {r.k: r.pct for r in share_of_total(df, "n").collect()}
    assert shares == {"a": 0.75, "b": 0.25, "c": 0.0}
    repeated = repeat_rows(df, F.col("n"))
    assert sorted((r.k, r.block) for r in repeated.collect()) == [("a", 0), ("a", 1), ("a", 2), ("b", 0)]
    numbered = number_rows(repeated, [F.asc("k"), F.asc("block")])
    assert sorted(r.id for r in numbered.collect()) == [0, 1, 2, 3]
