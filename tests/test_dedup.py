from pyspark.sql import functions as F

from jobtide.operators.dedup import distinct_rows, latest_per_key, one_per_key

ROWS = [
    ("1", 10, "a"), ("1", 20, "b"), ("1", 20, "a"),
    ("01", 5, "c"),
    ("2", None, "d"), ("2", 99, "e"),
    (None, 1, "f"), (None, 2, "g"),
]


def frame(spark):
    return spark.createDataFrame(ROWS, "k string, t int, v string")


def rows(df):
    return {tuple(r) for r in df.collect()}


def test_undated_row_wins_by_default(spark):
    kept = latest_per_key(frame(spark), ["k"], F.col("t"))
    assert rows(kept) == {("1", 20, "a"), ("01", 5, "c"), ("2", None, "d"), (None, 2, "g")}


def test_undated_row_can_lose(spark):
    kept = latest_per_key(frame(spark), ["k"], F.col("t"), nulls="last")
    assert ("2", 99, "e") in rows(kept) and kept.count() == 4


def test_key_expression_and_tie_break(spark):
    kept = latest_per_key(
        frame(spark), [F.col("k").try_cast("int")], F.col("t"), tie_break=[F.col("v")]
    )
    assert rows(kept) == {("1", 20, "a"), ("2", None, "d"), (None, 2, "g")}


def test_result_does_not_depend_on_the_split(spark):
    df = frame(spark)
    expected = rows(latest_per_key(df, ["k"], F.col("t")))
    for n in (1, 3, 7):
        assert rows(latest_per_key(df.repartition(n), ["k"], F.col("t"))) == expected


def test_dedup_is_idempotent(spark):
    once = latest_per_key(frame(spark), ["k"], F.col("t"))
    assert rows(latest_per_key(once, ["k"], F.col("t"))) == rows(once)
    assert once.count() == once.select("k").distinct().count()


def test_one_per_key_takes_the_smallest(spark):
    kept = one_per_key(frame(spark), ["k"], ["v"])
    assert rows(kept) == {("1", 10, "a"), ("01", 5, "c"), ("2", None, "d"), (None, 1, "f")}


def test_distinct_rows(spark):
    assert distinct_rows(frame(spark), "k").count() == 4


def test_rows_are_limited_before_the_shuffle(spark):
    """A hot key leaves every map task as one row: the limit sits below the exchange."""
    kept = latest_per_key(frame(spark).repartition(4), ["k"], F.col("t"))
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    exchange = plan.index("Exchange hashpartitioning(k")
    assert plan.rindex("WindowGroupLimit") > exchange


def test_variant_columns_are_left_out_of_the_order(spark):
    df = spark.sql("SELECT 1 AS k, parse_json('[1]') AS data")
    assert one_per_key(df, ["k"]).count() == 1
