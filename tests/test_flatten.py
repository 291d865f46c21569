import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from jobtide import schemas
from jobtide.operators.flatten import explode_elements, flatten_records
from jobtide.plans import silver


def documents(spark, *texts):
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    return df.select(F.parse_json("text").alias("data"))


def test_elements_of_all_documents(spark):
    df = documents(spark, '[{"a":1},{"a":2}]', "[]", "null", None, '[{"a":3}]', "7")
    got = explode_elements(df).select(F.variant_get("value", "$.a", "int")).collect()
    assert sorted(r[0] for r in got) == [1, 2, 3]


def test_fields_missing_null_and_rounded(spark):
    df = documents(
        spark,
        '[{"job_id": 1, "industry_id": 2.5}, {"job_id": "7", "industry_id": null}, {"industry_id": 4}]',
    )
    got = {tuple(r) for r in flatten_records(df, schemas.JOB_INDUSTRIES).collect()}
    assert got == {(1, 3), (7, None), (None, 4)}


def test_bad_value_fails_or_is_null(spark):
    df = documents(spark, '[{"job_id": "x", "industry_id": 1}]')
    with pytest.raises(PySparkException):
        flatten_records(df, schemas.JOB_INDUSTRIES).collect()
    lenient = flatten_records(df, schemas.JOB_INDUSTRIES, on_bad="null").collect()
    assert [tuple(r) for r in lenient] == [(None, 1)]


def test_record_rows_give_the_same(spark):
    rows = spark.createDataFrame([("1", "2.5"), ("7", None)], "job_id string, industry_id string")
    got = {tuple(r) for r in flatten_records(rows, schemas.JOB_INDUSTRIES).collect()}
    assert got == {(1, 3), (7, None)}
    bad = spark.createDataFrame([("x", "y")], "job_id string, industry_id string")
    with pytest.raises(PySparkException):
        flatten_records(bad, schemas.JOB_INDUSTRIES).collect()
    assert [tuple(r) for r in flatten_records(bad, schemas.JOB_INDUSTRIES, "null").collect()] == [(None, None)]


def test_companies_are_cleaned_and_not_deduplicated(spark):
    doc = (
        '[{"company_id": 5, "name": " A ", "description": " d ", "company_size": 3, "country": "",'
        ' "zip_code": 75001}, {"company_id": 5, "name": "A"}]'
    )
    got = silver.companies(documents(spark, doc)).orderBy(F.col("country").asc_nulls_first(), "name").collect()
    assert len(got) == 2 and {r.company_id for r in got} == {5}
    first = next(r for r in got if r.description)
    assert (first.name, first.description, first.company_size) == ("A", " d ", 3)
    assert first.country is None and first.zip_code == "75001" and first.state is None


def test_pairs_are_distinct_after_folding(spark):
    doc = '[{"company_id": 1, "industry": " IT "}, {"company_id": 1, "industry": "it"}, {"company_id": 1, "industry": " "}]'
    got = {tuple(r) for r in silver.company_industries(documents(spark, doc)).collect()}
    assert got == {(1, "it"), (1, None)}


def test_the_callers_columns_stay(spark):
    from jobtide.operators.flatten import explode_elements

    df = spark.sql("SELECT 1 AS key, 2 AS pos, parse_json('[5, 6]') AS data")
    assert sorted((r.key, r.pos) for r in explode_elements(df).select("key", "pos").collect()) == [(1, 2), (1, 2)]
