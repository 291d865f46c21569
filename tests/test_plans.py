"""Shapes of physical plans that must hold at any size."""

import re

import pytest

from workload import registry
from workload import relations as r

QUERIES = registry.QUERIES
WRITING = {
    "changed_files_load", "layer_of_one_generation", "names_follow_rebuilds", "layer_profile",
    "table_changes", "panel_from_stored_layout", "csv_multiline_split", "json_array_split", "csv_bronze_roundtrip", "json_bronze_roundtrip", "json_lines_bronze", "json_records_bronze",
    "incremental_ingest", "bronze_batch_then_stream", "bronze_full_reload", "benefits_bronze",
    "employee_counts_bronze", "company_industries_bronze", "company_specialities_bronze",
    "store_rebuild", "namespaced_row_counts", "current_layer_sql",
}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_automatic_broadcast(spark):
    """As if every table were too large to broadcast by size."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WRITING))
def test_no_pairing_no_python_no_hidden_broadcast(spark, sf_dir, no_automatic_broadcast, name):
    plan = plan_of(QUERIES[name](spark, sf_dir))
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEval", "BatchEvalPython"):
        assert node not in plan
    # The only hinted broadcast is the list of heavy keys, once for each side of the salted join.
    assert plan.count("BroadcastExchange") == (2 if "__salts" in plan else 0)


def test_flagship_is_limited_and_counted_before_each_shuffle(spark, sf_dir):
    plan = plan_of(QUERIES["top_titles_per_industry"](spark, sf_dir))
    assert plan.count("WindowGroupLimit") >= 4
    assert "Partial" in plan and "partial_count" in plan


def test_scan_reads_only_the_columns_a_report_needs(spark, tmp_path, sf_dir):
    from jobtide.plans import reports

    path = str(tmp_path / "analytics")
    QUERIES["gold_job_analytics"](spark, sf_dir).write.parquet(path)
    plan = plan_of(reports.top_industries(spark.read.parquet(path)))
    assert "ReadSchema: struct<industry_id:bigint>" in plan and "IsNotNull(industry_id)" in plan
    assert "TakeOrderedAndProject" in plan


def test_postings_move_as_what_they_are_made_of(spark, sf_dir):
    """The step that drops rows carries no text that is made of other columns."""
    plan = QUERIES["silver_job_postings"](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    below = plan.split("Window [")[1]
    assert " AS job_id" in below and not re.search(r" AS (company_name|pay_period|work_type|expiry|title)#", below)


def test_posting_lines_are_the_postings(spark, sf_dir):
    made = r.as_postings(r.posting_lines(spark, sf_dir))
    postings = r.job_postings(spark, sf_dir)
    assert made.columns == postings.columns
    assert made.exceptAll(postings).isEmpty() and postings.exceptAll(made).isEmpty()
