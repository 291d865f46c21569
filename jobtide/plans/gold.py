"""Gold layer: business-ready tables. Filters and projections reach the silver Parquet scan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobtide import schemas
from jobtide.functions.parsing import safe_id
from jobtide.operators.aggregates import having
from jobtide.operators.joins import heavy_keys, salted_left_join

# Columns of the gold tables, in order.
_PROFILE = (
    "company_id", "name", "company_size", "city", "state", "country",
    "employee_count", "follower_count",
)
_FROM_POSTING = (
    "job_id", "title", "formatted_work_type", "work_type", "remote_allowed",
    "formatted_experience_level", "min_salary", "med_salary", "max_salary", "currency",
    "listed_time",
)
ANALYTICS = (
    "job_id", "title", "company_name", "formatted_work_type", "work_type", "remote_allowed",
    "formatted_experience_level", "min_salary", "med_salary", "max_salary", "currency",
    "industry_id", "company_size", "country", "listed_time",
)


def job_postings(silver: DataFrame) -> DataFrame:
    """Postings that have an id."""
    return having(silver.select(*schemas.JOB_POSTINGS), "job_id")


def job_industries(silver: DataFrame) -> DataFrame:
    """Complete (job, industry) pairs."""
    return having(silver.select("job_id", "industry_id"), "job_id", "industry_id")


def job_skills(silver: DataFrame) -> DataFrame:
    """Complete (job, skill) pairs."""
    return having(silver.select("job_id", "skill_abr"), "job_id", "skill_abr")


def company_profile(companies: DataFrame, employee_counts: DataFrame) -> DataFrame:
    """Companies with their latest head count, NULL where there is none.

    The counts' exact-number key is narrowed to BIGINT, which joins faster; numbers beyond
    BIGINT cannot equal a company id and are dropped before the join.
    """
    counts = employee_counts.select(
        F.col("company_id").try_cast("bigint").alias("company_id"),
        "employee_count",
        "follower_count",
    )
    return (
        having(companies, "company_id")
        .join(having(counts, "company_id"), "company_id", "left")
        .select(*_PROFILE)
    )


def company_number(column: str = "company_name"):
    """The company id a posting holds as text; NULL where the text is no number."""
    return safe_id(column)


def industries_per_posting(industries: DataFrame) -> Column:
    """How many industries a job that has any has on average, as a scalar."""
    jobs = industries.groupBy("job_id").agg(F.count("*").alias("n"))
    return jobs.select(F.coalesce(F.avg("n"), F.lit(1.0))).scalar()


def job_analytics(
    postings: DataFrame,
    industries: DataFrame,
    profiles: DataFrame,
    heavy_companies: DataFrame | None = None,
) -> DataFrame:
    """Postings x their industries, with the company's name, size and country.

    One row per (posting, industry), and once more for every repeated company id; postings
    without industry or company stay. Many postings share one company or name none at all, so
    the company join is salted. ``heavy_companies`` are the ``heavy_keys`` to salt; counts over
    any relation that contains the postings will do, e.g. the raw ones, with the ``fan_out`` of
    ``industries_per_posting``, as salts are dealt after postings met their industries.
    """
    if heavy_companies is None:
        heavy_companies = heavy_keys(
            postings, company_number(), fan_out=industries_per_posting(industries)
        )
    company = profiles.select(
        "company_id", F.col("name").alias("company_name"), "company_size", "country"
    )
    with_industry = postings.select(
        *_FROM_POSTING, company_number().alias("__company")
    ).join(industries.select("job_id", "industry_id"), "job_id", "left")
    return salted_left_join(
        with_industry,
        company,
        F.col("__company"),
        "company_id",
        heavy_companies,
        spread_by=["job_id", "industry_id"],
    ).select(*ANALYTICS)


def by_industry(analytics: DataFrame) -> DataFrame:
    """``job_analytics`` in the order it is stored in: ranges of industries.

    A filter on codes, which reaches the scan, then skips the files and row groups of all others. A
    code with many rows is cut over several ranges by a hash of the job, so no task has it whole.
    """
    spread = F.xxhash64("job_id", "title")
    return analytics.repartitionByRange("industry_id", spread).sortWithinPartitions(
        "industry_id", spread
    )
