"""Market reports over the gold tables. Ties are settled by label, so results are repeatable."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobtide.operators.aggregates import (
    counts_by,
    coverage,
    distinct_counts_by,
    having,
    rounded_mean,
)
from jobtide.operators.ranking import top_n, top_n_per_group

# Report lengths.
TITLES_PER_INDUSTRY = 10
INDUSTRIES_LISTED = 30
SKILLS_LISTED = 10


def industry_coverage(analytics: DataFrame) -> DataFrame:
    """All rows, and rows with an industry."""
    return coverage(analytics, "industry_id")


def company_size_coverage(analytics: DataFrame) -> DataFrame:
    """All rows, and rows with a known company size."""
    return coverage(analytics, "company_size")


def top_titles(analytics: DataFrame, measure: str = "nb_job_postings") -> DataFrame:
    """The most posted titles of each industry, unsorted."""
    counted = counts_by(analytics, ["industry_id", "title"], measure)
    order = [F.desc(measure), F.asc("title")]
    return top_n_per_group(counted, ["industry_id"], order, TITLES_PER_INDUSTRY)


def top_paid_titles(analytics: DataFrame, measure: str = "avg_max_salary") -> DataFrame:
    """The best paid titles of each industry, unsorted; postings without title form a group."""
    paid = (
        having(analytics, "industry_id", "max_salary")
        .groupBy("industry_id", "title")
        .agg(rounded_mean(F.col("max_salary")).alias(measure))
    )
    order = [F.desc(measure), F.asc_nulls_first("title")]
    return top_n_per_group(paid, ["industry_id"], order, TITLES_PER_INDUSTRY)


def top_titles_per_industry(analytics: DataFrame) -> DataFrame:
    """``top_titles`` in reading order."""
    return top_titles(analytics).orderBy("industry_id", F.desc("nb_job_postings"), "title")


def top_paid_titles_per_industry(analytics: DataFrame) -> DataFrame:
    """``top_paid_titles`` in reading order."""
    return top_paid_titles(analytics).orderBy(
        "industry_id", F.desc("avg_max_salary"), F.asc_nulls_first("title")
    )


def postings_by_company_size(analytics: DataFrame) -> DataFrame:
    return counts_by(analytics, ["company_size"]).orderBy("company_size")


def companies_by_size(profiles: DataFrame) -> DataFrame:
    return counts_by(profiles, ["company_size"], "nb_companies").orderBy("company_size")


def top_industries(analytics: DataFrame, n: int = INDUSTRIES_LISTED) -> DataFrame:
    """The ``n`` industries with most postings."""
    counted = counts_by(analytics, ["industry_id"])
    return top_n(counted, [F.desc("nb_job_postings"), F.asc("industry_id")], n)


def postings_by_contract(analytics: DataFrame) -> DataFrame:
    return counts_by(analytics, ["formatted_work_type"]).orderBy(
        F.desc("nb_job_postings"), "formatted_work_type"
    )


def top_skills(job_skills: DataFrame, n: int = SKILLS_LISTED) -> DataFrame:
    """The ``n`` skills asked for by most jobs."""
    counted = distinct_counts_by(job_skills, "skill_abr", "job_id")
    return top_n(counted, [F.desc("nb_job_postings"), F.asc("skill_abr")], n)
