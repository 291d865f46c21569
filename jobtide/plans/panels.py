"""Dashboard panels: the reports with labels, shares, sentences and colours.

Each panel is one plan; its bounded result is all that leaves the cluster.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobtide.functions import display
from jobtide.functions.vocabulary import UNKNOWN_INDUSTRY, has_industry_name, industry_dimension
from jobtide.operators.aggregates import having
from jobtide.operators.joins import lookup_label
from jobtide.operators.ranking import top_n
from jobtide.operators.shares import number_rows, repeat_rows, share_of_total
from jobtide.plans import reports

# Panel lengths.
ROWS_SHOWN = 10
INDUSTRIES_SHOWN = 10


def with_industry_name(df: DataFrame) -> DataFrame:
    """Add ``industry_name`` for ``industry_id``."""
    dimension = industry_dimension(df.sparkSession)
    return lookup_label(df, dimension, "industry_id", "industry_name", UNKNOWN_INDUSTRY)


def industry_names(report: DataFrame) -> DataFrame:
    """Sorted labels that occur in a report with ``industry_id``: the choices of a picker."""
    codes = report.select("industry_id").distinct()
    return with_industry_name(codes).select("industry_name").distinct().orderBy("industry_name")


def title_choices(analytics: DataFrame) -> DataFrame:
    """Choices of the titles panel: labels of industries with a titled posting."""
    return industry_names(having(analytics, "industry_id", "title"))


def salary_choices(analytics: DataFrame) -> DataFrame:
    """Choices of the salary panel: labels of industries with a paid posting."""
    return industry_names(having(analytics, "industry_id", "max_salary"))


def titles_panel(analytics: DataFrame, industry_name: str) -> DataFrame:
    """Top titles under one industry *label*.

    Several codes can share the label; each brings its own top rows, which are ranked again
    together. Only rows of those codes are read.
    """
    chosen = analytics.where(has_industry_name("industry_id", industry_name))
    ranked = reports.top_titles(chosen, "nb_jobs")
    order = [F.desc("nb_jobs"), F.asc("title"), F.asc("industry_id")]
    return top_n(with_industry_name(ranked), order, ROWS_SHOWN)


def salaries_panel(analytics: DataFrame, industry_name: str) -> DataFrame:
    """Best paid titles under one industry label, same treatment."""
    chosen = analytics.where(has_industry_name("industry_id", industry_name))
    ranked = reports.top_paid_titles(chosen, "avg_salary")
    order = [F.desc("avg_salary"), F.asc_nulls_first("title"), F.asc("industry_id")]
    return top_n(with_industry_name(ranked), order, ROWS_SHOWN)


def dominant_company_size(analytics: DataFrame) -> DataFrame:
    """The company size with most postings, and the sentence about it."""
    sizes = reports.counts_by(analytics, ["company_size"], "nb_jobs")
    best = top_n(sizes, [F.desc("nb_jobs"), F.asc("company_size")], 1)
    return best.withColumn("sentence", display.size_sentence(F.col("company_size")))


def busiest_industries(analytics: DataFrame, n: int = INDUSTRIES_SHOWN) -> DataFrame:
    """The ``n`` industries with most postings, labelled, in that order.

    Sorted again after the label join, which need not keep an order; the rows are ``n`` at most.
    """
    top = reports.top_industries(analytics, n).withColumnRenamed("nb_job_postings", "nb_jobs")
    return with_industry_name(top).orderBy(F.desc("nb_jobs"), F.asc("industry_id"))


def industry_share(analytics: DataFrame) -> DataFrame:
    """Share of each listed industry in the listed total, and its whole-percent blocks."""
    shares = share_of_total(busiest_industries(analytics), "nb_jobs")
    shares = shares.withColumn("blocks", display.whole_percent(F.col("pct")))
    return shares.orderBy(F.desc("nb_jobs"), F.asc("industry_id"))


def waffle_blocks(analytics: DataFrame) -> DataFrame:
    """One row per percent block, numbered from 0, largest industry first."""
    blocks = repeat_rows(industry_share(analytics), F.col("blocks"))
    order = [F.desc("nb_jobs"), F.asc("industry_id"), F.asc("block")]
    return number_rows(blocks, order).select(
        "id", F.col("industry_name").alias("industry"), "value"
    )


def waffle_legend(analytics: DataFrame) -> DataFrame:
    """Sorted labels that own at least one block."""
    return (
        industry_share(analytics)
        .where(F.col("blocks") > 0)
        .select(F.col("industry_name").alias("industry"))
        .distinct()
        .orderBy("industry")
    )


def dominant_industry(analytics: DataFrame) -> DataFrame:
    """The industry with most postings, its volume as text, and the sentence about it."""
    return busiest_industries(analytics, 1).select(
        "industry_id",
        "industry_name",
        "nb_jobs",
        display.grouped_digits(F.col("nb_jobs")).alias("volume"),
        display.industry_sentence(F.col("industry_name"), F.col("nb_jobs")).alias("sentence"),
    )


def contract_kpis(analytics: DataFrame) -> DataFrame:
    """One card per contract type: label, volume as text, colour."""
    n = F.col("nb_job_postings")
    return reports.postings_by_contract(analytics).select(
        F.col("formatted_work_type").cast("string").alias("label"),
        n.cast("bigint").alias("value"),
        display.grouped_digits(n).alias("value_text"),
        display.contract_colour(F.col("formatted_work_type")).alias("colour"),
    )
