"""Silver layer: typed, cleaned, deduplicated tables, one function per table."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobtide import schemas
from jobtide.functions import parsing as p
from jobtide.functions import vocabulary as v
from jobtide.operators.dedup import distinct_rows, latest_per_key, one_per_key
from jobtide.operators.flatten import flatten_records

TieBreak = Sequence[str | Column] | None

_TRIMMED = ("company_name", "title", "location")
_NUMBERS = ("max_salary", "med_salary", "min_salary", "applies", "views")
_EPOCHS = ("original_listed_time", "expiry", "closed_time", "listed_time")
_FLAGS = ("remote_allowed", "sponsored")
_VOCABULARIES = {
    "pay_period": v.PAY_PERIOD,
    "formatted_work_type": v.FORMATTED_WORK_TYPE,
    "formatted_experience_level": v.EXPERIENCE_LEVEL,
    "work_type": v.WORK_TYPE,
}


def clean_posting_column(name: str, on_bad_id: str = "fail", on_bad_epoch: str = "fail") -> Column:
    """Cleaned form of one raw posting column; columns without a rule pass through."""
    if name == "job_id":
        return p.strict_id(name, on_bad_id)
    if name in _TRIMMED:
        return p.clean_text(name)
    if name in _NUMBERS:
        return p.clean_number(name)
    if name in _EPOCHS:
        return p.epoch_to_ts(name, on_bad_epoch)
    if name in _FLAGS:
        return p.robust_boolean(name)
    if name in _VOCABULARIES:
        return v.normalize(name, _VOCABULARIES[name])
    return F.col(name)


def latest_postings(
    bronze: DataFrame,
    tie_break: TieBreak = None,
    undated: str = "first",
    key: Sequence[str | Column] = ("job_id",),
) -> DataFrame:
    """Raw postings, the most recently listed one of each job.

    Jobs are told apart by the raw text id, so ``'1'`` and ``'01'`` are two jobs; pass
    ``key=[safe_id("job_id")]`` to treat them as one.
    """
    return latest_per_key(bronze, list(key), p.recency("listed_time"), undated, tie_break)


def job_postings(
    bronze: DataFrame,
    tie_break: TieBreak = None,
    undated: str = "first",
    on_bad_id: str = "fail",
    on_bad_epoch: str = "fail",
    key: Sequence[str | Column] = ("job_id",),
    form: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """One clean row per job. Rows are dropped first, so that only kept ones are cleaned.

    Where the declared columns are made of fewer or narrower ones, ``bronze`` may hold those, with
    what rows are dropped by, and ``form`` makes the declared columns of kept rows: rows that are
    dropped, and those that are moved and sorted to find them, are then never made in full.
    """
    kept = latest_postings(bronze, tie_break, undated, key)
    if form is not None:
        kept = form(kept)
    return kept.select(
        *[
            clean_posting_column(c, on_bad_id, on_bad_epoch).alias(c)
            for c in schemas.JOB_POSTINGS
        ]
    )


def benefits(bronze: DataFrame, tie_break: TieBreak = None, on_bad_id: str = "fail") -> DataFrame:
    """One row per job and benefit type, types compared trimmed and case-blind."""
    kept = one_per_key(bronze, ["job_id", F.lower(F.trim("type"))], tie_break)
    return kept.select(
        p.strict_id("job_id", on_bad_id).alias("job_id"),
        p.list_boolean("inferred").alias("inferred"),
        p.clean_text("type").alias("type"),
    )


def companies(bronze: DataFrame, on_bad: str = "fail") -> DataFrame:
    """One row per company record; repeated ids are kept."""
    raw = flatten_records(bronze, schemas.COMPANIES, on_bad)
    as_read = ("company_id", "description", "company_size")
    return raw.select(
        *[(F.col(c) if c in as_read else p.clean_text(c)).alias(c) for c in schemas.COMPANIES]
    )


def latest_counts(
    bronze: DataFrame, tie_break: TieBreak = None, undated: str = "first"
) -> DataFrame:
    """Raw head counts, the most recently recorded one of each company number."""
    return latest_per_key(
        bronze,
        [p.safe_number("company_id")],
        p.safe_number("time_recorded"),
        undated,
        tie_break,
    )


def employee_counts(
    bronze: DataFrame,
    tie_break: TieBreak = None,
    undated: str = "first",
    on_bad_epoch: str = "fail",
) -> DataFrame:
    """Latest head count of each company."""
    return latest_counts(bronze, tie_break, undated).select(
        p.safe_number("company_id").alias("company_id"),
        p.clean_number("employee_count").alias("employee_count"),
        p.clean_number("follower_count").alias("follower_count"),
        p.epoch_to_ts("time_recorded", on_bad_epoch).alias("time_recorded"),
    )


def job_skills(bronze: DataFrame) -> DataFrame:
    """Distinct (job, skill) pairs, skills in upper case."""
    return distinct_rows(
        bronze,
        p.safe_number("job_id").alias("job_id"),
        p.upper_label("skill_abr").alias("skill_abr"),
    )


def job_industries(bronze: DataFrame, on_bad: str = "fail") -> DataFrame:
    """Distinct (job, industry code) pairs."""
    return distinct_rows(flatten_records(bronze, schemas.JOB_INDUSTRIES, on_bad), "job_id", "industry_id")


def company_industries(bronze: DataFrame, on_bad: str = "fail") -> DataFrame:
    """Distinct (company, industry) pairs, industries in lower case."""
    raw = flatten_records(bronze, schemas.COMPANY_INDUSTRIES, on_bad)
    return distinct_rows(raw, "company_id", p.lower_label("industry").alias("industry"))


def company_specialities(bronze: DataFrame, on_bad: str = "fail") -> DataFrame:
    """Distinct (company, speciality) pairs, specialities in lower case."""
    raw = flatten_records(bronze, schemas.COMPANY_SPECIALITIES, on_bad)
    return distinct_rows(raw, "company_id", p.lower_label("speciality").alias("speciality"))
