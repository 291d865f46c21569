"""Declared columns of the eight inputs. Nothing is inferred from data."""

from __future__ import annotations

from pyspark.sql import types as T

# Column names of the inputs, in file order.
JOB_POSTINGS = (
    "job_id", "company_name", "title", "description", "max_salary", "med_salary",
    "min_salary", "pay_period", "formatted_work_type", "location", "applies",
    "original_listed_time", "remote_allowed", "views", "job_posting_url", "application_url",
    "application_type", "expiry", "closed_time", "formatted_experience_level", "skills_desc",
    "listed_time", "posting_domain", "sponsored", "work_type", "currency",
    "compensation_type",
)
BENEFITS = ("job_id", "inferred", "type")
EMPLOYEE_COUNTS = ("company_id", "employee_count", "follower_count", "time_recorded")
JOB_SKILLS = ("job_id", "skill_abr")

# Fields read from the JSON records, with the kind of value each must hold.
COMPANIES = {
    "company_id": "id", "name": "text", "description": "text", "company_size": "int",
    "state": "text", "country": "text", "city": "text", "zip_code": "text",
    "address": "text", "url": "text",
}
JOB_INDUSTRIES = {"job_id": "id", "industry_id": "int"}
COMPANY_INDUSTRIES = {"company_id": "id", "industry": "text"}
COMPANY_SPECIALITIES = {"company_id": "id", "speciality": "text"}

CSV_TABLES = {
    "job_postings": JOB_POSTINGS,
    "benefits": BENEFITS,
    "employee_counts": EMPLOYEE_COUNTS,
    "job_skills": JOB_SKILLS,
}
JSON_TABLES = {
    "companies": COMPANIES,
    "job_industries": JOB_INDUSTRIES,
    "company_industries": COMPANY_INDUSTRIES,
    "company_specialities": COMPANY_SPECIALITIES,
}
DOCUMENT = T.StructType([T.StructField("data", T.VariantType())])


def text_schema(columns) -> T.StructType:
    """All columns as nullable text: typing is left to the silver layer."""
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])
