"""A small set of input files, written by hand to look like the real ones."""

import json

POSTING = (
    "job_id", "company_name", "title", "description", "max_salary", "med_salary",
    "min_salary", "pay_period", "formatted_work_type", "location", "applies",
    "original_listed_time", "remote_allowed", "views", "job_posting_url", "application_url",
    "application_type", "expiry", "closed_time", "formatted_experience_level", "skills_desc",
    "listed_time", "posting_domain", "sponsored", "work_type", "currency",
    "compensation_type",
)


def posting(**given):
    return [given.get(c, "") for c in POSTING]


def quoted(field):
    if field is None:
        return ""
    if any(ch in field for ch in ',"\n') or field.startswith("<quoted>"):
        return '"' + field.removeprefix("<quoted>").replace('"', '""') + '"'
    return field


def csv_text(header, rows):
    return "\n".join(",".join(quoted(f) for f in r) for r in [header, *rows]) + "\n"


POSTINGS = [
    posting(job_id="1", company_name="10.0", title=" Engineer ", description='he said "hi", ok\nline2',
            max_salary="100.5", pay_period="Per Year", formatted_work_type="temps plein",
            listed_time="1699084930123", remote_allowed="Oui", currency="USD", views="7"),
    posting(job_id="1", company_name="10.0", title="Old title", listed_time="1599084930"),
    posting(job_id="2", company_name="20", title="Nurse", max_salary="50", listed_time="1699084930",
            formatted_work_type="Contract"),
    posting(job_id="3", company_name="Some name", title="Engineer", max_salary="n/a",
            listed_time="1699084931", formatted_work_type="Full-time"),
    posting(job_id="4", company_name="99", title="<quoted>", listed_time="1699084932",
            formatted_work_type="FULL_TIME"),
]
FILES = {
    "job_postings.csv": csv_text(POSTING, POSTINGS),
    "benefits.csv": csv_text(
        ("job_id", "inferred", "type"),
        [("1", "vrai", " Dental "), ("1", "0", "dental"), ("2", "x", "401K")],
    ),
    "employee_counts.csv": csv_text(
        ("company_id", "employee_count", "follower_count", "time_recorded"),
        [("10", "5", "50", "1699000000"), ("10", "6", "60", "1699000001"), ("x", "1", "1", "1")],
    ),
    "job_skills.csv": csv_text(
        ("job_id", "skill_abr"),
        [("1", "it"), ("1", " IT "), ("2", "HCPR"), ("3", "IT"), ("3", " "), ("bad", "IT")],
    ),
    "companies.json": json.dumps(
        [
            {"company_id": 10, "name": " Acme ", "company_size": 3, "country": "FR"},
            {"company_id": "20", "name": "Beta", "company_size": None, "country": ""},
            {"name": "no id"},
        ]
    ),
    "job_industries.json": json.dumps(
        [
            {"job_id": 1, "industry_id": 43}, {"job_id": 1, "industry_id": 43},
            {"job_id": 1, "industry_id": 149}, {"job_id": 2, "industry_id": 14},
            {"job_id": 3, "industry_id": None}, {"job_id": 4, "industry_id": 999},
        ]
    ),
    "company_industries.json": json.dumps(
        [{"company_id": 10, "industry": " Banking "}, {"company_id": 10, "industry": "banking"}]
    ),
    "company_specialities.json": json.dumps(
        [{"company_id": 10, "speciality": "Loans"}, {"company_id": 20, "speciality": ""}]
    ),
}


def write_files(folder):
    for name, text in FILES.items():
        (folder / name).write_text(text, encoding="utf-8")
    return str(folder)


def write_folders(folder):
    """The same files, each in a folder named after its table."""
    for name, text in FILES.items():
        table = folder / name.split(".")[0]
        table.mkdir(parents=True)
        (table / name).write_text(text, encoding="utf-8")
    return str(folder)
