"""Dirty job-market inputs derived from the test tables, row for row.

Each function returns one bronze input in its declared text columns. Columns named
``arrival_*`` are not part of the input: they say which of two otherwise equal rows came first
and serve as tie-break where duplicates are removed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

POSTING_ARRIVAL = tuple(f"arrival_{i}" for i in range(1, 7))
BENEFIT_ARRIVAL = ("arrival_1", "arrival_2")
COUNT_ARRIVAL = ("arrival_1",)

# Spellings the stand-ins cycle through.
PAY_PERIODS = ("Per Year", " par mois ", "horaire", "PER WEEK", "journalier", "", "YEARLY")
WORK_TYPES = (
    "Full-time", "TEMPS PARTIEL", " contrat ", "stage", "Intérim", "apprentissage", " ", "Volunteer",
)
LEVELS = (
    "stage", "Junior", "confirmé", "EXPÉRIMENTÉ", "Directeur", "cadre dirigeant", "", "Other",
)
FLAGS = ("1.0", "0", "Yes", "FAUX", "on", "", "maybe", "Oui", "f")
INFERRED = ("1", "vrai", "NO", "1.0", "", " oui ", "faux")


#: A description with line breaks, quotes and commas, made of a plain one.
LONG_DESCRIPTION = """concat('"', replace(description, ' ', ',\n'), '",\n', description, '\n')"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _lines_with_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    part = table(spark, sf_dir, "part")
    return lines.join(part, lines.l_partkey == part.p_partkey)


def _pick(values: tuple[str, ...], index: str) -> str:
    words = ", ".join(f"'{v}'" for v in values)
    return f"get(array({words}), CAST({index} AS INT))"


def _millis(c: str) -> str:
    return f"timestampdiff(MILLISECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', {c})"


def _money(c: str) -> str:
    return f"CAST(CAST({c} AS DECIMAL(12,2)) AS STRING)"


MISSING = "CAST(NULL AS STRING)"
COMPANY_REFERENCE = "IF(l_linenumber = 7, concat('Supplier ', l_suppkey), concat(l_suppkey, '.0'))"
POSTING = {
    "job_id": "CAST(l_orderkey AS STRING)",
    "company_name": COMPANY_REFERENCE,
    "title": "IF(l_linenumber = 6, '  ', concat(' ', p_name, ' '))",
    "description": "p_type",
    "max_salary": f"""CASE l_linenumber WHEN 5 THEN 'n/a' WHEN 4 THEN ''
                      ELSE {_money('l_extendedprice')} END""",
    "med_salary": MISSING,
    "min_salary": "concat(CAST(floor(l_extendedprice / 2) AS BIGINT), '.75')",
    "pay_period": _pick(PAY_PERIODS, "l_partkey % 7"),
    "formatted_work_type": _pick(WORK_TYPES, "l_partkey % 8"),
    "location": "concat(' ', p_brand)",
    "applies": "CAST(l_linenumber AS STRING)",
    "original_listed_time": f"CAST({_millis('l_shipdate')} AS STRING)",
    "remote_allowed": _pick(FLAGS, "l_suppkey % 9"),
    "views": "IF(l_linenumber = 2, 'abc', CAST(l_partkey AS STRING))",
    "job_posting_url": MISSING,
    "application_url": MISSING,
    "application_type": MISSING,
    "expiry": f"CAST({_millis('l_shipdate')} + 30 * 86400000L AS STRING)",
    "closed_time": MISSING,
    "formatted_experience_level": _pick(LEVELS, "l_suppkey % 8"),
    "skills_desc": MISSING,
    "listed_time": f"""CASE WHEN l_linenumber = 3 AND l_partkey % 5 = 0 THEN NULL
                       WHEN l_linestatus = 'F' THEN CAST({_millis('l_shipdate')} AS STRING)
                       ELSE CAST({_millis('l_shipdate')} DIV 1000 AS STRING) END""",
    "posting_domain": MISSING,
    "sponsored": _pick(FLAGS, "l_partkey % 9"),
    "work_type": _pick(WORK_TYPES, "l_partkey % 8"),
    "currency": "'USD'",
    "compensation_type": "'BASE'",
    "arrival_1": "l_linenumber",
    "arrival_2": "l_partkey",
    "arrival_3": "l_suppkey",
    "arrival_4": "l_shipdate",
    "arrival_5": "l_extendedprice",
    "arrival_6": "l_linestatus",
}


def job_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lines_with_part(spark, sf_dir).selectExpr(
        *[f"{value} AS {name}" for name, value in POSTING.items()]
    )


#: What postings are made of.
POSTING_SOURCE = (
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice", "l_shipdate",
    "l_linestatus", "p_name", "p_type", "p_brand",
)
#: The same values under the names that tell which of two equal postings came first.
_ARRIVAL_OF = {value: name for name, value in POSTING.items() if name in POSTING_ARRIVAL}


def posting_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row per row of ``job_postings``: what it is made of, and what postings are dropped by."""
    return _lines_with_part(spark, sf_dir).selectExpr(
        *[f"{c} AS {_ARRIVAL_OF.get(c, c)}" for c in POSTING_SOURCE],
        *[f"{POSTING[c]} AS {c}" for c in ("job_id", "listed_time")],
    )


def as_postings(lines: DataFrame) -> DataFrame:
    """Rows of ``posting_lines`` as rows of ``job_postings``."""
    source = lines.selectExpr(*[f"{_ARRIVAL_OF.get(c, c)} AS {c}" for c in POSTING_SOURCE])
    return source.selectExpr(*[f"{value} AS {name}" for name, value in POSTING.items()])


def posting_companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only the company column of ``job_postings``: a narrow scan, without the join."""
    return table(spark, sf_dir, "lineitem").selectExpr(f"{COMPANY_REFERENCE} AS company_name")


def benefits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lines_with_part(spark, sf_dir).selectExpr(
        "CAST(l_orderkey AS STRING) AS job_id",
        f"{_pick(INFERRED, 'l_linenumber - 1')} AS inferred",
        "IF(l_linenumber % 2 = 1, upper(concat(' ', p_type)), lower(concat(' ', p_type))) AS type",
        "l_linenumber AS arrival_1",
        "l_partkey AS arrival_2",
    )


def employee_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(
        "CAST(user_id + 5 AS STRING) AS company_id",
        f"{_money('value')} AS employee_count",
        "regexp_extract(props, '[0-9]+', 0) AS follower_count",
        f"""CASE WHEN event_id % 11 = 0 THEN NULL
                 WHEN event_id % 2 = 0 THEN CAST({_millis('ts')} AS STRING)
                 ELSE CAST({_millis('ts')} DIV 1000 AS STRING) END AS time_recorded""",
        "event_id AS arrival_1",
    )


def job_skills(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lines_with_part(spark, sf_dir).selectExpr(
        "CAST(l_orderkey AS STRING) AS job_id",
        """CASE WHEN l_linenumber = 7 THEN ' '
                WHEN l_linenumber % 2 = 0 THEN concat(lower(p_brand), ' ')
                ELSE p_brand END AS skill_abr""",
    )


def companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier, nation = table(spark, sf_dir, "supplier"), table(spark, sf_dir, "nation")
    unknown = ("description", "state", "city", "zip_code", "address", "url")
    return supplier.join(nation, supplier.s_nationkey == nation.n_nationkey).selectExpr(
        "s_suppkey AS company_id",
        "concat(' ', s_name, ' ') AS name",
        "s_nationkey % 7 + 1 AS company_size",
        "n_name AS country",
        *[f"{MISSING} AS {c}" for c in unknown],
    )


def job_industries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey AS job_id", "l_partkey % 155 AS industry_id"
    )


def job_industries_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same pairs with the code unknown on open lines, so that some postings have none."""
    return table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey AS job_id", "IF(l_linestatus <> 'O', l_partkey % 155, NULL) AS industry_id"
    )


def company_industries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lines_with_part(spark, sf_dir).selectExpr(
        "l_suppkey AS company_id",
        "IF(l_linenumber % 2 = 1, concat(' ', upper(p_type), ' '), p_type) AS industry",
    )


def company_specialities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lines_with_part(spark, sf_dir).selectExpr(
        "l_suppkey AS company_id", "IF(l_linenumber = 7, '', p_brand) AS speciality"
    )


def as_documents(df: DataFrame) -> DataFrame:
    """Each row as a JSON document holding an array of one record: bronze form, no shuffle."""
    return df.select(F.to_variant_object(F.array(F.struct("*"))).alias("data"))


def packed_documents(df: DataFrame, key: str, per_document: int = 1000) -> DataFrame:
    """Rows with a unique ``key`` as JSON text documents of at most ``per_document`` records."""
    return (
        df.groupBy(F.floor(F.col(key) / per_document).alias("document"))
        .agg(F.to_json(F.collect_list(F.struct(*df.columns))).alias("json"))
    )
