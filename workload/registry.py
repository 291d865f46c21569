"""Registered queries: name -> callable(spark, sf_dir). All run over the whole tables.

Ids, counts and amounts are returned as BIGINT and means as DOUBLE, so that both engines print
the same values.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from contextlib import contextmanager
from functools import wraps

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobtide import schemas
from jobtide.functions import parsing as p
from jobtide.functions import vocabulary as v
from jobtide.operators.flatten import explode_elements, variant_field
from jobtide.operators.joins import heavy_keys
from jobtide.plans import gold, panels, reports, silver
from jobtide.sources import readers
from jobtide.sources.records import largest_file
from jobtide.sources.store import TableStore, files, scratch_path
from jobtide.streaming import ingest
from workload import relations as r

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# The panel of this label mixes two codes.
PANEL_INDUSTRY = "Banking"


def _plain_types(df: DataFrame) -> DataFrame:
    whole = (T.DecimalType, T.IntegerType)
    return df.select(
        *[
            F.col(f.name).cast("bigint").alias(f.name) if isinstance(f.dataType, whole) else f.name
            for f in df.schema.fields
        ]
    )


def query(plan: Query) -> Query:
    """Register ``plan`` under its own name."""

    @wraps(plan)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _plain_types(plan(spark, sf_dir))

    QUERIES[plan.__name__] = run
    return run


# --- expressions ---------------------------------------------------------------------------


@query
def clean_text(spark, sf_dir):
    return r.job_postings(spark, sf_dir).select(
        "job_id", *[p.clean_text(c).alias(c) for c in ("company_name", "title", "location")]
    )


@query
def clean_label(spark, sf_dir):
    return r.job_skills(spark, sf_dir).select(
        "job_id",
        p.upper_label("skill_abr").alias("upper_skill"),
        p.lower_label("skill_abr").alias("lower_skill"),
    )


@query
def clean_number(spark, sf_dir):
    columns = ("max_salary", "med_salary", "min_salary", "applies", "views")
    return r.job_postings(spark, sf_dir).select(
        "job_id", *[p.clean_number(c).alias(c) for c in columns]
    )


@query
def safe_number(spark, sf_dir):
    return r.job_postings(spark, sf_dir).select(
        "company_name", p.safe_number("company_name").alias("company_number")
    )


@query
def strict_id(spark, sf_dir):
    return r.job_postings(spark, sf_dir).select(
        p.strict_id("job_id").alias("job_id"),
        p.strict_id("views", on_bad="null").alias("views_id"),
    )


@query
def safe_boolean(spark, sf_dir):
    return r.job_postings(spark, sf_dir).select(
        "remote_allowed", p.safe_boolean("remote_allowed").alias("flag")
    )


@query
def robust_boolean(spark, sf_dir):
    return r.job_postings(spark, sf_dir).select(
        "job_id",
        p.robust_boolean("remote_allowed").alias("remote_allowed"),
        p.robust_boolean("sponsored").alias("sponsored"),
    )


@query
def list_boolean(spark, sf_dir):
    return r.benefits(spark, sf_dir).select(
        "job_id", "type", p.list_boolean("inferred").alias("inferred")
    )


@query
def epoch_to_ts(spark, sf_dir):
    columns = ("original_listed_time", "expiry", "closed_time", "listed_time")
    return r.job_postings(spark, sf_dir).select(
        "job_id", *[p.epoch_to_ts(c).alias(c) for c in columns]
    )


@query
def epoch_to_ts_counts(spark, sf_dir):
    return r.employee_counts(spark, sf_dir).select(
        "company_id", p.epoch_to_ts("time_recorded").alias("time_recorded")
    )


def _normalized(spark, sf_dir, column, vocabulary):
    return r.job_postings(spark, sf_dir).select(
        "job_id", v.normalize(column, vocabulary).alias(column)
    )


@query
def normalize_pay_period(spark, sf_dir):
    return _normalized(spark, sf_dir, "pay_period", v.PAY_PERIOD)


@query
def normalize_formatted_work_type(spark, sf_dir):
    return _normalized(spark, sf_dir, "formatted_work_type", v.FORMATTED_WORK_TYPE)


@query
def normalize_experience_level(spark, sf_dir):
    return _normalized(spark, sf_dir, "formatted_experience_level", v.EXPERIENCE_LEVEL)


@query
def normalize_work_type(spark, sf_dir):
    return _normalized(spark, sf_dir, "work_type", v.WORK_TYPE)


# --- duplicate removal and flattening --------------------------------------------------------


@query
def latest_posting_per_job(spark, sf_dir):
    kept = silver.latest_postings(r.job_postings(spark, sf_dir), r.POSTING_ARRIVAL)
    return kept.select("job_id", "listed_time", "title", "views")


@query
def latest_posting_undated_last(spark, sf_dir):
    kept = silver.latest_postings(r.job_postings(spark, sf_dir), r.POSTING_ARRIVAL, undated="last")
    return kept.select("job_id", "listed_time", "title", "views")


@query
def latest_count_per_company(spark, sf_dir):
    kept = silver.latest_counts(r.employee_counts(spark, sf_dir), r.COUNT_ARRIVAL)
    return kept.select("company_id", "employee_count", "follower_count", "time_recorded")


@query
def one_benefit_per_job_type(spark, sf_dir):
    return silver.benefits(r.benefits(spark, sf_dir), r.BENEFIT_ARRIVAL)


@query
def distinct_job_skills(spark, sf_dir):
    return silver.job_skills(r.job_skills(spark, sf_dir))


@query
def distinct_job_industries(spark, sf_dir):
    return silver.job_industries(r.job_industries(spark, sf_dir))


@query
def distinct_company_industries(spark, sf_dir):
    return silver.company_industries(r.company_industries(spark, sf_dir))


@query
def distinct_company_specialities(spark, sf_dir):
    return silver.company_specialities(r.company_specialities(spark, sf_dir))


@query
def flatten_companies(spark, sf_dir):
    packed = r.packed_documents(r.companies(spark, sf_dir), "company_id")
    documents = packed.select(F.parse_json("json").alias("data"))
    fields = schemas.COMPANIES.items()
    return explode_elements(documents).select(
        *[variant_field("value", n, kind).alias(n) for n, kind in fields]
    )


# --- silver ----------------------------------------------------------------------------------


@query
def silver_job_postings(spark, sf_dir):
    lines = r.posting_lines(spark, sf_dir)
    return silver.job_postings(lines, r.POSTING_ARRIVAL, form=r.as_postings)


@query
def silver_benefits(spark, sf_dir):
    return silver.benefits(r.benefits(spark, sf_dir), r.BENEFIT_ARRIVAL)


@query
def silver_companies(spark, sf_dir):
    return silver.companies(r.as_documents(r.companies(spark, sf_dir)))


@query
def silver_employee_counts(spark, sf_dir):
    return silver.employee_counts(r.employee_counts(spark, sf_dir), r.COUNT_ARRIVAL)


@query
def silver_job_skills(spark, sf_dir):
    return silver.job_skills(r.job_skills(spark, sf_dir))


@query
def silver_job_industries(spark, sf_dir):
    return silver.job_industries(r.as_documents(r.job_industries(spark, sf_dir)))


@query
def silver_company_industries(spark, sf_dir):
    return silver.company_industries(r.as_documents(r.company_industries(spark, sf_dir)))


@query
def silver_company_specialities(spark, sf_dir):
    return silver.company_specialities(r.as_documents(r.company_specialities(spark, sf_dir)))


# --- gold ------------------------------------------------------------------------------------


@query
def gold_job_postings(spark, sf_dir):
    lines = r.posting_lines(spark, sf_dir)
    return gold.job_postings(silver.job_postings(lines, r.POSTING_ARRIVAL, form=r.as_postings))


@query
def gold_job_industries(spark, sf_dir):
    return gold.job_industries(silver.job_industries(r.job_industries(spark, sf_dir)))


@query
def gold_job_skills(spark, sf_dir):
    return gold.job_skills(silver.job_skills(r.job_skills(spark, sf_dir)))


@query
def gold_company_profile(spark, sf_dir):
    return gold.company_profile(
        silver.companies(r.companies(spark, sf_dir)),
        silver.employee_counts(r.employee_counts(spark, sf_dir), r.COUNT_ARRIVAL),
    )


def _analytics(spark, sf_dir, industries=r.job_industries, **heavy_options):
    heavy = heavy_keys(
        r.posting_companies(spark, sf_dir),
        gold.company_number(),
        fan_out=gold.industries_per_posting(industries(spark, sf_dir)),
        **heavy_options,
    )
    return gold.job_analytics(
        gold_job_postings(spark, sf_dir),
        gold.job_industries(silver.job_industries(industries(spark, sf_dir))),
        gold_company_profile(spark, sf_dir),
        heavy,
    )


@query
def gold_job_analytics(spark, sf_dir):
    return _analytics(spark, sf_dir)


@query
def gold_job_analytics_salted(spark, sf_dir):
    """The same table with a limit so low that the companies really are salted."""
    return _analytics(spark, sf_dir, rows_per_salt=100)


# --- reports ---------------------------------------------------------------------------------


@query
def coverage_industry(spark, sf_dir):
    return reports.industry_coverage(_analytics(spark, sf_dir, r.job_industries_gaps))


@query
def coverage_company_size(spark, sf_dir):
    return reports.company_size_coverage(_analytics(spark, sf_dir, r.job_industries_gaps))


@query
def top_titles_per_industry(spark, sf_dir):
    return reports.top_titles_per_industry(_analytics(spark, sf_dir))


@query
def top_paid_titles_per_industry(spark, sf_dir):
    return reports.top_paid_titles_per_industry(_analytics(spark, sf_dir))


@query
def postings_by_company_size(spark, sf_dir):
    return reports.postings_by_company_size(_analytics(spark, sf_dir))


@query
def companies_by_size(spark, sf_dir):
    return reports.companies_by_size(gold_company_profile(spark, sf_dir))


@query
def top_industries(spark, sf_dir):
    return reports.top_industries(_analytics(spark, sf_dir))


@query
def postings_by_contract(spark, sf_dir):
    return reports.postings_by_contract(_analytics(spark, sf_dir))


@query
def top_skills(spark, sf_dir):
    return reports.top_skills(gold_job_skills(spark, sf_dir))


# --- panels ----------------------------------------------------------------------------------


@query
def industry_labels(spark, sf_dir):
    return panels.with_industry_name(gold_job_industries(spark, sf_dir))


@query
def panel_top_titles(spark, sf_dir):
    return panels.titles_panel(_analytics(spark, sf_dir), PANEL_INDUSTRY)


@query
def panel_top_titles_other(spark, sf_dir):
    return panels.titles_panel(_analytics(spark, sf_dir), v.UNKNOWN_INDUSTRY)


@query
def panel_top_salaries(spark, sf_dir):
    return panels.salaries_panel(_analytics(spark, sf_dir), PANEL_INDUSTRY)


@query
def panel_industry_names(spark, sf_dir):
    return panels.title_choices(_analytics(spark, sf_dir))


@query
def panel_salary_industry_names(spark, sf_dir):
    return panels.salary_choices(_analytics(spark, sf_dir))


@query
def dominant_company_size(spark, sf_dir):
    return panels.dominant_company_size(_analytics(spark, sf_dir))


@query
def dominant_industry(spark, sf_dir):
    return panels.dominant_industry(_analytics(spark, sf_dir))


@query
def industry_share(spark, sf_dir):
    return panels.industry_share(_analytics(spark, sf_dir))


@query
def waffle_blocks(spark, sf_dir):
    return panels.waffle_blocks(_analytics(spark, sf_dir))


@query
def waffle_legend(spark, sf_dir):
    return panels.waffle_legend(_analytics(spark, sf_dir))


@query
def contract_kpis(spark, sf_dir):
    return panels.contract_kpis(_analytics(spark, sf_dir))


# --- sources and sinks -----------------------------------------------------------------------


def write_csv(df: DataFrame, folder: str) -> None:
    (
        df.write.option("header", True)
        .option("nullValue", "\\N")
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(folder)
    )


def write_arrays(df: DataFrame, key: str, folder: str, per_file: int = 1 << 17) -> None:
    """Files of one JSON array each over several lines, ``per_file`` values of ``key`` to a file.

    An element is a row until it is written, so no array must fit one value.
    """
    file = Window.partitionBy("document").orderBy(*df.columns)
    rows = df.withColumn("document", F.floor(F.col(key) / per_file))
    rows = rows.withColumn("nth", F.row_number().over(file))
    element = F.regexp_replace(F.to_json(F.struct(*df.columns)), ",", ",\n  ")
    begin = F.when(F.col("nth") == 1, "[").otherwise("  ")
    end = F.when(F.lead(F.lit(1)).over(file).isNull(), "]").otherwise(",")
    line = F.concat(begin, element, end).alias("line")
    lines = rows.select("document", "nth", line).sortWithinPartitions("document", "nth")
    lines.drop("nth").write.partitionBy("document").text(folder)


@query
def csv_bronze_roundtrip(spark, sf_dir):
    folder = scratch_path(spark, "postings-csv")
    write_csv(r.job_postings(spark, sf_dir).select(*schemas.JOB_POSTINGS), folder)
    return readers.read_csv(spark, folder, "job_postings")


@query
def json_bronze_roundtrip(spark, sf_dir):
    folder = scratch_path(spark, "companies-json")
    packed = r.packed_documents(r.companies(spark, sf_dir), "company_id", 20)
    packed.select("document", "json").write.partitionBy("document").text(folder)
    return silver.companies(readers.read_json_documents(spark, folder))


@query
def json_lines_bronze(spark, sf_dir):
    folder = scratch_path(spark, "industries-jsonl")
    r.job_industries(spark, sf_dir).write.json(folder)
    return silver.job_industries(readers.read_json_lines(spark, folder))


@query
def json_records_bronze(spark, sf_dir):
    """One record per array element, whole files in a task each."""
    folder = scratch_path(spark, "companies-records")
    packed = r.packed_documents(r.companies(spark, sf_dir), "company_id", 20)
    packed.select("document", "json").write.partitionBy("document").text(folder)
    return silver.companies(readers.read_json_records(spark, folder, "companies"))


@contextmanager
def _small_parts(spark, folder, least=1 << 18, parts=16):
    """Files are read in parts meanwhile, as very large ones are in Spark's: the largest of ``folder``
    in ``parts``, of ``least`` bytes at least. So tasks grow with the files, not with their bytes."""
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {key: spark.conf.get(key) for key in keys}
    size = max(least, largest_file(spark, folder) // parts)
    for key in keys:
        spark.conf.set(key, str(size))
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


@query
def csv_multiline_split(spark, sf_dir):
    """Postings whose descriptions have line breaks and quotes, files cut over many tasks."""
    store, base = _store(spark, "postings-split")
    postings = r.job_postings(spark, sf_dir).withColumn("description", F.expr(r.LONG_DESCRIPTION))
    write_csv(postings.select(*schemas.JOB_POSTINGS), f"{base}/job_postings")
    with _small_parts(spark, f"{base}/job_postings"):
        ingest.load_table(store, base, "job_postings")
    return store.read("bronze", "job_postings")


@query
def json_array_split(spark, sf_dir):
    """Arrays of industries over several lines, cut at their elements over many tasks."""
    store, base = _store(spark, "industries-array")
    write_arrays(r.job_industries(spark, sf_dir), "job_id", f"{base}/job_industries")
    with _small_parts(spark, f"{base}/job_industries", 1 << 16):
        ingest.load_table(store, base, "job_industries", json_layout="array")
    return silver.job_industries(store.read("bronze", "job_industries"))


def _store(spark, name) -> tuple[TableStore, str]:
    """A folder store and an input folder below the scratch folder."""
    base = scratch_path(spark, name)
    return TableStore(spark, root=f"{base}/store"), f"{base}/in"


@query
def incremental_ingest(spark, sf_dir):
    """Two arrivals and idle reruns: every row once."""
    store, base = _store(spark, "skills-arrivals")
    skills = r.job_skills(spark, sf_dir)
    part = F.pmod(F.xxhash64("job_id", "skill_abr"), F.lit(2))
    for n in range(2):
        write_csv(skills.where(part == n), f"{base}/job_skills/{n}")
        for _ in range(2):
            ingest.load_table(store, base, "job_skills")
    return store.read("bronze", "job_skills")


@query
def bronze_batch_then_stream(spark, sf_dir):
    """Rows written directly, then files, then more files: every row once."""
    store, base = _store(spark, "skills-mixed")
    skills = r.job_skills(spark, sf_dir)
    part = F.pmod(F.xxhash64("job_id", "skill_abr"), F.lit(3))
    store.rebuild("bronze", "job_skills", skills.where(part == 2))
    for n in range(2):
        write_csv(skills.where(part == n), f"{base}/job_skills/{n}")
        ingest.load_table(store, base, "job_skills")
    return store.read("bronze", "job_skills")


@query
def bronze_full_reload(spark, sf_dir):
    """A full load replaces rows written directly by those of the files, and arrivals follow."""
    store, base = _store(spark, "skills-reload")
    skills = r.job_skills(spark, sf_dir)
    part = F.pmod(F.xxhash64("job_id", "skill_abr"), F.lit(2))
    store.rebuild("bronze", "job_skills", skills)
    for n in range(2):
        write_csv(skills.where(part == n), f"{base}/job_skills/{n}")
        ingest.load_table(store, base, "job_skills", full=n == 0)
    return store.read("bronze", "job_skills")


def _bronze(spark, sf_dir, table, **options):
    """An input written as files and loaded as the pipeline does."""
    store, base = _store(spark, table)
    rows = getattr(r, table)(spark, sf_dir)
    if table in schemas.CSV_TABLES:
        write_csv(rows.select(*schemas.CSV_TABLES[table]), f"{base}/{table}")
    else:
        rows.select(*schemas.JSON_TABLES[table]).write.json(f"{base}/{table}")
    ingest.load_table(store, base, table, full=True, **options)
    return store.read("bronze", table)


@query
def benefits_bronze(spark, sf_dir):
    return _bronze(spark, sf_dir, "benefits")


@query
def employee_counts_bronze(spark, sf_dir):
    return _bronze(spark, sf_dir, "employee_counts")


@query
def company_industries_bronze(spark, sf_dir):
    return silver.company_industries(_bronze(spark, sf_dir, "company_industries"))


@query
def company_specialities_bronze(spark, sf_dir):
    return silver.company_specialities(_bronze(spark, sf_dir, "company_specialities"))


@query
def store_rebuild(spark, sf_dir):
    """A replacement that fails leaves the table as it was; the next one takes its place."""
    store, _ = _store(spark, "rebuilt")
    skills = gold.job_skills(silver.job_skills(r.job_skills(spark, sf_dir)))
    store.rebuild("gold", "job_skills", skills)
    kept = store.read("gold", "job_skills")
    failing = kept.withColumn("skill_abr", F.raise_error(F.lit("this load fails")).cast("string"))
    try:
        store.rebuild("gold", "job_skills", failing)
    except Exception as error:
        if "this load fails" not in str(error):
            raise
    return store.rebuild("gold", "job_skills", store.read("gold", "job_skills"))


@query
def namespaced_row_counts(spark, sf_dir):
    """Databases for the layers, managed tables in them, and their content check."""
    store = TableStore(spark, namespace=f"check_{uuid.uuid4().hex[:12]}")
    store.create_namespaces()
    store.rebuild("silver", "job_skills", silver.job_skills(r.job_skills(spark, sf_dir)))
    industries = silver.job_industries(r.job_industries(spark, sf_dir))
    store.rebuild("silver", "job_industries", industries, bucket_by="job_id", buckets=4)
    return store.row_counts("silver", ("job_skills", "job_industries"))


@query
def current_layer_sql(spark, sf_dir):
    """SQL text over unqualified names, which follow the current layer."""
    store, _ = _store(spark, "layers")
    skills = silver.job_skills(r.job_skills(spark, sf_dir))
    store.rebuild("silver", "job_skills", skills)
    store.rebuild("gold", "job_skills", gold.job_skills(skills))
    store.use("silver")
    store.use("gold")
    return spark.sql(
        "SELECT skill_abr, count(*) AS pairs, count(DISTINCT job_id) AS jobs "
        "FROM job_skills GROUP BY skill_abr"
    )


# --- layers, versions and changed files --------------------------------------------------------


def _replace_files(spark, folder: str, by: str) -> None:
    """Files of one folder take the names of the files of another, whose content goes."""
    fs, at = files(spark, folder)

    def data_files(path):
        found = fs.listStatus(files(spark, path)[1])
        return sorted((f.getPath() for f in found if not f.getPath().getName().startswith(("_", "."))), key=str)

    names, new = data_files(folder), data_files(by)
    for name in names:
        fs.delete(name, False)
    path = spark._jvm.org.apache.hadoop.fs.Path
    for i, file in enumerate(new):
        fs.rename(file, names[i] if i < len(names) else path(at, file.getName()))


@query
def changed_files_load(spark, sf_dir):
    """Files replaced under their names are loaded again, a copy under another name is not."""
    store, base = _store(spark, "skills-changed")
    folder = f"{base}/job_skills"
    skills = r.job_skills(spark, sf_dir)
    part = F.col("job_id").cast("bigint") % 3
    for n in range(2):
        write_csv(skills.where(part == n), f"{folder}/{n}")
    ingest.load_table(store, base, "job_skills")
    write_csv(skills.where(part == 2), f"{base}/arrived")
    _replace_files(spark, f"{folder}/0", f"{base}/arrived")
    fs, at = files(spark, f"{folder}/1")
    first = min((f.getPath() for f in fs.listStatus(at) if f.getPath().getName().startswith("part")), key=str)
    copy = files(spark, f"{folder}/copy.csv")[1]
    spark._jvm.org.apache.hadoop.fs.FileUtil.copy(fs, first, fs, copy, False, spark._jsc.hadoopConfiguration())
    ingest.load_table(store, base, "job_skills", on_copy="skip")
    ingest.load_table(store, base, "job_skills", on_replaced="refuse", on_copy="skip")
    return store.read("bronze", "job_skills")


@query
def layer_of_one_generation(spark, sf_dir):
    """What a reader of the layer finds while it is rebuilt, after a failure and at the end."""
    store, _ = _store(spark, "generations")
    skills = silver.job_skills(r.job_skills(spark, sf_dir))
    industries = silver.job_industries(r.job_industries(spark, sf_dir))
    seen = []

    def look(moment):
        seen.extend((moment, table, df.count()) for table, df in store.read_layer("silver").items())

    with store.building("silver"):
        store.rebuild("silver", "job_skills", skills.where("job_id % 2 = 0"))
        store.rebuild("silver", "job_industries", industries.where("job_id % 2 = 0"))
    look("first")
    try:
        with store.building("silver"):
            store.rebuild("silver", "job_skills", skills.limit(0))
            bad = industries.withColumn("job_id", F.raise_error(F.lit("this build fails")).cast("bigint"))
            store.rebuild("silver", "job_industries", bad)
    except Exception as error:
        if "this build fails" not in str(error):
            raise
    look("failed")
    with store.building("silver"):
        store.rebuild("silver", "job_skills", skills)
        look("midway")
        store.rebuild("silver", "job_industries", industries)
    look("last")
    return spark.createDataFrame(seen, "moment string, `table` string, rows bigint")


@query
def names_follow_rebuilds(spark, sf_dir):
    """SQL text written once finds the table of the last of several rebuilds."""
    store, _ = _store(spark, "following")
    skills = gold.job_skills(silver.job_skills(r.job_skills(spark, sf_dir)))
    store.rebuild("gold", "job_skills", skills.where("job_id % 3 = 0"))
    store.use("gold")
    store.rebuild("gold", "job_skills", skills.where("job_id % 3 = 1"))
    store.rebuild("gold", "job_skills", skills)
    return store.sql("SELECT skill_abr, count(*) AS pairs FROM job_skills GROUP BY skill_abr")


@query
def layer_profile(spark, sf_dir):
    """Rows and missing values of every column, as stored beside the versions; sketches within 6 %."""
    store, _ = _store(spark, "profiled")
    tables = {
        "job_skills": silver.job_skills(r.job_skills(spark, sf_dir)),
        "job_industries": silver.job_industries(r.job_industries_gaps(spark, sf_dir)),
        "benefits": silver.benefits(r.benefits(spark, sf_dir), r.BENEFIT_ARRIVAL),
    }
    found = None
    for table, df in tables.items():
        stored = store.rebuild("silver", table, df)
        exact = stored.agg(*[F.count_distinct(c).alias(c) for c in stored.columns]).unpivot(
            [], stored.columns, "column", "exact"
        )
        profile = store.profile("silver", table).join(exact, "column").select(
            F.lit(table).alias("table"),
            "column",
            "rows",
            "nulls",
            (F.abs(F.col("distinct") - F.col("exact")) <= 0.06 * F.col("exact") + 1).alias("near"),
        )
        found = profile if found is None else found.unionByName(profile)
    return found


@query
def table_changes(spark, sf_dir):
    """A version of a table compared with the one before it."""
    store, _ = _store(spark, "compared")
    pairs = silver.job_industries(r.job_industries_gaps(spark, sf_dir))
    store.rebuild("silver", "job_industries", pairs.where("job_id % 2 = 0"))
    store.rebuild("silver", "job_industries", pairs)
    changes = store.changes("silver", "job_industries")
    return changes.select("column", "rows_before", "rows", "nulls_before", "nulls", "same")


@query
def panel_from_stored_layout(spark, sf_dir):
    """The panel over analytics stored in ranges of industries."""
    store, _ = _store(spark, "ranges")
    analytics = store.rebuild("gold", "job_analytics", gold.by_industry(_analytics(spark, sf_dir)))
    return panels.titles_panel(analytics, PANEL_INDUSTRY)
