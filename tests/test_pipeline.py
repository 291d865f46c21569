import pytest
from pyspark.sql import functions as F

from inputs import POSTING, write_files, write_folders
from jobtide.plans import gold, panels, pipeline, reports, silver
from jobtide.sources.store import TABLES, TableStore, fetch
from jobtide.streaming import ingest


@pytest.fixture(scope="module", params=["managed", "folders"])
def run(request, spark, tmp_path_factory):
    base = write_files(tmp_path_factory.mktemp("in"))
    if request.param == "managed":
        store, buckets = TableStore(spark, "pipe"), 4
    else:
        store, buckets = TableStore(spark, root=str(tmp_path_factory.mktemp("out"))), None
    return store, pipeline.run(store, base, buckets=buckets)


def test_layer_sizes(run):
    store, _ = run
    sizes = {
        layer: {r.table: r.rows for r in store.row_counts(layer).collect()} for layer in TABLES
    }
    assert sizes["bronze"]["job_postings"] == 5 and sizes["bronze"]["companies"] == 1
    assert sizes["silver"] == {
        "job_postings": 4, "benefits": 2, "employee_counts": 2, "job_skills": 5,
        "companies": 3, "job_industries": 5, "company_industries": 1, "company_specialities": 2,
    }
    assert sizes["gold"] == {
        "job_postings": 4, "job_industries": 4, "job_skills": 3, "company_profile": 2,
        "job_analytics": 5,
    }


def test_analytics_content(run):
    _, tables = run
    got = {
        (r.job_id, r.title, r.company_name, r.industry_id, r.company_size, r.max_salary)
        for r in tables["job_analytics"].collect()
    }
    assert got == {
        (1, "Engineer", "Acme", 43, 3, 101), (1, "Engineer", "Acme", 149, 3, 101),
        (2, "Nurse", "Beta", 14, None, 50), (3, "Engineer", None, None, None, None),
        (4, None, None, 999, None, None),
    }
    assert tables["job_analytics"].columns == list(gold.ANALYTICS)


def test_latest_count_wins(run):
    _, tables = run
    profile = {r.company_id: r.employee_count for r in tables["company_profile"].collect()}
    assert profile == {10: 6, 20: None}


def test_reports_and_panels(run):
    _, tables = run
    analytics = tables["job_analytics"]
    assert reports.industry_coverage(analytics).first().asDict() == {
        "total": 5, "non_null_industry_id": 4,
    }
    top = panels.titles_panel(analytics, "Banking").collect()
    assert [(r.industry_id, r.title, r.nb_jobs) for r in top] == [(43, "Engineer", 1), (149, "Engineer", 1)]
    names = [r[0] for r in panels.title_choices(analytics).collect()]
    assert names == ["Banking", "Biotechnology"]
    paid = panels.salaries_panel(analytics, "Biotechnology").first()
    assert (paid.title, paid.avg_salary) == ("Nurse", 50.0)
    assert panels.dominant_company_size(analytics).first().company_size == 3
    assert panels.industry_share(analytics).agg(F.sum("blocks")).first()[0] == 100
    assert [r.id for r in panels.waffle_blocks(analytics).orderBy("id").collect()] == list(range(100))
    assert [r.skill_abr for r in reports.top_skills(tables["job_skills"]).collect()] == ["IT", "HCPR"]
    assert [r.colour for r in panels.contract_kpis(analytics).where("label = 'FULL_TIME'").collect()] == ["#64748b"]


def test_sql_text_over_the_current_layer(run):
    store, _ = run
    store.use("gold")
    rows = fetch(
        store.spark.sql(
            "SELECT industry_id, count(*) AS n FROM job_analytics "
            "WHERE industry_id IS NOT NULL GROUP BY industry_id ORDER BY n DESC, industry_id"
        )
    )
    assert list(rows["industry_id"]) == [14, 43, 149, 999]
    store.spark.catalog.setCurrentDatabase("default")


def test_rerun_gives_the_same_tables(run, tmp_path):
    store, tables = run
    before = sorted(map(repr, tables["job_analytics"].collect()))
    again = pipeline.run(store, write_files(tmp_path))
    assert sorted(map(repr, again["job_analytics"].collect())) == before


def test_repeated_company_multiplies_rows(spark):
    postings = spark.createDataFrame([("1", "7")], "job_id string, company_name string")
    columns = {c: F.lit(None).cast("string") for c in ("title", "formatted_work_type", "work_type")}
    flat = postings.select(
        F.col("job_id").cast("bigint").alias("job_id"), "company_name",
        *[v.alias(k) for k, v in columns.items()],
        *[F.lit(None).cast("string").alias(c) for c in (
            "remote_allowed", "formatted_experience_level", "min_salary", "med_salary",
            "max_salary", "currency", "listed_time")],
    )
    pairs = spark.createDataFrame([(1, 5), (1, 6)], "job_id bigint, industry_id int")
    profiles = spark.createDataFrame(
        [(7, "a", 1, "x"), (7, "b", 2, "y")], "company_id bigint, name string, company_size int, country string"
    )
    assert gold.job_analytics(flat, pairs, profiles).count() == 4


def test_raw_ids_count_as_different_jobs_unless_asked(spark):
    bronze = spark.createDataFrame([("1", "1"), ("01", "2")], "job_id string, listed_time string")
    assert silver.latest_postings(bronze).count() == 2
    assert silver.latest_postings(bronze, key=[F.col("job_id").cast("int")]).count() == 1


def test_incremental_load_skips_loaded_files(spark, tmp_path):
    base = write_folders(tmp_path / "in")
    store = TableStore(spark, root=str(tmp_path / "out"))
    for _ in range(2):
        ingest.load_new_files(store, base)
    assert store.read("bronze", "job_postings").count() == 5
    assert store.read("bronze", "companies").count() == 1
    more = tmp_path / "in" / "job_skills" / "more.csv"
    more.write_text("job_id,skill_abr\n9,NEW\n")
    (tmp_path / "in" / "companies" / "more.json").write_text('[{"company_id": 77, "name": "New"}]')
    ingest.load_new_files(store, base, max_files_per_trigger=1)
    assert store.read("bronze", "job_skills").count() == 7
    assert silver.companies(store.read("bronze", "companies")).where("company_id = 77").count() == 1
    pipeline.build_silver(store)
    assert pipeline.build_gold(store)["job_analytics"].count() == 5


def test_incremental_load_into_managed_tables(spark, tmp_path):
    base = write_folders(tmp_path / "in")
    store = TableStore(spark, "incremental")
    store.create_namespaces()
    for _ in range(2):
        ingest.load_new_files(store, base)
    assert store.read("bronze", "job_postings").count() == 5


@pytest.mark.parametrize("managed", [True, False])
def test_batch_and_later_files_share_a_table(spark, tmp_path, managed):
    """Rows written directly, a full load, arrivals, idle reruns, another full load: every row once."""
    base, skills = tmp_path / "in", tmp_path / "in" / "job_skills"
    write_folders(base)
    name = "mixed" if managed else None
    store = TableStore(spark, name) if managed else TableStore(spark, root=str(tmp_path / "out"))
    store.create_namespaces()

    def rows():
        return sorted((r.job_id, r.skill_abr) for r in store.read("bronze", "job_skills").collect())

    def load(full=False):
        ingest.load_table(store, str(base), "job_skills", full=full)
        return rows()

    store.rebuild("bronze", "job_skills", spark.createDataFrame([("7", "X"), ("8", "Y")], "job_id string, skill_abr string"))
    files = [("1", " IT "), ("1", "it"), ("2", "HCPR"), ("3", " "), ("3", "IT"), ("bad", "IT")]
    assert load() == sorted([*files, ("7", "X"), ("8", "Y")])
    assert load(full=True) == sorted(files)
    (skills / "more.csv").write_text("job_id,skill_abr\n9,NEW\n")
    assert load() == load() == sorted([*files, ("9", "NEW")])
    assert load(full=True) == sorted([*files, ("9", "NEW")])
    (skills / "last.csv").write_text("job_id,skill_abr\n10,\n")
    assert len(load()) == 8 and ("10", None) in [(r.job_id, r.skill_abr) for r in store.read("bronze", "job_skills").collect()]


def test_failing_full_load_leaves_the_old_table(spark, tmp_path):
    write_folders(tmp_path / "in")
    store = TableStore(spark, root=str(tmp_path / "out"))
    ingest.load_table(store, str(tmp_path / "in"), "job_skills")
    (tmp_path / "in" / "job_skills" / "bad.csv").write_text("job_id,skill_abr\n1\n")
    with pytest.raises(Exception, match="MALFORMED"):
        ingest.load_table(store, str(tmp_path / "in"), "job_skills", full=True)
    assert store.read("bronze", "job_skills").count() == 6


def test_json_layouts_load_alike(spark, tmp_path):
    write_folders(tmp_path / "in")
    for layout in ("lines", "records", "document"):
        store = TableStore(spark, root=str(tmp_path / layout))
        ingest.load_table(store, str(tmp_path / "in"), "companies", json_layout=layout)
        assert silver.companies(store.read("bronze", "companies")).count() == 3


def test_dirty_files_fail_or_finish_with_nulls(spark, tmp_path):
    base = tmp_path / "in"
    write_folders(base)
    head = ",".join(POSTING)
    row = ["x" if c == "job_id" else "9" * 30 if c == "expiry" else "" for c in POSTING]
    (base / "job_postings" / "dirty.csv").write_text(f"{head}\n{','.join(row)}\n")
    (base / "companies" / "dirty.json").write_text('[{"company_id": "abc", "name": "Bad"}]')
    store = TableStore(spark, root=str(tmp_path / "out"))
    with pytest.raises(Exception):
        pipeline.run(store, str(base))
    gold_tables = pipeline.run(
        store,
        str(base),
        silver_options={
            "job_postings": {"on_bad_id": "null", "on_bad_epoch": "null"},
            "companies": {"on_bad": "null"},
        },
    )
    assert gold_tables["job_analytics"].count() == 5
    bad = store.read("silver", "job_postings").where("job_id IS NULL").first()
    assert bad is not None and bad.expiry is None
    with pytest.raises(ValueError, match="no silver tables"):
        pipeline.build_silver(store, {"postings": {}})


def test_listed_industries_keep_their_order(spark):
    columns = "industry_id int, title string, formatted_work_type string"
    rows = [(code, "t", "x") for code in range(60, 75) for _ in range(code % 7 + 1)]
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for panel in (panels.busiest_industries, panels.industry_share):
            found = [(-r.nb_jobs, r.industry_id) for r in panel(spark.createDataFrame(rows, columns)).collect()]
            assert len(found) == 10 and found == sorted(found)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
