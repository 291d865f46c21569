import json

import pytest
from pyspark.sql import types as T

from inputs import FILES, POSTING, csv_text, posting, write_files
from jobtide import schemas
from jobtide.plans import silver
from jobtide.sources import readers
from jobtide.sources.store import TableStore, fetch, scratch_path


def test_declared_columns():
    assert [len(c) for c in schemas.CSV_TABLES.values()] == [27, 3, 4, 2]
    assert schemas.JOB_POSTINGS == POSTING
    assert all(isinstance(f.dataType, T.StringType) for f in readers.bronze_schema("benefits"))
    assert isinstance(readers.bronze_schema("companies")["data"].dataType, T.VariantType)


def test_csv_quotes_newlines_and_three_kinds_of_nothing(spark, tmp_path):
    path = tmp_path / "b.csv"
    path.write_text('a,b,c\n1,"he said ""hi"", ok\nline2",\n2,"",x\n\\N, y ,"z"\n', encoding="utf-8")
    with pytest.raises(Exception, match="MALFORMED_CSV_RECORD"):  # never read wrongly
        readers.read_csv(spark, str(path), "benefits").collect()
    got = readers.read_csv(spark, str(path), "benefits", multiline=True).collect()
    assert [tuple(r) for r in got] == [
        ("1", 'he said "hi", ok\nline2', None), ("2", "", "x"), (None, " y ", "z"),
    ]


def test_csv_columns_bind_by_position(spark, tmp_path):
    path = tmp_path / "s.csv"
    path.write_text("skill_abr,job_id\n1,IT\n", encoding="utf-8")
    assert readers.read_csv(spark, str(path), "job_skills").first().asDict() == {
        "job_id": "1", "skill_abr": "IT",
    }


@pytest.mark.parametrize("line", ["1", "1,2,3"])
def test_csv_wrong_field_count_fails(spark, tmp_path, line):
    path = tmp_path / "s.csv"
    path.write_text(f"job_id,skill_abr\n{line}\n", encoding="utf-8")
    with pytest.raises(Exception, match="MALFORMED_CSV_RECORD"):
        readers.read_csv(spark, str(path), "job_skills").collect()


def test_record_separator_keeps_line_breaks_in_fields(spark, tmp_path):
    path = tmp_path / "p.csv"
    text = csv_text(POSTING, [posting(job_id="1", description="a\nb"), posting(job_id="2")])
    head, first, rest = text.split("\n", 1)[0], *text.split("\n", 1)[1].rsplit("\n2,", 1)
    path.write_bytes(f"{head}\r\n{first}\r\n2,{rest.rstrip()}\r\n".encode())
    df = readers.read_csv(spark, str(path), "job_postings", record_separator="\r\n")
    assert {(r.job_id, r.description) for r in df.collect()} == {("1", "a\nb"), ("2", None)}


def test_json_document_is_one_row_per_file(spark, tmp_path):
    for i in range(3):
        (tmp_path / f"{i}.json").write_text(FILES["job_industries.json"])
    df = readers.read_json_documents(spark, str(tmp_path))
    assert df.columns == ["data"] and df.count() == 3
    assert silver.job_industries(df).count() == 5


def layouts(spark, folder):
    records = json.loads(FILES["companies.json"])
    (folder / "document.json").write_text(FILES["companies.json"])
    (folder / "bare.json").write_text("\n".join(json.dumps(r) for r in records))
    (folder / "lines.json").write_text("[" + ",\n".join(json.dumps(r) for r in records) + "]\n")
    yield readers.read_json_documents(spark, str(folder / "document.json"))
    yield readers.read_json_records(spark, str(folder / "document.json"), "companies")
    yield readers.read_json_lines(spark, str(folder / "bare.json"))
    yield readers.read_json_lines(spark, str(folder / "lines.json"))


def test_all_json_layouts_give_the_same_companies(spark, tmp_path):
    results = [
        sorted((tuple(r) for r in silver.companies(df).collect()), key=repr)
        for df in layouts(spark, tmp_path)
    ]
    assert len(results[0]) == 3
    assert all(r == results[0] for r in results)


def test_malformed_json_line_fails(spark, tmp_path):
    (tmp_path / "x.json").write_text('{"company_id": 1}\nnonsense\n')
    with pytest.raises(Exception, match="Malformed records"):
        readers.read_json_lines(spark, str(tmp_path)).collect()


@pytest.mark.parametrize("managed", [True, False])
def test_store_rebuilds_and_reads(spark, tmp_path, managed):
    store = TableStore(spark, "storetest") if managed else TableStore(spark, root=str(tmp_path))
    store.create_namespaces()
    store.create_namespaces()
    first = spark.createDataFrame([(1, "a"), (2, "b")], "job_id bigint, skill_abr string")
    assert store.rebuild("gold", "job_skills", first).count() == 2
    again = store.rebuild("gold", "job_skills", first.where("job_id = 1"))
    assert again.count() == 1
    assert store.preview("gold", "job_skills", 5).count() == 1
    with pytest.raises(ValueError):
        store.name("platinum", "x")


def test_variant_table_survives_a_rebuild(spark, tmp_path):
    base = write_files(tmp_path)
    store = TableStore(spark, root=str(tmp_path / "store"))
    df = readers.read_json_documents(spark, f"{base}/companies.json")
    assert silver.companies(store.rebuild("bronze", "companies", df)).count() == 3


def test_tables_bucketed_alike_join_without_a_shuffle(spark):
    store = TableStore(spark, "bucketed")
    store.create_namespaces()
    jobs = spark.range(200).withColumnRenamed("id", "job_id")
    left = store.rebuild("gold", "job_postings", jobs, bucket_by="job_id", buckets=4)
    right = store.rebuild("gold", "job_industries", jobs, bucket_by="job_id", buckets=4)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = left.join(right, "job_id", "left")
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
        assert joined.count() == 200
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("managed", [True, False])
def test_failing_rebuild_leaves_the_old_table(spark, tmp_path, managed):
    store = TableStore(spark, "atomic") if managed else TableStore(spark, root=str(tmp_path))
    store.create_namespaces()
    store.rebuild("silver", "job_skills", spark.range(3))
    with pytest.raises(Exception, match="no such number"):
        store.rebuild("silver", "job_skills", spark.range(5).selectExpr("if(id = 4, raise_error('no such number'), id) AS id"))
    assert store.read("silver", "job_skills").count() == 3
    assert store.rebuild("silver", "job_skills", store.read("silver", "job_skills").where("id < 2")).count() == 2


def test_interrupted_publication_is_finished(spark):
    store = TableStore(spark, "interrupted")
    store.create_namespaces()
    store.rebuild("gold", "job_skills", spark.range(3))
    name = store.name("gold", "job_skills")
    spark.sql(f"DROP VIEW {name}")  # a crash may have stopped before names followed
    assert store.read("gold", "job_skills").count() == 3
    store.use("gold")
    assert spark.sql("SELECT * FROM job_skills").count() == spark.table(name).count() == 3
    spark.catalog.setCurrentDatabase("default")


def test_buckets_are_never_ignored(spark, tmp_path):
    with pytest.raises(ValueError, match="bucketed"):
        TableStore(spark, root=str(tmp_path)).rebuild("gold", "job_skills", spark.range(3), "id", 4)
    with pytest.raises(ValueError, match="bucket_by"):
        TableStore(spark).rebuild("gold", "job_skills", spark.range(3), buckets=4)


def test_views_follow_the_current_layer(spark, tmp_path):
    store = TableStore(spark, root=str(tmp_path))
    store.rebuild("silver", "benefits", spark.range(1))
    store.rebuild("gold", "job_skills", spark.range(2))
    store.use("silver")
    assert spark.table("benefits").count() == 1
    store.use("gold")
    assert spark.table("job_skills").count() == 2
    with pytest.raises(Exception, match="TABLE_OR_VIEW_NOT_FOUND"):
        spark.table("benefits")


def test_one_file_is_read_by_several_tasks(spark, tmp_path):
    (tmp_path / "s.csv").write_text("job_id,skill_abr\n" + "1,abcdefgh\n" * 40_000)
    (tmp_path / "s.json").write_text('{"job_id": 1, "industry_id": 2}\n' * 20_000)
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    for key in before:
        spark.conf.set(key, "65536")
    try:
        for df, rows in (
            (readers.read_csv(spark, str(tmp_path / "s.csv"), "job_skills"), 40_000),
            (readers.read_json_lines(spark, str(tmp_path / "s.json")), 20_000),
        ):
            assert df.rdd.getNumPartitions() > 4 and df.count() == rows
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_scratch_needs_a_shared_folder_on_a_cluster(spark, monkeypatch):
    if spark.conf.get("spark.checkpoint.dir", None) is None:
        monkeypatch.setattr(type(spark.sparkContext), "master", "spark://host:7077", raising=False)
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            scratch_path(spark, "x")


def test_fetch_refuses_large_results(spark):
    assert len(fetch(spark.range(5), 5)) == 5
    with pytest.raises(ValueError):
        fetch(spark.range(6), 5)


def test_scratch_is_below_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir", None)
    first, second = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert first != second
    if shared:
        assert first.startswith(shared)
