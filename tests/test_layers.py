"""Layers published as one, names that follow, profiles of versions, files that change."""

import os
import shutil

import pytest
from pyspark.sql import functions as F

from jobtide.plans import gold, panels
from jobtide.sources import profiles
from jobtide.sources.store import TableStore
from jobtide.streaming import ingest


@pytest.fixture(params=["managed", "folders"])
def store(request, spark, tmp_path):
    if request.param == "folders":
        yield TableStore(spark, root=str(tmp_path / "store"))
        return
    store = TableStore(spark, f"layers_{abs(hash(str(tmp_path))) % 10**8}")
    store.create_namespaces()
    yield store
    spark.catalog.setCurrentDatabase("default")


def counts(store, layer="gold"):
    return {t: df.count() for t, df in store.read_layer(layer).items()}


def test_layer_changes_as_one(spark, store):
    with store.building("gold"):
        store.rebuild("gold", "job_skills", spark.range(1))
        assert not store.exists("gold", "job_skills")
        store.rebuild("gold", "job_postings", spark.range(1))
    assert counts(store) == {"job_skills": 1, "job_postings": 1}
    reader = store.read_layer("gold")
    with store.building("gold"):
        assert store.rebuild("gold", "job_skills", spark.range(2)).count() == 2
        assert counts(store) == {"job_skills": 1, "job_postings": 1}  # between two tables
        store.rebuild("gold", "job_postings", spark.range(2))
    assert counts(store) == {"job_skills": 2, "job_postings": 2}
    assert reader["job_skills"].count() == 1  # the version before stays for its readers


def test_build_that_fails_midway_changes_nothing(spark, store):
    store.rebuild("gold", "job_skills", spark.range(1))
    before = store.manifest("gold")
    with pytest.raises(Exception, match="midway"):
        with store.building("gold"):
            store.rebuild("gold", "job_skills", spark.range(5))
            store.rebuild("gold", "job_postings", spark.range(3).selectExpr("raise_error('midway') AS x"))
    assert store.manifest("gold") == before and counts(store) == {"job_skills": 1}
    assert store.clean("gold") == []  # nothing half-written is left
    store.rebuild("gold", "job_skills", spark.range(4))
    assert counts(store) == {"job_skills": 4}


def test_killed_build_is_cleaned(spark, store):
    store.rebuild("gold", "job_skills", spark.range(1))
    place = store.place("gold", "job_skills", store.begin("gold", "job_skills"))
    writer = spark.range(9).write
    writer.saveAsTable(place) if store.root is None else writer.parquet(place)
    assert store.clean("gold") == [place] and counts(store) == {"job_skills": 1}


def test_names_follow_rebuilds(spark, store):
    store.rebuild("gold", "job_skills", spark.range(1))
    store.use("gold")
    for n in (2, 3, 4):
        store.rebuild("gold", "job_skills", spark.range(n))
        assert spark.sql("SELECT * FROM job_skills").count() == n
    other = TableStore(spark.newSession(), store.namespace, store.root)
    for n in (5, 6, 7):  # somebody else publishes
        other.rebuild("gold", "job_skills", spark.range(n) if store.root is None else other.spark.range(n))
        assert store.sql("SELECT * FROM job_skills").count() == n


def test_table_made_by_somebody_else_is_adopted(spark, store):
    if store.root is not None:
        return
    spark.range(3).write.saveAsTable(store.name("gold", "job_skills"))
    assert store.read("gold", "job_skills").count() == 3
    store.rebuild("gold", "job_skills", spark.range(4))
    assert store.read("gold", "job_skills").count() == spark.table(store.name("gold", "job_skills")).count() == 4


def test_two_publishers_do_not_overwrite_each_other(spark, tmp_path, monkeypatch):
    store = TableStore(spark, root=str(tmp_path))
    store.rebuild("gold", "job_skills", spark.range(1))
    stale = store._manifests("gold")
    store.rebuild("gold", "job_postings", spark.range(1))
    monkeypatch.setattr(store, "_manifests", lambda layer: stale)
    with pytest.raises(RuntimeError, match="somebody else"):
        store._write_manifest("gold", {"tables": {}, "before": {}})


def test_profile_is_exact_and_mergeable(spark):
    rows = [(i, f"v{i % 700}" if i % 5 else None, [i % 3], i / 7) for i in range(5_000)]
    df = spark.createDataFrame(rows, "a long, b string, c array<int>, d double")
    found = {r.column: r for r in profiles.profile(df).collect()}
    assert {c: (r.rows, r.nulls) for c, r in found.items()} == {
        "a": (5000, 0), "b": (5000, 1000), "c": (5000, 0), "d": (5000, 0), "*": (5000, 0)}
    for column, exact in {"a": 5000, "b": len({r[1] for r in rows} - {None}), "c": 3, "d": 5000, "*": 5000}.items():
        assert abs(found[column].distinct - exact) <= 0.06 * exact + 1
    parts = [profiles.profile(df.where(f"a % 3 = {k}")) for k in range(3)]
    whole = {r.column: r for r in profiles.merged(*parts).collect()}
    for column, r in found.items():
        m = whole[column]
        assert (m.rows, m.nulls, m.distinct, m.digest) == (r.rows, r.nulls, r.distinct, r.digest)
    assert profiles.profile(df.limit(0)).where("column = '*'").first().rows == 0
    data = spark.sql("SELECT parse_json('[1]') AS data")
    assert profiles.profile(data).where("column = 'data'").first().nulls == 0


def test_changes_between_versions(spark, store):
    df = spark.createDataFrame([(1, "a"), (2, None), (2, "b")], "job_id long, skill_abr string")
    store.rebuild("silver", "job_skills", df)
    store.rebuild("silver", "job_skills", df.orderBy(F.desc("job_id")).repartition(3))
    assert all(r.same for r in store.changes("silver", "job_skills").collect())
    store.rebuild("silver", "job_skills", df.withColumn("skill_abr", F.lit("a")).unionByName(df))
    changes = {r.column: r for r in store.changes("silver", "job_skills").collect()}
    assert (changes["*"].rows_before, changes["*"].rows, changes["*"].same) == (3, 6, False)
    assert (changes["skill_abr"].nulls_before, changes["skill_abr"].nulls) == (1, 1)
    bronze = store.rebuild("bronze", "job_skills", df)
    assert bronze.count() == store.profile("bronze", "job_skills").first().rows == 3


def test_panel_reads_its_row_groups_only(spark, tmp_path):
    n = 60_000
    hot = F.when(F.col("id") % 3 == 0, 43).otherwise(F.col("id") % 150).cast("int")
    names = [c for c in gold.ANALYTICS if c not in ("job_id", "title", "industry_id")]
    df = spark.range(n).select(
        F.col("id").alias("job_id"), F.concat(F.lit("t"), F.col("id") % 50).alias("title"),
        hot.alias("industry_id"), *[F.lit(None).cast("string").alias(c) for c in names])
    path = str(tmp_path / "analytics")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        gold.by_industry(df).write.option("parquet.block.size", 4096).parquet(path)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    sizes = spark.read.parquet(path).where("industry_id = 43").groupBy(F.input_file_name()).count().count()
    assert sizes >= 2  # the hot code is cut over files
    panel = panels.titles_panel(spark.read.parquet(path), "Biotechnology")  # code 14
    panel.collect()
    assert 0 < rows_scanned(panel) < n / 3


def rows_scanned(df):
    total = 0

    def walk(node):
        nonlocal total
        if node.nodeName().startswith("Scan parquet"):
            total += node.metrics().get("numOutputRows").get().value()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            walk(node.executedPlan())
        elif name.endswith("QueryStageExec"):
            walk(node.plan())
        elif name == "ReusedExchangeExec":
            return
        else:
            children = node.children()
            for i in range(children.size()):
                walk(children.apply(i))

    walk(df._jdf.queryExecution().executedPlan())
    return total


HEAD = "job_id,skill_abr\n"


def write(path, text, later=0):
    path.write_text(HEAD + text)
    at = path.stat().st_mtime + later
    os.utime(path, (at, at))


@pytest.fixture
def arrivals(store, tmp_path):
    folder = tmp_path / "in" / "job_skills"
    folder.mkdir(parents=True)
    write(folder / "a.csv", "1,A\n2,A\n")
    write(folder / "b.csv", "3,B\n")

    def load(**options):
        ingest.load_table(store, str(tmp_path / "in"), "job_skills", **options)
        return sorted(r.job_id for r in store.read("bronze", "job_skills").collect())

    return store, folder, load


def test_replaced_file_is_loaded_again(arrivals, spark):
    store, folder, load = arrivals
    extra = spark.createDataFrame([("77", "X")], "job_id string, skill_abr string")
    store.rebuild("bronze", "job_skills", extra)
    assert load() == load() == ["1", "2", "3", "77"]
    write(folder / "a.csv", "5,A\n6,A\n", later=10)  # the same length
    with pytest.raises(ValueError, match="replaced"):
        load(on_replaced="refuse")
    assert sorted(r.job_id for r in store.read("bronze", "job_skills").collect()) == ["1", "2", "3", "77"]
    assert load(on_replaced="keep") == ["1", "2", "3", "77"]
    assert load() == load() == ["3", "5", "6", "77"]
    write(folder / "c.csv", "9,C\n")
    assert load() == ["3", "5", "6", "77", "9"]


def test_touched_file_is_not_loaded_again(arrivals):
    store, folder, load = arrivals
    load()
    version = store.generation("bronze", "job_skills")
    write(folder / "a.csv", "1,A\n2,A\n", later=30)
    assert load(on_replaced="refuse") == ["1", "2", "3"] and store.generation("bronze", "job_skills") == version


def test_renamed_copy_is_told_apart(arrivals):
    store, folder, load = arrivals
    load()
    shutil.copy(folder / "a.csv", folder / "z.csv")
    write(folder / "n.csv", "8,N\n")
    assert load(on_copy="skip") == ["1", "2", "3", "8"]
    known = {os.path.basename(r.path): r.copy_of and os.path.basename(r.copy_of)
             for r in ingest.ledger(store, "job_skills").table().collect()}
    assert known == {"a.csv": None, "b.csv": None, "n.csv": None, "z.csv": "a.csv"}
    shutil.copy(folder / "b.csv", folder / "y.csv")
    assert load() == ["1", "2", "3", "3", "8"]
    with pytest.raises(ValueError, match="on_copy"):
        load(on_copy="perhaps")
