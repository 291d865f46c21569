from pyspark.sql import functions as F

from jobtide.functions import display, vocabulary as v
from jobtide.plans.panels import with_industry_name


def test_pay_period(values):
    texts = ["Per Year", " par mois ", "HORAIRE", "hebdomadaire", "journalier", "", None, "YEARLY ", "par an"]
    assert values(lambda c: v.normalize(c, v.PAY_PERIOD), texts) == [
        "yearly", "monthly", "hourly", "weekly", "daily", None, None, "YEARLY", "yearly",
    ]


def test_work_types_differ_in_apprenticeship(values):
    texts = ["Intérim", "INTÉRIM", "apprentissage", "FULL_TIME", " Volunteer "]
    six = values(lambda c: v.normalize(c, v.FORMATTED_WORK_TYPE), texts)
    five = values(lambda c: v.normalize(c, v.WORK_TYPE), texts)
    assert six == ["Temporary", "Temporary", "Apprenticeship", "FULL_TIME", "Volunteer"]
    assert five == ["Temporary", "Temporary", "apprentissage", "FULL_TIME", "Volunteer"]


def test_experience_level(values):
    texts = ["stage", "Junior", "DÉBUTANT", "confirmé", "EXPÉRIMENTÉ", "cadre dirigeant", "Mid-Senior level"]
    assert values(lambda c: v.normalize(c, v.EXPERIENCE_LEVEL), texts) == [
        "Internship", "Entry level", "Entry level", "Associate", "Mid-Senior level", "Executive",
        "Mid-Senior level",
    ]


def test_dimension_size_and_shared_labels(spark):
    dimension = v.industry_dimension(spark)
    assert dimension.count() == 149
    assert dimension.select("industry_name").distinct().count() == 146
    assert dimension.where("industry_id = 2").count() == 0


def test_labels_and_code_predicate_agree(spark):
    codes = spark.range(0, 156).select(F.col("id").cast("int").alias("industry_id"))
    labelled = with_industry_name(codes)
    for name, size in (("Banking", 2), ("Other", 7), ("Insurance", 1), ("No such label", 0)):
        by_label = {r[0] for r in labelled.where(F.col("industry_name") == name).select("industry_id").collect()}
        by_code = {r[0] for r in codes.where(v.has_industry_name("industry_id", name)).collect()}
        assert by_label == by_code and len(by_code) == size


def test_code_predicate_reaches_the_scan(spark, sf_dir, tmp_path):
    path = str(tmp_path / "codes")
    spark.range(0, 156).select(F.col("id").cast("int").alias("industry_id")).write.parquet(path)
    df = spark.read.parquet(path).where(v.has_industry_name("industry_id", "Banking"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(industry_id, [149,43])]" in plan or "In(industry_id, [43,149])" in plan


def test_contract_colours(values):
    texts = ["Full-time", "Contract", "Part-time", "Internship", "Temporary", "Volunteer", "full-time", "Apprenticeship"]
    assert values(lambda c: display.contract_colour(F.col(c)), texts) == [
        "#2563eb", "#f59e0b", "#10b981", "#8b5cf6", "#ef4444", "#ec4899", "#64748b", "#64748b",
    ]


def test_whole_percent_cuts(spark):
    df = spark.sql("SELECT * FROM VALUES (0.29D), (0.999D), (0.0D) AS t(share)")
    assert [r[0] for r in df.select(display.whole_percent(F.col("share"))).collect()] == [28, 99, 0]


def test_grouped_digits_and_sentences(spark):
    df = spark.sql("SELECT 1234567L AS n, 3 AS size, 'Retail' AS name")
    row = df.select(
        display.grouped_digits(F.col("n")),
        display.size_sentence(F.col("size")),
        display.industry_sentence(F.col("name"), F.col("n")),
    ).first()
    assert row[0] == "1,234,567"
    assert row[1].endswith("company size: 3")
    assert "**Retail**" in row[2] and "**1,234,567 offres**" in row[2]
