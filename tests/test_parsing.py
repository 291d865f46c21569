from datetime import datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from jobtide.functions import parsing as p


def test_clean_text_strips_spaces_only(values):
    assert values(p.clean_text, [" a ", "  ", "", None, "\ta"]) == ["a", None, None, None, "\ta"]


def test_labels_fold_case_with_accents(values):
    assert values(p.lower_label, [" ÉTÉ ", " "]) == ["été", None]
    assert values(p.upper_label, [" été ", ""]) == ["ÉTÉ", None]


def test_numbers_have_scale_zero(values):
    texts = ["12.5", "-0.5", "2774458.0", " 12 ", "1.5e3", "abc", "", "1,000", None, "12.4"]
    expected = [13, -1, 2774458, 12, 1500, None, None, None, None, 12]
    assert values(p.clean_number, texts) == expected
    assert values(p.safe_number, texts) == expected


def test_first_characters_of_numbers(values):
    texts = ["+5", "-5", ".5", "5.", " 5", "\t5", "0", "9", "a5", ":5", "é", "-", "1.2.3", "/5"]
    expected = [5, -5, 1, 5, 5, 5, 0, 9, None, None, None, None, None, None]
    assert values(p.safe_number, texts) == expected


def test_number_columns_are_accepted(spark):
    df = spark.sql("SELECT 12L AS a, 1699084930L AS b, CAST(2.5 AS DECIMAL(3,1)) AS c")
    row = df.select(p.safe_number("a"), p.epoch_to_ts("b"), p.safe_number("c")).first()
    assert tuple(row) == (12, datetime(2023, 11, 4, 8, 2, 10), 3)


def test_numbers_keep_38_digits(values):
    big = "9" * 38
    assert values(p.safe_number, [big, big + "9"]) == [int(big), None]


def test_strict_id(values):
    assert values(p.strict_id, ["12.7", "01", None]) == [13, 1, None]
    assert values(lambda c: p.strict_id(c, "null"), ["abc", "", "9" * 30]) == [None] * 3
    for bad in ("abc", "", "9" * 30):
        with pytest.raises(PySparkException, match="not an id"):
            values(p.strict_id, ["1", bad])
    with pytest.raises(ValueError):
        p.strict_id("x", "ignore")


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_strict_id_does_not_depend_on_ansi(spark, values, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        assert values(p.strict_id, ["7"]) == [7]
        with pytest.raises(PySparkException, match="not an id"):
            values(p.strict_id, ["x"])
        with pytest.raises(PySparkException, match="not an epoch"):
            values(p.epoch_to_ts, ["9" * 20])
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_robust_boolean(values):
    true = "true T yes Y on 1 1.0 vrai Oui 0.6 TRUE".split()
    false = "false f no off 0 FAUX non N -0.4 0.0".split()
    unknown = ["maybe", "", "2", None, " oui ", "-1"]
    assert values(p.robust_boolean, true) == [True] * len(true)
    assert values(p.robust_boolean, false) == [False] * len(false)
    assert values(p.robust_boolean, unknown) == [None] * len(unknown)


def test_safe_boolean_knows_no_french_and_no_other_numbers(values):
    assert values(p.safe_boolean, ["on", "OFF", "vrai", "1.0", None]) == [True, False, None, None, None]


def test_list_boolean_trims_and_has_no_number_rule(values):
    texts = [" Vrai ", "1", "0", "NON", "1.0", "on", "t", None]
    assert values(p.list_boolean, texts) == [True, True, False, False, None, None, None, None]


def test_epoch_units(values):
    texts = ["1699084930123", "1699084930", "100000000000", "100000000001", None, "abc", "0", "-1"]
    assert values(p.epoch_to_ts, texts) == [
        datetime(2023, 11, 4, 8, 2, 10, 123000),
        datetime(2023, 11, 4, 8, 2, 10),
        datetime(5138, 11, 16, 9, 46, 40),
        datetime(1973, 3, 3, 9, 46, 40, 1000),
        None,
        None,
        datetime(1970, 1, 1),
        datetime(1969, 12, 31, 23, 59, 59),
    ]


def test_epoch_does_not_depend_on_the_session_zone(spark, values):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert values(p.epoch_to_ts, ["1699084930"]) == [datetime(2023, 11, 4, 8, 2, 10)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_epoch_out_of_range(values):
    absurd = ["9" * 20, "-" + "9" * 20, "-" + "9" * 15, "9" * 16]
    assert values(lambda c: p.epoch_to_ts(c, "null"), absurd) == [None] * 4
    for text in absurd[1:3]:
        with pytest.raises(Exception, match="not an epoch|DATETIME_OVERFLOW"):
            values(p.epoch_to_ts, [text])
    with pytest.raises(PySparkException, match="not an epoch"):
        values(p.epoch_to_ts, ["9" * 20])


def test_recency_reads_written_dates_too(values):
    texts = ["1699084930", "2023-11-04 08:02:10", "soon", None, "9" * 30]
    day = datetime(2023, 11, 4, 8, 2, 10)
    assert values(p.recency, texts) == [day, day, None, None, None]


def test_expressions_accept_columns(spark):
    df = spark.sql("SELECT ' 1 ' AS a")
    assert df.select(p.clean_number(F.concat("a", F.lit("")))).first()[0] == 1
