"""Scalar functions on the texts and numbers where engines differ."""

import re
from datetime import date, datetime
from decimal import Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from batchkit.errors import DataError
from batchkit.functions import dates, numbers, text


def evaluate(spark, function, values, kind="string"):
    rows = list(enumerate(values))
    df = spark.createDataFrame(rows, f"i int, x {kind}").select("i", function(F.col("x")).alias("y"))
    return [r["y"] for r in df.orderBy("i").collect()]


@pytest.mark.parametrize(
    "given_text,expected",
    [("1e3", 1000), ("+5", 5), ("-0", 0), (" 5 ", 5), ("\t5\n", 5), ("5.", 5), ("１２", 12)],
)
def test_amounts_accepted(spark, given_text, expected):
    assert evaluate(spark, numbers.to_amount, [given_text]) == [Decimal(expected)]


def test_amounts_rejected(spark):
    bad = ["", "1_000", "NaN", "Infinity", "0x10", "1,000", "abc", None]
    assert evaluate(spark, numbers.to_amount, bad) == [None] * len(bad)


def test_money_rounds_to_even(spark):
    values = [Decimal("0.125"), Decimal("0.135"), Decimal("2.675"), Decimal("1.005"), Decimal("4167")]
    texts = evaluate(spark, numbers.money_text, values, "decimal(38,10)")
    assert texts == ["0.12", "0.14", "2.68", "1.00", "4167.00"]
    assert texts == [format(v, ".2f") for v in values]


def test_numbers(spark):
    good = ["5", " 5.5 ", "1e3", ".5", "5.", "-7", "5.e1", "+1E-2", "\t5.\n", "Inf", "-infinity"]
    bad = ["5d", "5F", "0x1p3", "0X1P3", "1,000", "NaN", "", ".", "e5", "1e", "- 5", "5 5", "x", None]
    assert evaluate(spark, numbers.to_number, good) == [float(v) for v in good]
    assert evaluate(spark, numbers.to_number, bad) == [None] * len(bad)


def test_counts(spark):
    assert evaluate(spark, numbers.to_count, ["3", " +4 ", "-1", "1.5", "x", ""]) == [3, 4, -1, None, None, None]


@given(st.lists(st.floats(0, 1e6), min_size=1, max_size=50))
@settings(max_examples=15, deadline=None)
def test_two_places_as_printf(spark, values):
    assert evaluate(spark, numbers.two_places, values, "double") == [f"{v:.2f}" for v in values]


def test_two_places_on_ties(spark):
    values = [i / 1000 for i in range(5, 100_000, 10)] + [0.125, 0.375, 2.675, 99.995]
    assert evaluate(spark, numbers.two_places, values, "double") == [f"{v:.2f}" for v in values]


def test_percent_text_of_nothing(spark):
    df = spark.createDataFrame([(0, 0), (1, 8), (5268, 541909), (3, 3)], "part long, total long")
    texts = [r[0] for r in df.select(numbers.percent_text(F.col("part"), F.col("total"))).collect()]
    assert texts == ["0.00%", "12.50%", "0.97%", "100.00%"]


def test_round_nearest_and_number_text(spark):
    assert evaluate(spark, numbers.round_nearest, [-2.5, 30.5, -0.4, 1.49], "double") == [-2, 31, 0, 1]
    values = [12.0, 12.5, 100.0, 0.1, 0.0, -3.0, 1e-7]
    expected = ["12", "12.5", "100", "0.1", "0", "-3", "0.0000001"]
    for ansi in ("true", "false"):
        spark.conf.set("spark.sql.ansi.enabled", ansi)
        try:
            assert evaluate(spark, numbers.number_text, values, "double") == expected
        finally:
            spark.conf.unset("spark.sql.ansi.enabled")


def test_strip_removes_what_python_strips(spark):
    values = ["\t x\n", "　x ", "\x1fx\x85", "  ", "a b", None]
    assert evaluate(spark, text.strip_ws, values) == [v.strip() if v is not None else None for v in values]


def test_missing_tokens(spark):
    values = ["NA", "null", "None", "nan", "", "N/A", "na", " NA", "0"]
    assert evaluate(spark, text.na_to_null, values) == [None] * 6 + ["na", " NA", "0"]


def test_marks_and_labels(spark):
    assert evaluate(spark, text.has_mark, ["C1", " c2", "1C", "", None]) == [True, True, False, False, False]
    df = spark.createDataFrame([("a", "b"), ("", "b"), ("a", None), (None, "")], "x string, y string")
    labels = [r[0] for r in df.select(text.join_parts(F.col("x"), F.col("y"))).collect()]
    assert labels == ["a, b", "b", "a", ""]


def test_biz_dates(spark):
    values = ["2026-07-18", "2026-7-8", "2026-02-30", "2026-99-99", " 2026-07-18", "2024-02-29", None]
    expected = [True, False, False, False, False, True, False]
    assert evaluate(spark, dates.is_biz_date, values) == expected
    for value, ok in zip(values[:-1], expected):
        if ok:
            assert dates.biz_date_key(value) == value.replace("-", "")
        else:
            with pytest.raises(DataError):
                dates.biz_date_key(value)


def test_times(spark):
    values = ["2011-01-01 00:00:00", "2011-01-01", "01/02/2011", "2011-13-01 00:00:00", "2011-01-01T00:00:00"]
    assert evaluate(spark, dates.to_time, values) == [datetime(2011, 1, 1)] + [None] * 4


def test_times_of_almost_the_form(spark):
    good = "2011-01-02 03:04:05"
    values = [good[:i] + c + good[i + 1 :] for i in range(len(good)) for c in "0 +-:.TZx٣"]
    values += [good + c for c in " Z.0"] + [c + good for c in " +-0"] + ["2011-1-2 03:04:05.67", "2011-01-02 3:4:5.678"]
    shape = re.compile(r"\d{4}-\d\d-\d\d \d\d:\d\d:\d\d", re.ASCII)

    def expected(value):
        try:
            return datetime.strptime(value, "%Y-%m-%d %H:%M:%S") if shape.fullmatch(value) else None
        except ValueError:
            return None

    assert evaluate(spark, dates.to_time, values) == [expected(v) for v in values]


def test_times_and_keys_do_not_depend_on_the_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
        # Midnight of this day did not exist there.
        assert evaluate(spark, dates.to_time, ["2017-10-15 00:30:00"]) == [datetime(2017, 10, 15, 0, 30)]
        keys = evaluate(spark, lambda c: dates.row_key(c, F.lit("u1")), [datetime(2017, 10, 15, 0, 30)], "timestamp_ntz")
        assert keys == ["20171015#u1"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_weekdays(spark):
    assert evaluate(spark, dates.weekday_label, [date(2026, 7, 18), date(2026, 7, 19)], "date") == ["周六", "周日"]
