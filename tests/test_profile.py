"""Data-quality profile on small and on empty tables."""

from collections import Counter

from batchkit.operators import profile as ops
from batchkit.operators.retail import COLUMNS, RETAIL_SCHEMA, clean, coerce_types
from batchkit.plans.retail_job import profile

ROWS = [
    ("C1", "s1", "d1", "-1", "2011-01-01 00:00:00", "2.5", "k1", "UK"),
    ("2", "s1", "d1", "3", "2011-01-02 00:00:00", "0", "k1", "UK"),
    ("2", "s1", "d1", "3", "2011-01-02 00:00:00", "0", "k1", "UK"),
    ("3", "s2", "NA", "0", "2011-01-03", "-1", "", "NA"),
    (" c4", "s3", "d", "many", "2011-01-04 10:00:00", "1", "k2", "FR"),
]


def typed(spark, rows=ROWS):
    return coerce_types(spark.createDataFrame(rows, ", ".join(f"{c} string" for c in COLUMNS)))


def test_typed_schema(spark):
    assert typed(spark).schema == RETAIL_SCHEMA


def test_report(spark):
    report = {(r["section"], r["metric"]): r["value"] for r in profile(typed(spark)).collect()}
    expected = {
        ("file", "row_count"): "5",
        ("file", "column_count"): "8",
        ("size", "invoices"): "4",
        ("size", "customers"): "2",
        ("size", "countries"): "2",
        ("size", "first_time"): "2011-01-01 00:00:00",
        ("size", "last_time"): "2011-01-04 10:00:00",
        ("duplicates", "count"): "1",
        ("duplicates", "share"): "20.00%",
        ("cancelled", "count"): "2",
        ("quantity", "invalid"): "2",
        ("quantity", "zero"): "1",
        ("unit_price", "invalid_share"): "60.00%",
        ("core_missing", "invoice_date"): "1",
        ("null_count", "quantity"): "1",
        ("top", "1 UK"): "3",
        ("top", "2 FR"): "1",
        ("top", "3 缺失"): "1",
    }
    assert {key: report[key] for key in expected} == expected
    text = ops.report_markdown(profile(typed(spark)), "Quality")
    assert text.startswith("# Quality\n") and "| share | 20.00% |" in text


def test_report_of_an_empty_table(spark):
    report = {(r["section"], r["metric"]): r["value"] for r in profile(typed(spark).limit(0)).collect()}
    assert report["file", "row_count"] == "0"
    assert report["duplicates", "share"] == "0.00%"
    assert report["size", "first_time"] is None


def test_null_profile_of_an_empty_table(spark):
    rows = ops.null_profile(typed(spark).limit(0)).collect()
    assert {(r["null_count"], r["null_rate"], r["null_percent"]) for r in rows} == {(0, None, "0.00%")}


def test_duplicates_take_missing_as_equal(spark):
    df = spark.createDataFrame([(None, None), (None, None), (1, None), (1, "a")], "i int, t string")
    assert tuple(ops.duplicate_count(df).first()) == (4, 1)
    assert tuple(ops.duplicate_count(df, wide=["t"]).first()) == (4, 1)
    assert tuple(ops.duplicate_count(df.limit(0)).first()) == (0, 0)


def test_copies_survive_collapse_and_repeat(spark):
    df = spark.createDataFrame([("hot",)] * 95 + [("b",)] * 2 + [("c",)], "t string")
    counted = ops.collapse_duplicates(df)
    for chunk in (1, 7, 94, 1000):
        extra = Counter(r["t"] for r in ops.repeat_copies(counted, chunk=chunk).collect())
        assert extra == {"hot": 94, "b": 1}


def test_distinct_counts(spark):
    df = spark.createDataFrame([("a", 1), ("a", None), ("b", 1)], "x string, y int")
    assert tuple(ops.distinct_counts(df, ["x", "y"]).first()) == (2, 1)
    assert tuple(ops.distinct_counts(df, ["x", "y"], approximate=True).first()) == (2, 1)


def test_top_values_break_ties_by_label(spark):
    df = spark.createDataFrame([(x,) for x in "ccbbad"] + [(None,)] * 3, "x string")
    rows = [tuple(r) for r in ops.top_values(df, "x", 4).orderBy("rank").collect()]
    assert rows == [(1, "缺失", 3), (2, "b", 2), (3, "c", 2), (4, "a", 1)]


def test_shape_of_marks(spark):
    assert tuple(ops.marked_share(typed(spark), "invoice_no").first()) == (5, 2, "40.00%")


def test_cleaning_rules(spark):
    rows = {r["invoice_no"]: r for r in clean(typed(spark)).collect()}
    assert rows["C1"]["is_cancelled"] and rows[" c4"]["is_cancelled"] and not rows["2"]["is_cancelled"]
    assert [rows[i]["quantity_class"] for i in ("C1", "2", "3", " c4")] == ["negative", "positive", "zero", "missing"]
    assert [rows[i]["price_class"] for i in ("C1", "2", "3")] == ["positive", "zero", "negative"]
    assert not rows["3"]["customer_usable"] and rows["3"]["lacks_description"]
