"""The profile per date, merged, against the profile of all rows."""

import os

import pytest
from pyspark.sql import functions as F

from batchkit.operators import profile, profile_slices
from batchkit.operators.retail import COLUMNS, RETAIL_SCHEMA
from batchkit.plans.retail_job import PROFILE

ROWS = [
    ("C1", "a", "lamp", -1.0, "2011-01-01 08:00:00", 2.5, "k1", "UK"),
    ("2", "b", None, 0.0, "2011-01-02 08:00:00", 1.25, None, None),
    ("2", "b", None, 0.0, "2011-01-02 08:00:00", 1.25, None, None),
    ("3", "a", "cup", None, "2011-01-03 09:00:00", 0.0, "k1", "缺失"),
    ("3", "a", "cup", 4.0, None, -1.0, "k2", "FR"),
    ("3", "a", "cup", 4.0, None, -1.0, "k2", "FR"),
]


@pytest.fixture(scope="module")
def dated(spark):
    text = spark.createDataFrame(ROWS, ", ".join(f"{f.name} {'double' if f.dataType.typeName() == 'double' else 'string'}" for f in RETAIL_SCHEMA))
    return text.withColumn("invoice_date", F.col("invoice_date").cast("timestamp_ntz")).withColumn("biz_date", F.to_date("invoice_date"))


def report(df):
    return sorted(tuple(r) for r in df.collect())


def test_dates_one_by_one_equal_all_at_once(spark, dated, tmp_path):
    path = str(tmp_path / "profile")
    whole = profile.quality_report(dated.drop("biz_date"), **vars(PROFILE), wide=("description",))
    for day in ("2011-01-03", "2011-01-01", "2011-01-02"):
        profile_slices.update(dated.filter(F.col("biz_date") == F.lit(day)), path, PROFILE)
    before = {f: os.stat(f).st_mtime_ns for f in files(path)}
    profile_slices.update(dated.filter("biz_date IS NULL"), path, PROFILE)
    assert before.items() <= {f: os.stat(f).st_mtime_ns for f in files(path)}.items() and before
    assert report(profile_slices.merged_report(spark, path, COLUMNS, PROFILE)) == report(whole)


def files(path):
    return [f"{d}/{n}" for d, _, names in os.walk(path) for n in names if n.endswith(".parquet")]


def test_a_changed_date_replaces_its_summaries(spark, dated, tmp_path):
    path = str(tmp_path / "profile")
    profile_slices.update(dated, path, PROFILE)
    changed = dated.filter("biz_date = DATE '2011-01-02'").limit(1).withColumn("country", F.lit("IT"))
    profile_slices.update(changed, path, PROFILE)
    rows = dated.filter("biz_date IS NULL OR biz_date <> DATE '2011-01-02'").unionByName(changed).drop("biz_date")
    whole = profile.quality_report(rows, **vars(PROFILE))
    assert report(profile_slices.merged_report(spark, path, COLUMNS, PROFILE)) == report(whole)


def test_no_rows(spark, dated, tmp_path):
    path = str(tmp_path / "profile")
    profile_slices.update(dated.limit(0), path, PROFILE)
    empty = {(s, m): v for s, m, v in report(profile.quality_report(dated.limit(0).drop("biz_date"), **vars(PROFILE)))}
    assert empty["file", "row_count"] == "0"
