"""Physical plans: pruning, pushdown, partial aggregation, no single task on unbounded data."""

import re

import pytest
from pyspark.sql import functions as F

from batchkit.sources.files import file_manifest
from batchkit.catalog import QUERIES
from batchkit.catalog.keyed import keyed_table
from batchkit.catalog.sources import dated_events
from batchkit.operators import keyed, nested, profile
from batchkit.session import scratch_path
from batchkit.sources import layers

SF_DIR = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def scanned(text: str) -> set[str]:
    """The columns that the scans read."""
    return set(re.findall(r"(\w+):", " ".join(re.findall(r"ReadSchema: struct<(.*?)>(?:\n|$|,)", text))))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_of_every_query(spark, name):
    """No Python, no pairing of all rows, and rows go to a single task only as partial results."""
    text = plan(QUERIES[name](spark, SF_DIR))
    for node in ("Python", "InPandas", "CartesianProduct", "BroadcastNestedLoopJoin", "collect_set"):
        assert node not in text
    lines = text.splitlines()
    for number, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            assert re.search(r"Aggregate\(.*functions=\[(partial|merge)_", lines[number + 1]), lines[number + 1]


def test_flagship_reads_three_columns_once(spark):
    text = plan(QUERIES["user_order_summary"](spark, SF_DIR))
    assert scanned(text) == {"o_orderkey", "o_custkey", "o_totalprice"}
    assert text.count("Exchange") == 1 and "partial_sum" in text


def test_profile_reads_the_counted_columns(spark):
    assert scanned(plan(QUERIES["date_range"](spark, SF_DIR))) == {"l_linenumber", "l_shipdate"}


def test_score_filter_comes_before_the_shuffle(spark):
    text = plan(QUERIES["score_summary"](spark, SF_DIR))
    partial = text.index("row_number(), 1, Partial")
    shuffle = text.index("Exchange hashpartitioning(student_id", text.index("WindowGroupLimit"))
    assert shuffle < partial < text.index("Filter", partial), "read from the bottom up"


def test_date_slice_opens_one_folder(spark):
    path = scratch_path(spark, "layer")
    events = dated_events(spark, SF_DIR)
    layers.write_slices(events, path)
    df = layers.read_slice(spark, path, "2024-01-02", events.schema)
    assert re.search(r"PartitionFilters: \[.*biz_date#\d+ = 2024-01-02", plan(df))


def test_keyed_scans_push_the_key(spark):
    table = keyed_table(spark, SF_DIR)
    prefix, point = plan(keyed.prefix_scan(table, "20240102#")), plan(keyed.point_get(table, "20240102#8"))
    assert "StringStartsWith(row_key,20240102#)" in prefix and "biz_date" in prefix.split("PartitionFilters")[1]
    assert "EqualTo(row_key,20240102#8)" in point and "biz_date" in point.split("PartitionFilters")[1]
    assert "TakeOrderedAndProject(limit=10" in plan(keyed.limit_scan(table))


def test_upsert_combines_before_the_shuffle(spark):
    rows = dated_events(spark, SF_DIR)
    assert "partial_max_by" in plan(keyed.latest_per_key(rows, "user_id", ["event_type"], ["ts", "event_id"]))


def test_digested_duplicates_do_not_shuffle_the_text(spark):
    df = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("text", "lang")
    text = plan(profile.duplicate_count(df, wide=["text"]))
    assert text.index("Exchange hashpartitioning(text") < text.index("sha2(")


def test_code_table_is_broadcast(spark):
    text = plan(nested.lookup_code(spark.range(10).select(F.col("id").cast("int").alias("code_")), "code_"))
    assert "BroadcastHashJoin" in text


def test_file_manifest_does_not_read_content(spark):
    assert "content" not in scanned(plan(file_manifest(spark, SF_DIR)))


def test_dates_with_most_rows_are_written_by_several_tasks(spark):
    """Rebalancing splits a date that holds nearly everything; each date is still written once."""
    path = scratch_path(spark, "skew")
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    try:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256k")
        df = spark.range(0, 400_000, 1, 8).select(
            "id",
            F.sha2(F.col("id").cast("string"), 256).alias("t"),
            F.when(F.col("id") < 390_000, "2026-01-01").otherwise("2026-01-02").cast("date").alias("biz_date"),
        )
        layers.write_slices(df, path, ("id",))
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
    hot = [f for f in spark.read.parquet(path).inputFiles() if "biz_date=2026-01-01" in f]
    assert len(hot) > 4
    assert spark.read.parquet(path).count() == 400_000


def test_validity_of_typed_orders_reaches_the_scan(spark):
    assert "GreaterThanOrEqual(o_total" in plan(QUERIES["user_order_summary"](spark, SF_DIR))
