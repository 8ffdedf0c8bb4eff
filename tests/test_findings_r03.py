"""Fixes of the third round's findings outside the training-data operators."""

from pyspark.sql import functions as F
from test_digests import put, splits, tree  # noqa: F401

from batchkit.catalog import sources
from batchkit.functions import exact
from batchkit.operators import orders as ops
from batchkit.operators import profile_slices
from batchkit.sources import digests


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_amounts_are_parsed_once(spark):
    rows = [("1", "a", "1.005"), ("2", "a", "12e30"), ("3", "b", "0.00000000000000001"), ("4", "b", "x"), ("5", "b", None)]
    df = spark.createDataFrame(rows, "order_id string, user_id string, amount string")
    rollup = ops.order_rollup(ops.tag_rejects(df))
    assert optimized(rollup).count(exact._NUMBER) == 1
    typed = df.select("order_id", "user_id", F.col("amount").try_cast("double").alias("amount"))
    assert optimized(ops.order_rollup(ops.tag_rejects(typed))).count(exact._NUMBER) == 1
    assert [tuple(r) for r in ops.totals_text(rollup).collect()] == [
        ("a", "2", "12000000000000000000000000000001.00"), ("b", "1", "0.00"),
    ]


def test_totals_are_put_into_words_after_the_sort(spark):
    df = spark.range(10).select(F.col("id").alias("order_id"), F.col("id").alias("user_id"), F.col("id").cast("double").alias("amount"))
    plan = optimized(ops.totals_text(ops.order_rollup(ops.tag_rejects(df))))
    assert plan.index("total_amount") < plan.index("Sort [")
    assert "lpad" not in plan[plan.index("Sort [") : plan.index("Aggregate [")]


def test_parts_of_a_folder_are_one_text(spark, tmp_path, splits):  # noqa: F811
    data = [b"".join(b"line %d of %d\n" % (n, part) for n in range(part * 37 % 300 + 1)) for part in range(12)]
    for part, lines in enumerate(data):
        put(str(tmp_path / "in"), f"part-{part:05d}-x.txt", lines)
    whole = b"".join(data)
    for size, broadcast_splits in (("333b", 0), ("100000b", 1 << 19)):
        splits(size)
        row = digests.tree_digests(spark, str(tmp_path / "in"), 700, broadcast_splits, parts=True).collect()
        assert [(r.size_bytes, r.blocks, r.sha256) for r in row] == [(len(whole), *tree(whole, 700))]


def test_no_task_sorts_the_whole_text(spark, monkeypatch, tmp_path):
    written = []
    path = str(tmp_path / "tree")
    monkeypatch.setattr(sources, "scratch_path", lambda spark, label: path)
    monkeypatch.setattr(sources.digests, "tree_digests", lambda spark, path, **_: written.append(path) or spark.range(1).toDF("name"))
    spark.range(50_000).selectExpr(
        "id AS o_orderkey", "id AS o_custkey", "repeat('s', 400) AS o_orderstatus", "'p' AS o_orderpriority"
    ).write.parquet(str(tmp_path / "orders.parquet"))
    merging = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(merging, "false")
    try:
        sources.file_tree_digest(spark, str(tmp_path))
    finally:
        spark.conf.set(merging, "true")
    assert len(spark.read.text(written[0]).inputFiles()) > 1


def test_merged_values_are_read_once(spark, tmp_path):
    rows = spark.createDataFrame([(1, "x", "2024-01-01"), (2, "x", "2024-01-02")], "id int, kind string, day string")
    spec = profile_slices.ProfileSpec({"ids": "id"}, "kind", ["id"], ["kind"], "day", "kind")
    path = str(tmp_path / "profile")
    profile_slices.update(rows.withColumn("biz_date", F.to_date("day")), path, spec)
    report = profile_slices.merged_report(spark, path, ["id", "kind", "day"], spec)
    assert not [f for f in report.inputFiles() if "/profile/values/" in f]
    assert {("size", "ids", "2"), ("top", "1 x", "2")} <= {tuple(r) for r in report.collect()}
