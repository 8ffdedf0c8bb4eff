"""Scores: range, repeated rows, averages, statistics of the output."""

import random

from pyspark.sql import functions as F

from batchkit.operators import scores as ops


def scores(spark, rows):
    return spark.createDataFrame(rows, ops.SCORE_SCHEMA)


def test_range_is_inclusive(spark):
    rows = [("s", "n", str(i), v, "c") for i, v in enumerate([0, 100, 101, -1, None, 85])]
    assert sorted(r["分数"] for r in ops.score_clean(scores(spark, rows)).collect()) == [0, 85, 100]


def test_survivor_does_not_depend_on_the_order(spark):
    rows = [("s1", "n", "math", 70, "c1"), ("s1", "n", "math", 80, "c2"), ("s1", "n", "math", 80, "c1")]
    for _ in range(3):
        random.shuffle(rows)
        df = scores(spark, rows).repartition(random.choice([1, 3, 7]))
        assert [tuple(r) for r in ops.score_clean(df).collect()] == [("s1", "n", "math", 80, "c1")]


def test_summary(spark):
    rows = [("s1", "a", "x", 84, "c"), ("s1", "a", "y", 85, "c"), ("s2", "b", "x", 90, "c"), ("s2", "b", "y", 79, "c")]
    result = [tuple(r) for r in ops.by_total(ops.score_summary(scores(spark, rows))).collect()]
    assert result == [("s1", "a", "c", 84.5, 169, 85, 2), ("s2", "b", "c", 84.5, 169, 90, 2)]


def test_average_rounds_half_up(spark):
    rows = [("s1", "a", str(i), v, "c") for i, v in enumerate([84, 84, 84, 85])]
    assert ops.score_summary(scores(spark, rows)).first()["平均分"] == 84.3


def test_output_stats(spark):
    df = spark.createDataFrame([("a", 84.3), ("b", 70.0), ("c", 55.5)], "id string, `平均分` double")
    assert tuple(ops.output_stats(df).first()) == (3, "69.9")
    assert tuple(ops.output_stats(df.filter("id = 'z'")).first()) == (0, "N/A")


def test_same_result_for_any_partitioning(spark):
    rng = random.Random(5)
    rows = [(f"s{rng.randrange(20)}", "n", f"k{rng.randrange(4)}", rng.randrange(-5, 110), f"c{rng.randrange(3)}") for _ in range(2000)]
    results = []
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for partitions in (1, 4, 64):
            rng.shuffle(rows)
            spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
            df = ops.by_total(ops.score_summary(ops.score_clean(scores(spark, rows))))
            results.append([tuple(r) for r in df.collect()])
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert results[0] == results[1] == results[2]


def test_hot_key_keeps_one_row(spark):
    """A student and subject holding most rows."""
    df = spark.range(30_000).select(
        F.when(F.col("id") > 10_000, "hot").otherwise(F.col("id").cast("string")).alias("学号"),
        F.lit("n").alias("姓名"),
        F.lit("x").alias("科目"),
        (F.col("id") % 101).cast("int").alias("分数"),
        F.lit("c").alias("班级"),
    )
    clean = ops.score_clean(df)
    assert clean.count() == 10_002
    assert clean.filter("`学号` = 'hot'").first()["分数"] == 100
