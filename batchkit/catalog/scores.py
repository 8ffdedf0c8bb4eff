"""Score queries: an order line is a subject of a student, its scaled quantity the score."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from batchkit.catalog.registry import query, table
from batchkit.operators import scores as ops
from batchkit.operators.checks import table_shape as shape
from batchkit.session import scratch_path
from batchkit.sources.csv import inferred_scan, typed_scan, write_csv

NAMES = ops.ScoreNames(
    student="student_id",
    name="name",
    subject="subject",
    score="score",
    group="class",
    average="average",
    total="total",
    highest="highest",
    subjects="subjects",
)

TIES = ("line_id", "supplier", "price", "shipped")


def score_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores from -6 to 110, missing where there is no discount."""
    doubled = F.col("l_quantity").cast("int") * 2
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("student_id"),
        F.concat(F.lit("Student "), F.col("l_orderkey").cast("string")).alias("name"),
        F.col("l_linenumber").cast("string").alias("subject"),
        F.when(F.col("l_discount") > 0, doubled + F.floor(F.col("l_quantity") / 2).cast("int") - 8).alias("score"),
        F.col("l_returnflag").alias("class"),
        F.col("l_partkey").alias("line_id"),
        F.col("l_suppkey").alias("supplier"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_shipdate").alias("shipped"),
    )


def _clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = [F.col("score").desc(), F.col("class"), *[F.col(c) for c in TIES]]
    return ops.score_clean(score_rows(spark, sf_dir), NAMES, order_by=order)


def _summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.score_summary(_clean(spark, sf_dir), NAMES)


CLEAN = """
scores AS (
    SELECT cast(l_orderkey AS varchar) AS student_id, 'Student ' || l_orderkey AS name,
           cast(l_linenumber AS varchar) AS subject, l_returnflag AS class,
           CASE WHEN l_discount > 0
                THEN cast(l_quantity AS integer) * 2 + cast(floor(l_quantity / 2) AS integer) - 8 END AS score,
           l_partkey AS line_id, l_suppkey AS supplier, l_extendedprice AS price, l_shipdate AS shipped
    FROM lineitem
),
clean AS (
    SELECT * FROM scores WHERE score BETWEEN 0 AND 100
    QUALIFY row_number() OVER (PARTITION BY student_id, subject
                               ORDER BY score DESC, class, line_id, supplier, price, shipped) = 1
),
summary AS (
    SELECT student_id, name, class, round(avg(score), 1) AS average, cast(sum(score) AS bigint) AS total,
           max(score) AS highest, count(*) AS subjects
    FROM clean GROUP BY student_id, name, class
)"""


@query(f"WITH {CLEAN} SELECT student_id, name, subject, score, class, line_id, supplier FROM clean")
def score_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _clean(spark, sf_dir).select("student_id", "name", "subject", "score", "class", "line_id", "supplier")


@query(f"WITH {CLEAN} SELECT * FROM summary")
def score_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.by_total(_summary(spark, sf_dir), NAMES)


@query(
    f"""
    WITH {CLEAN}
    SELECT count(*) AS row_count,
           cast(cast(round(sum(cast(round(average * 10) AS bigint)) / count(*) / 10, 1) AS decimal(20,1)) AS varchar)
               AS mean_average
    FROM summary
    """
)
def output_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics of a score summary that was written as CSV and read back."""
    summary = _summary(spark, sf_dir)
    path = scratch_path(spark, "scores")
    write_csv(ops.by_total(summary, NAMES), path)
    return ops.output_stats(typed_scan(spark, path, summary.schema, strict=True), "average")


@query('SELECT c_mktsegment AS "class", count(*) AS row_count FROM customer GROUP BY 1')
def class_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per group of a CSV file whose types are inferred."""
    path = scratch_path(spark, "students")
    rows = table(spark, sf_dir, "customer").withColumnRenamed("c_mktsegment", "class")
    write_csv(rows, path)
    return ops.class_counts(inferred_scan(spark, path), "class")


@query(
    """
    SELECT (SELECT count(*) FROM lineitem) AS row_count,
           (SELECT count(*) FROM (DESCRIBE lineitem)) AS column_count
    """
)
def table_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shape(table(spark, sf_dir, "lineitem"))
