"""Order queries over rows (order_id, user_id, amount), typed as the table has them or as text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from batchkit.catalog.registry import query, table
from batchkit.operators import checks
from batchkit.operators import orders as ops
from batchkit.session import scratch_path
from batchkit.sources.csv import SOURCE_FILE, text_scan, write_csv
from batchkit.sources.records import LINE


def order_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("user_id"),
        F.col("o_totalprice").alias("amount"),
    )


def faulty_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders, with faults put into those of some status and priority."""
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    pending = status == "P"
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint")
    two_places = F.concat(F.floor(cents / 100).cast("string"), F.lit("."), F.lpad((cents % 100).cast("string"), 2, "0"))
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(pending & (priority == "1-URGENT"), "").otherwise(F.col("o_orderkey").cast("string")).alias("order_id"),
        F.when(pending & (priority == "2-HIGH"), " \t").otherwise(F.col("o_custkey").cast("string")).alias("user_id"),
        F.when(pending & (priority == "3-MEDIUM"), "abc")
        .when(pending & (priority == "5-LOW"), "-5.00")
        .when((status == "F") & (priority == "5-LOW"), "")
        .when((status == "F") & (priority == "2-HIGH"), "0")
        .when((status == "F") & (priority == "1-URGENT"), "1e99")
        .when((status == "F") & (priority == "3-MEDIUM"), "1e-40")
        .when((status == "O") & (priority == "1-URGENT"), F.concat(cents.cast("string"), F.lit("e25")))
        .when((status == "O") & (priority == "2-HIGH"), F.concat(two_places, F.lpad(F.col("o_orderkey").cast("string"), 13, "0")))
        .otherwise(F.concat(F.lit(" "), F.col("o_totalprice").cast("string")))
        .alias("amount"),
    )


FAULTY = """
faulty AS (
    SELECT o_orderkey, cast(o_custkey AS varchar) AS user_id,
           CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '1-URGENT' THEN 'order_id_empty'
                WHEN o_orderstatus = 'P' AND o_orderpriority = '2-HIGH' THEN 'user_id_empty'
                WHEN o_orderstatus = 'P' AND o_orderpriority = '3-MEDIUM' THEN 'amount_invalid'
                WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW' THEN 'amount_negative'
                WHEN o_orderstatus = 'F' AND o_orderpriority = '5-LOW' THEN 'amount_invalid'
                WHEN o_orderstatus = 'F' AND o_orderpriority = '1-URGENT' THEN 'amount_out_of_range'
                WHEN o_orderstatus = 'F' AND o_orderpriority = '3-MEDIUM' THEN 'amount_too_fine'
           END AS reason,
           CASE WHEN o_orderstatus = 'F' AND o_orderpriority = '2-HIGH' THEN 0 ELSE o_totalprice END AS amount
    FROM orders
)"""


@query(
    """
    SELECT o_custkey AS user_id, count(*) AS order_count,
           cast(round_even(sum(cast(o_totalprice AS decimal(28,10))), 2) AS decimal(38,2)) AS total_amount
    FROM orders GROUP BY o_custkey
    """
)
def user_order_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.user_summary(ops.tag_rejects(order_rows(spark, sf_dir)))


@query(
    """
    SELECT cast(o_custkey AS varchar) AS user_id, cast(count(*) AS varchar) AS order_count,
           cast(cast(round_even(sum(cast(o_totalprice AS decimal(28,10))), 2) AS decimal(38,2)) AS varchar)
               AS total_amount
    FROM orders GROUP BY o_custkey
    """
)
def summary_text_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "summary")
    write_csv(ops.summary_text(user_order_summary(spark, sf_dir)), path)
    return text_scan(spark, path, ("user_id", "order_count", "total_amount"))


@query(f"WITH {FAULTY} SELECT o_orderkey, reason FROM faulty")
def order_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.tag_rejects(faulty_orders(spark, sf_dir)).select("o_orderkey", "reason")


# Totals as two whole numbers, of ones and of 1e-15: one amount class is a multiple of 1e25, one has 15 decimals.
@query(
    f"""
    WITH {FAULTY},
    priced AS (
        SELECT o_orderkey, o_orderstatus AS status, o_orderpriority AS priority,
               cast(round(o_totalprice * 100) AS hugeint) AS cents
        FROM orders),
    parts AS (
        SELECT user_id,
               CASE WHEN status = 'F' AND priority = '2-HIGH' THEN 0
                    WHEN status = 'O' AND priority = '1-URGENT' THEN cents * 10000000000000000000000000
                    ELSE cents // 100 END AS ones,
               CASE WHEN (status = 'F' AND priority = '2-HIGH') OR (status = 'O' AND priority = '1-URGENT') THEN 0
                    WHEN status = 'O' AND priority = '2-HIGH' THEN (cents % 100) * 10000000000000 + o_orderkey
                    ELSE (cents % 100) * 10000000000000 END AS fine
        FROM faulty JOIN priced USING (o_orderkey) WHERE reason IS NULL),
    summed AS (
        SELECT user_id, count(*) AS n, sum(ones)::hugeint + sum(fine)::hugeint // 1000000000000000 AS ones,
               sum(fine)::hugeint % 1000000000000000 AS fine
        FROM parts GROUP BY user_id),
    cut AS (SELECT *, ones * 100 + fine // 10000000000000 AS cents, fine % 10000000000000 AS rest FROM summed),
    rounded AS (
        SELECT *, cents + CASE WHEN rest > 5000000000000 OR (rest = 5000000000000 AND cents % 2 = 1) THEN 1 ELSE 0 END
                  AS shown
        FROM cut)
    SELECT user_id, cast(n AS varchar) AS order_count,
           shown // 100 || '.' || lpad(cast(shown % 100 AS varchar), 2, '0') AS total_amount
    FROM rounded
    """
)
def wide_amount_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals of amounts up to 1e32 and with up to 15 decimals, none rounded before the sum."""
    return ops.totals_text(ops.order_rollup(ops.tag_rejects(faulty_orders(spark, sf_dir))))


@query(
    f"""
    WITH {FAULTY},
    placed AS (
        SELECT o_orderkey, o_orderstatus, 1 + row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderkey) AS line
        FROM orders)
    SELECT cast(o_orderkey AS varchar) AS o_orderkey, o_orderstatus, line, reason
    FROM faulty JOIN placed USING (o_orderkey) WHERE reason IS NOT NULL
    """
)
def order_reject_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejected records of text files with line breaks in their cells, with the place a serial reader gives them."""
    rows = faulty_orders(spark, sf_dir).join(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus"), "o_orderkey")
    note = F.concat(F.lit('two\n"lines", '), F.col("amount"))
    path = scratch_path(spark, "orders")
    # One file per status, in the order of keys.
    placed = rows.withColumn("note", note).repartition("o_orderstatus").sortWithinPartitions("o_orderstatus", "o_orderkey")
    write_csv(placed, path, partition_by=("o_orderstatus",))
    scanned = text_scan(spark, path, ops.REQUIRED, flag_extra=True, name_file=True, name_line=True, multiline=True)
    return ops.rejects(ops.tag_rejects(scanned)).select(
        "o_orderkey",
        F.regexp_extract(SOURCE_FILE, "o_orderstatus=([A-Z])", 1).alias("o_orderstatus"),
        F.col(LINE).alias("line"),
        "reason",
    )


@query(
    f"""
    WITH {FAULTY}
    SELECT coalesce(reason, 'valid') AS reason, count(*) AS row_count FROM faulty GROUP BY 1
    """
)
def reject_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.reject_counts(ops.tag_rejects(faulty_orders(spark, sf_dir)))


@query(
    f"""
    WITH {FAULTY}
    SELECT count(*) FILTER (reason IS NULL) AS valid_rows, count(*) FILTER (reason IS NOT NULL) AS skipped_rows,
           count(DISTINCT user_id) FILTER (reason IS NULL) AS users
    FROM faulty
    """
)
def order_run_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counts of a daily run, from faulty orders that went through a text file."""
    path = scratch_path(spark, "orders")
    write_csv(faulty_orders(spark, sf_dir).drop("o_orderkey"), path)
    tagged = ops.tag_rejects(text_scan(spark, path, ops.REQUIRED, flag_extra=True))
    return ops.counts_of(ops.order_rollup(tagged))


@query(
    """
    SELECT o_orderkey,
           CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '1-URGENT' THEN 'user_id_empty'
                WHEN o_orderstatus = 'P' AND o_orderpriority = '2-HIGH' THEN 'order_count_invalid'
                WHEN o_orderstatus = 'P' AND o_orderpriority = '3-MEDIUM' THEN 'order_count_negative'
                WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW' THEN 'total_amount_invalid'
                ELSE 'total_amount_negative' END AS reason
    FROM orders
    WHERE (o_orderstatus = 'P' AND o_orderpriority <> '4-NOT SPECIFIED')
       OR (o_orderstatus = 'F' AND o_orderpriority = '5-LOW')
    """
)
def strict_summary_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    pending = status == "P"
    rows = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(pending & (priority == "1-URGENT"), "").otherwise(F.col("o_custkey").cast("string")).alias("user_id"),
        F.when(pending & (priority == "2-HIGH"), "1.5")
        .when(pending & (priority == "3-MEDIUM"), "-1")
        .otherwise("1")
        .alias("order_count"),
        F.when(pending & (priority == "5-LOW"), "1,000")
        .when((status == "F") & (priority == "5-LOW"), "-0.01")
        .otherwise(F.col("o_totalprice").cast("string"))
        .alias("total_amount"),
    )
    checks.require_rows(rows, "orders")
    return checks.summary_violations(rows).select("o_orderkey", "reason")


@query(
    """
    SELECT count(DISTINCT o_custkey) AS written, count(DISTINCT o_custkey) AS "read",
           cast(0 AS bigint) AS missing, cast(0 AS bigint) AS unexpected
    FROM orders
    """
)
def readback_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    summary = user_order_summary(spark, sf_dir)
    path = scratch_path(spark, "summary")
    summary.write.parquet(path)
    return checks.readback_diff(summary, spark.read.parquet(path))


@query(
    """
    SELECT count(*) AS row_count, max(o_orderkey) - min(o_orderkey) + 1 AS expected,
           count(*) = max(o_orderkey) - min(o_orderkey) + 1 AS "matches"
    FROM orders
    """
)
def row_count_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order keys are dense: as many rows are expected as the key range is wide."""
    width = F.max("o_orderkey") - F.min("o_orderkey") + 1
    return checks.row_count_check(table(spark, sf_dir, "orders"), width)
