"""Retail queries. Order lines stand for the retail file: eight text columns under the source's names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from batchkit.catalog.registry import query, table
from batchkit.operators import retail as ops
from batchkit.session import scratch_path
from batchkit.sources.csv import na_scan, write_csv


def source_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Returned lines become cancelled invoices; other lines get gaps, zeros and bad texts."""
    flag, status, number = F.col("l_returnflag"), F.col("l_linestatus"), F.col("l_linenumber")
    quantity = F.col("l_quantity").cast("int").cast("string")
    return table(spark, sf_dir, "lineitem").select(
        F.concat(F.when(flag == "R", " c").otherwise(""), F.col("l_orderkey").cast("string")).alias("InvoiceNo"),
        F.col("l_partkey").cast("string").alias("StockCode"),
        F.when(F.col("l_tax") == 0.0, "NA")
        .otherwise(F.concat(F.lit("item "), F.col("l_partkey").cast("string")))
        .alias("Description"),
        F.when(flag == "R", F.concat(F.lit("-"), quantity))
        .when(F.col("l_discount") == 0.05, "0")
        .when(F.col("l_discount") == 0.06, "many")
        .when((F.col("l_discount") == 0.04) & (number == 2), "1000000000000")
        .otherwise(quantity)
        .alias("Quantity"),
        F.when(number == 7, F.col("l_shipdate").cast("date").cast("string"))
        .otherwise(F.substring(F.col("l_shipdate").cast("string"), 1, 19))
        .alias("InvoiceDate"),
        F.when(F.col("l_discount") == 0.1, "0")
        .when((F.col("l_discount") == 0.09) & (flag == "R"), "-1.50")
        .when((F.col("l_discount") == 0.07) & (number == 1), "0.1234567891")
        .when((F.col("l_discount") == 0.08) & (number == 1), "2e11")
        .otherwise(F.col("l_extendedprice").cast("string"))
        .alias("UnitPrice"),
        F.when((status == "F") & (number > 5), "").otherwise(F.col("l_suppkey").cast("string")).alias("CustomerID"),
        F.when((flag == "A") & (number == 3), "null").otherwise(F.concat(flag, number.cast("string"))).alias("Country"),
    )


def raw_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.normalise(source_rows(spark, sf_dir))


def typed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.coerce_types(raw_rows(spark, sf_dir))


TYPED = """
retail AS (
    SELECT CASE WHEN l_returnflag = 'R' THEN ' c' ELSE '' END || l_orderkey AS invoice_no,
           cast(l_partkey AS varchar) AS stock_code,
           CASE WHEN l_tax <> 0.0 THEN 'item ' || l_partkey END AS description,
           CASE WHEN l_returnflag = 'R' THEN -l_quantity WHEN l_discount = 0.05 THEN 0
                WHEN l_discount = 0.06 THEN NULL WHEN l_discount = 0.04 AND l_linenumber = 2 THEN 1e12
                ELSE l_quantity END AS quantity,
           CASE WHEN l_linenumber <> 7 THEN l_shipdate END AS invoice_date,
           CASE WHEN l_discount = 0.1 THEN 0 WHEN l_discount = 0.09 AND l_returnflag = 'R' THEN -1.5
                WHEN l_discount = 0.07 AND l_linenumber = 1 THEN 0.1234567891
                WHEN l_discount = 0.08 AND l_linenumber = 1 THEN 2e11
                ELSE l_extendedprice END AS unit_price,
           CASE WHEN NOT (l_linestatus = 'F' AND l_linenumber > 5) THEN cast(l_suppkey AS varchar) END AS customer_id,
           CASE WHEN NOT (l_returnflag = 'A' AND l_linenumber = 3) THEN l_returnflag || l_linenumber END AS country
    FROM lineitem
)"""

CLEAN = f"""
{TYPED},
cleaned AS (
    SELECT *, starts_with(upper(trim(coalesce(invoice_no, ''))), 'C') AS is_cancelled,
           CASE WHEN quantity > 0 THEN 'positive' WHEN quantity = 0 THEN 'zero'
                WHEN quantity < 0 THEN 'negative' ELSE 'missing' END AS quantity_class,
           CASE WHEN unit_price > 0 THEN 'positive' WHEN unit_price = 0 THEN 'zero'
                WHEN unit_price < 0 THEN 'negative' ELSE 'missing' END AS price_class,
           customer_id IS NOT NULL AS customer_usable,
           description IS NULL AS lacks_description
    FROM retail
)"""


@query(f"WITH {TYPED} SELECT * FROM retail")
def normalise_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Standard names, written as the raw CSV layer, read back with types."""
    path = scratch_path(spark, "raw")
    write_csv(raw_rows(spark, sf_dir), path)
    return ops.coerce_types(na_scan(spark, path, ops.COLUMNS))


@query(f"WITH {CLEAN} SELECT * FROM cleaned")
def retail_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.clean(typed_rows(spark, sf_dir))


# The amounts again, as whole numbers of 1e-10: quantities are whole, prices in cents or one of the odd ones.
@query(
    f"""
    WITH {CLEAN},
    whole AS (
        SELECT customer_id, is_cancelled, cast(quantity AS hugeint) *
               CASE unit_price WHEN 0.1234567891 THEN 1234567891 WHEN 2e11 THEN 2000000000000000000000
                    ELSE cast(round(unit_price * 100) AS hugeint) * 100000000 END AS units
        FROM cleaned WHERE customer_usable),
    summed AS (
        SELECT customer_id, count(*) AS line_count, count(*) FILTER (is_cancelled) AS cancelled_lines,
               count(*) FILTER (units IS NULL) AS unusable_lines, sum(units)::hugeint AS total
        FROM whole GROUP BY customer_id),
    cut AS (SELECT *, abs(total) // 100000000 AS cents, abs(total) % 100000000 AS rest FROM summed)
    SELECT customer_id, line_count, cancelled_lines, unusable_lines,
           cast(((cents + CASE WHEN rest > 50000000 OR (rest = 50000000 AND cents % 2 = 1) THEN 1 ELSE 0 END)
                 * sign(total)) // 100 || '.' ||
                lpad(cast((cents + CASE WHEN rest > 50000000 OR (rest = 50000000 AND cents % 2 = 1) THEN 1 ELSE 0 END)
                          % 100 AS varchar), 2, '0') AS decimal(38,2)) AS total_amount
    FROM cut
    """
)
def retail_sql_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.customer_summary(ops.clean(ops.coerce_types(raw_rows(spark, sf_dir), keep_texts=True)))
