"""Scans and sinks, each over a whole table that is written first in the form to be read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from batchkit.catalog.registry import query, table
from batchkit.functions.dates import is_biz_date, to_time
from batchkit.functions.numbers import to_number
from batchkit.functions.text import digest
from batchkit.operators import checks
from batchkit.session import scratch_path
from batchkit.sources import csv, digests, files, layers
from batchkit.sources.records import LINE


@query(
    """
    SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders
    """
)
def typed_csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders")
    path = scratch_path(spark, "typed")
    csv.write_csv(rows, path)
    return csv.typed_scan(spark, path, rows.schema, strict=True)


@query("SELECT doc_id, nullif(text, '') AS text, lang, source, n_chars FROM documents")
def multiline_csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts with line breaks and quotes, written as CSV and read by as many tasks as the files have splits."""
    rows = table(spark, sf_dir, "documents")
    path = scratch_path(spark, "multiline")
    csv.write_csv(rows, path)
    return csv.typed_scan(spark, path, rows.schema, strict=True, multiline=True)


@query("SELECT cast(c_custkey AS varchar) AS c_custkey, c_name, c_mktsegment FROM customer")
def trimmed_text_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Header and cells padded with blanks and tabs come back without them."""
    padded = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias(" c_custkey"),
        F.concat(F.lit("\t "), F.col("c_name"), F.lit("  ")).alias("c_name "),
        F.concat(F.lit(" "), F.col("c_mktsegment"), F.lit("\t")).alias("\tc_mktsegment"),
    )
    path = scratch_path(spark, "padded")
    csv.write_csv(padded, path)
    return csv.text_scan(spark, path, ("c_custkey", "c_name", "c_mktsegment"))


@query(
    """
    SELECT cast(event_id AS varchar) AS event_id, CASE WHEN event_type = 'click' THEN event_type END AS event_type,
           cast(user_id AS varchar) AS user_id
    FROM events
    """
)
def na_token_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    rows = table(spark, sf_dir, "events").select(
        "event_id",
        F.when(kind == "signup", "NA")
        .when(kind == "view", "null")
        .when(kind == "error", "")
        .when(kind == "purchase", "N/A")
        .otherwise(kind)
        .alias("event_type"),
        "user_id",
    )
    path = scratch_path(spark, "tokens")
    csv.write_csv(rows, path)
    return csv.na_scan(spark, path, ("event_id", "event_type", "user_id"))


@query(
    """
    SELECT event_id, CASE WHEN event_type IN ('click', 'error') THEN NULL ELSE value END AS value,
           CASE WHEN event_type IN ('view', 'signup') THEN NULL ELSE date_trunc('second', ts) END AS ts
    FROM events
    """
)
def coerce_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text to number and to timestamp, with texts of a wrong form among them."""
    kind, second = F.col("event_type"), F.substring(F.col("ts").cast("string"), 1, 19)
    text = table(spark, sf_dir, "events").select(
        "event_id",
        F.when(kind == "click", "12d")
        .when(kind == "error", "1,000")
        .otherwise(F.concat(F.lit(" "), F.col("value").cast("string")))
        .alias("value"),
        F.when(kind == "view", F.substring(second, 1, 10))
        .when(kind == "signup", F.replace(second, F.lit("-"), F.lit("/")))
        .otherwise(second)
        .alias("ts"),
    )
    return text.select("event_id", to_number(F.col("value")).alias("value"), to_time(F.col("ts")).alias("ts"))


@query(
    """
    WITH lines AS (
        SELECT o_orderkey, concat_ws(',', o_orderkey, o_custkey, o_orderstatus, o_orderpriority) || chr(10) AS line
        FROM orders),
    placed AS (
        SELECT *, coalesce(sum(strlen(line)) OVER (ORDER BY o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
                  // 65536 AS block
        FROM lines),
    hashed AS (
        SELECT block, sum(strlen(line)) AS n, sha256(string_agg(line, '' ORDER BY o_orderkey)) AS sha256
        FROM placed GROUP BY block)
    SELECT cast(sum(n) AS bigint) AS size_bytes, count(*) AS blocks, sha256(string_agg(sha256, '' ORDER BY block)) AS sha256
    FROM hashed
    """
)
def file_tree_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The digest tree of one text of all orders, sorted and written as many files, in blocks of 64 KiB."""
    columns = ("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    rows = table(spark, sf_dir, "orders").select("o_orderkey", F.concat_ws(",", *columns).alias("line"))
    path = scratch_path(spark, "tree")
    rows.orderBy("o_orderkey").select("line").write.text(path)
    return digests.tree_digests(spark, path, block_bytes=1 << 16, parts=True).drop("name")


def dated_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").withColumn(layers.BIZ_DATE, F.col("ts").cast("date"))


@query(
    """
    SELECT event_id, user_id, event_type, value, cast(ts AS date) AS biz_date
    FROM events WHERE cast(ts AS date) = DATE '2024-01-02'
    """
)
def biz_date_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "layer")
    events = dated_events(spark, sf_dir)
    layers.write_slices(events, path)
    return layers.read_slice(spark, path, "2024-01-02", events.schema).select(
        "event_id", "user_id", "event_type", "value", "biz_date"
    )


@query("SELECT cast(ts AS date) AS biz_date, count(*) AS row_count, sum(user_id)::bigint AS user_sum FROM events GROUP BY 1")
def idempotent_date_rewrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write all dates, then one date twice more: nothing is doubled or lost."""
    path = scratch_path(spark, "layer")
    events = dated_events(spark, sf_dir)
    layers.write_slices(events, path)
    for _ in range(2):
        layers.write_slices(events.filter(F.col("biz_date") == F.lit("2024-01-02").cast("date")), path)
    return (
        layers.read_layer(spark, path, events.schema)
        .groupBy("biz_date")
        .agg(F.count(F.lit(1)).alias("row_count"), F.sum("user_id").alias("user_sum"))
    )


@query("SELECT count(*) + 1 AS lines FROM customer")
def line_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of a text table: one per customer and one with the column names."""
    customers = table(spark, sf_dir, "customer")
    names = spark.range(1).select(F.lit(",".join(customers.columns)).alias("line"))
    lines = customers.select(F.concat_ws(",", *customers.columns).alias("line"))
    path = scratch_path(spark, "lines")
    names.unionByName(lines).write.text(path)
    return files.line_count(spark, path)


@query(
    """
    SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 1000
    """
)
def head_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    path = scratch_path(spark, "sample")
    csv.write_csv(rows.orderBy("o_orderkey").limit(1000), path, single_file=True)
    return csv.typed_scan(spark, path, rows.schema)


@query("SELECT doc_id, text, row_number() OVER (ORDER BY doc_id) + 1 AS line FROM documents ORDER BY doc_id LIMIT 100")
def file_order_head(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 100 records of files written in the order of ids, with their ordinals, from the first file alone."""
    rows = table(spark, sf_dir, "documents").select("doc_id", "text")
    path = scratch_path(spark, "head")
    csv.write_csv(rows.orderBy("doc_id"), path)
    return csv.head_scan(spark, path, rows.schema, 100).select("doc_id", "text", F.col(LINE).alias("line"))


@query("SELECT doc_id, sha256(text) AS sha256 FROM documents")
def content_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", digest(F.col("text")).alias("sha256"))


@query(
    """
    SELECT count(*) AS written, count(*) AS "read", cast(0 AS bigint) AS missing, cast(0 AS bigint) AS unexpected
    FROM documents
    """
)
def copy_digest_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A copy of the documents compared with the original by row digests."""
    documents = table(spark, sf_dir, "documents")
    path = scratch_path(spark, "copy")
    documents.write.parquet(path)
    return checks.copy_check(documents, spark.read.schema(documents.schema).parquet(path))


@query(
    """
    WITH texts AS (
        SELECT event_id,
               CASE event_type WHEN 'click' THEN strftime(ts, '%Y-%m-') || ltrim(strftime(ts, '%d'), '0')
                               WHEN 'view' THEN strftime(ts, '%Y') || '-02-' || strftime(ts, '%d')
                               WHEN 'error' THEN strftime(ts, '%Y/%m/%d')
                               WHEN 'signup' THEN strftime(ts, '%Y-99-%d')
                               ELSE strftime(ts, '%Y-%m-%d') END AS day_text
        FROM events
    )
    SELECT event_id, day_text,
           regexp_full_match(day_text, '[0-9]{4}-[0-9]{2}-[0-9]{2}') AND try_cast(day_text AS date) IS NOT NULL AS valid
    FROM texts
    """
)
def date_validity(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind, day = F.col("event_type"), F.col("ts").cast("date").cast("string")
    year, tail = F.substring(day, 1, 4), F.substring(day, 9, 2)
    text = (
        F.when(kind == "click", F.concat(F.substring(day, 1, 8), F.ltrim(tail, F.lit("0"))))
        .when(kind == "view", F.concat(year, F.lit("-02-"), tail))
        .when(kind == "error", F.replace(day, F.lit("-"), F.lit("/")))
        .when(kind == "signup", F.concat(year, F.lit("-99-"), tail))
        .otherwise(day)
    )
    return table(spark, sf_dir, "events").select("event_id", text.alias("day_text")).withColumn(
        "valid", is_biz_date(F.col("day_text"))
    )


@query(
    """
    WITH raw AS (SELECT cast(ts AS date) AS biz_date, count(*) AS n FROM events GROUP BY 1),
         result AS (SELECT cast(ts AS date) AS biz_date, count(DISTINCT user_id) AS n FROM events
                    WHERE event_type = 'purchase' AND value > 200 GROUP BY 1)
    SELECT raw.biz_date, raw.n AS raw_rows, coalesce(result.n, 0) AS result_rows, result.n IS NOT NULL AS complete
    FROM raw LEFT JOIN result USING (biz_date)
    """
)
def layer_presence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates whose raw rows have a result: users with a large purchase, written as a layer of its own."""
    events = dated_events(spark, sf_dir)
    raw, result = scratch_path(spark, "raw"), scratch_path(spark, "result")
    layers.require_new_layer(raw, result)
    layers.write_slices(events.select("event_id", "biz_date"), raw)
    large = (F.col("event_type") == "purchase") & (F.col("value") > 200)
    users = events.filter(large).select("user_id", "biz_date").distinct()
    layers.write_slices(users, result)
    return checks.layer_presence(
        layers.slice_counts(spark.read.parquet(raw), "raw_rows"),
        layers.slice_counts(spark.read.parquet(result), "result_rows"),
    )
