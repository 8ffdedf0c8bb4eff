"""Keyed-table queries: one row per user and date, with the latest cells of the user's events."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from batchkit.catalog.registry import query, table
from batchkit.operators import buckets
from batchkit.operators import keyed as ops
from batchkit.session import scratch_path

UPDATE_TIME = "2026-07-18 23:00:00"
CELLS = ("user_id", "event_type", "value", "update_time")


def keyed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as writes to the keyed table. Errors write no value cell."""
    stamped = ops.stamp(table(spark, sf_dir, "events"), F.col("ts"), F.col("user_id"), UPDATE_TIME)
    return stamped.select(
        "row_key",
        F.col("user_id").cast("string").alias("user_id"),
        "event_type",
        F.when(F.col("event_type") != "error", F.col("value").cast("string")).alias("value"),
        "update_time",
        "biz_date",
        "ts",
        "event_id",
    )


def _new_table(spark: SparkSession, rows: DataFrame) -> str:
    name = f"user_events_{uuid.uuid4().hex}"
    ops.ensure_table(spark, name, rows.select("row_key", *CELLS, "biz_date").schema, scratch_path(spark, "keyed"))
    return name


def _filled_table(spark: SparkSession, sf_dir: str) -> str:
    rows = keyed_events(spark, sf_dir)
    name = _new_table(spark, rows)
    latest = ops.latest_per_key(rows, "row_key", CELLS, ["ts", "event_id"], keep=["biz_date"])
    ops.replace_slices(latest, name)
    return name


def keyed_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.table(_filled_table(spark, sf_dir))


WRITES = f"""
writes AS (
    SELECT strftime(ts, '%Y%m%d') || '#' || user_id AS row_key, cast(user_id AS varchar) AS user_id, event_type,
           CASE WHEN event_type <> 'error' THEN cast(value AS varchar) END AS value,
           '{UPDATE_TIME}' AS update_time, cast(ts AS date) AS biz_date, ts, event_id
    FROM events
)"""

TABLE = f"""
{WRITES},
keyed AS (
    SELECT row_key, any_value(user_id) AS user_id, arg_max(event_type, (ts, event_id)) AS event_type,
           arg_max(value, (ts, event_id)) FILTER (value IS NOT NULL) AS value,
           any_value(update_time) AS update_time, biz_date
    FROM writes GROUP BY row_key, biz_date
)"""


@query(
    f"""
    WITH {WRITES}
    SELECT event_id, row_key, biz_date, update_time FROM writes
    """
)
def row_key_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keyed_events(spark, sf_dir).select("event_id", "row_key", "biz_date", "update_time")


@query(
    """
    SELECT user_id, arg_max(event_id, (ts, event_id)) AS event_id, arg_max(event_type, (ts, event_id)) AS event_type
    FROM events GROUP BY user_id
    """
)
def keyed_upsert_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Last write per key within one batch, the key being the user alone."""
    return ops.latest_per_key(table(spark, sf_dir, "events"), "user_id", ["event_id", "event_type"], ["ts", "event_id"])


@query(
    f"""
    WITH {WRITES},
    ordered AS (
        SELECT *, CASE WHEN event_type IN ('error', 'purchase') THEN 1 ELSE 0 END AS batch FROM writes
    )
    SELECT row_key, any_value(user_id) AS user_id, arg_max(event_type, (batch, ts, event_id)) AS event_type,
           arg_max(value, (batch, ts, event_id)) FILTER (value IS NOT NULL) AS value,
           any_value(update_time) AS update_time, biz_date
    FROM ordered GROUP BY row_key, biz_date
    """
)
def keyed_upsert_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two batches that together hold all events; the second is written twice, as by a rerun."""
    rows = keyed_events(spark, sf_dir)
    late = F.coalesce(F.col("event_type").isin("error", "purchase"), F.lit(False))
    name = _new_table(spark, rows)
    for batch in (rows.filter(~late), rows.filter(late), rows.filter(late)):
        ops.upsert(spark, name, batch, ["ts", "event_id"])
    return spark.table(name)


@query(
    f"""
    WITH {TABLE}
    SELECT row_key, 'cf:' || cell AS cell, value
    FROM (SELECT row_key, 'user_id' AS cell, user_id AS value FROM keyed
          UNION ALL SELECT row_key, 'event_type', event_type FROM keyed
          UNION ALL SELECT row_key, 'value', value FROM keyed
          UNION ALL SELECT row_key, 'update_time', update_time FROM keyed
          UNION ALL SELECT row_key, 'biz_date', cast(biz_date AS varchar) FROM keyed) AS cells
    WHERE value IS NOT NULL
    """
)
def keyed_full_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.cells_of(keyed_table(spark, sf_dir))


@query(f"WITH {TABLE} SELECT * FROM keyed WHERE row_key LIKE '20240102#%'")
def keyed_prefix_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.prefix_scan(keyed_table(spark, sf_dir), "20240102#")


@query(f"WITH {TABLE} SELECT * FROM keyed WHERE row_key = '20240102#8'")
def keyed_point_get(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.point_get(keyed_table(spark, sf_dir), "20240102#8")


@query(f"WITH {TABLE} SELECT * FROM keyed ORDER BY row_key LIMIT 10")
def keyed_limit_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.first_rows(spark, _filled_table(spark, sf_dir), 10)


@query(f"WITH {TABLE} SELECT biz_date, count(*) AS row_count, count(value) AS value_count FROM keyed GROUP BY biz_date")
def ensure_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Create twice, write twice: the second time changes nothing."""
    rows = keyed_events(spark, sf_dir)
    name, path = f"user_events_{uuid.uuid4().hex}", scratch_path(spark, "keyed")
    latest = ops.latest_per_key(rows, "row_key", CELLS, ["ts", "event_id"], keep=["biz_date"])
    for _ in range(2):
        ops.ensure_table(spark, name, latest.schema, path)
        ops.replace_slices(latest, name)
    return (
        spark.table(name)
        .groupBy("biz_date")
        .agg(F.count(F.lit(1)).alias("row_count"), F.count("value").alias("value_count"))
    )


USERS = """
writes AS (
    SELECT 'user' || user_id AS row_key, event_type, CASE WHEN event_type <> 'error' THEN cast(value AS varchar) END AS value,
           CASE WHEN event_type IN ('error', 'purchase') THEN 1 ELSE 0 END AS batch, ts, event_id
    FROM events),
stored AS (
    SELECT row_key, arg_max(event_type, (batch, ts, event_id)) AS event_type,
           arg_max(value, (batch, ts, event_id)) FILTER (value IS NOT NULL) AS value
    FROM writes GROUP BY row_key)"""


def _user_table(spark: SparkSession, sf_dir: str) -> str:
    """A table without dates, one row per user, written by two puts; the second is repeated, as by a rerun."""
    rows = table(spark, sf_dir, "events").select(
        F.concat(F.lit("user"), F.col("user_id").cast("string")).alias("row_key"),
        "event_type",
        F.when(F.col("event_type") != "error", F.col("value").cast("string")).alias("value"),
        "ts",
        "event_id",
    )
    late = F.coalesce(F.col("event_type").isin("error", "purchase"), F.lit(False))
    name, schema = f"users_{uuid.uuid4().hex}", rows.select("row_key", "event_type", "value").schema
    buckets.ensure_table(spark, name, schema, scratch_path(spark, "users"), 16)
    for batch in (rows.filter(~late), rows.filter(late), rows.filter(late)):
        buckets.put(spark, name, batch, ["ts", "event_id"])
    return name


@query(f"WITH {USERS} SELECT * FROM stored")
def undated_put_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return buckets.scan(spark, _user_table(spark, sf_dir))


@query(f"WITH {USERS} SELECT * FROM stored WHERE row_key = 'user8'")
def undated_get(spark: SparkSession, sf_dir: str) -> DataFrame:
    return buckets.get(spark, _user_table(spark, sf_dir), "user8")


@query(f"WITH {USERS} SELECT * FROM stored WHERE row_key LIKE 'user1%' ORDER BY row_key LIMIT 5")
def undated_prefix_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return buckets.scan(spark, _user_table(spark, sf_dir), prefix="user1", n=5)
