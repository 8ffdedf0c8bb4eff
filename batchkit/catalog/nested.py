"""Nested documents: forecast payloads made from events, array columns, code labels."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from batchkit.catalog.registry import query, table
from batchkit.functions.dates import WEEKDAY_LABELS
from batchkit.functions.text import join_parts
from batchkit.operators import nested as ops

DAYS = 7


def payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One forecast document per event: its value is the temperature, the seven days follow its date."""
    code = F.floor("value").cast("int")
    now = F.struct(
        F.col("value").alias("temperature_2m"),
        (F.col("user_id") / 2).alias("relative_humidity_2m"),
        (F.col("value") - 20).alias("apparent_temperature"),
        code.alias("weather_code"),
        (F.col("value") / 4).cast("decimal(18,1)").cast("double").alias("wind_speed_10m"),
        F.lit(90.0).alias("wind_direction_10m"),
    )
    steps = F.sequence(F.lit(0), F.lit(DAYS - 1))
    day = F.col("ts").cast("date")
    daily = F.struct(
        F.transform(steps, lambda i: F.date_add(day, i).cast("string")).alias("time"),
        F.transform(steps, lambda i: code + i).alias("weather_code"),
        F.transform(steps, lambda i: F.col("value") + i).alias("temperature_2m_max"),
        F.transform(steps, lambda i: i - F.col("value")).alias("temperature_2m_min"),
    )
    return table(spark, sf_dir, "events").select(
        "event_id", F.to_json(F.struct(now.alias("current"), daily.alias("daily"))).alias("body")
    )


CODES = "codes(code, icon, description) AS (VALUES " + ", ".join(str(c) for c in ops.WEATHER_CODES) + ")"
ICON, DESCRIPTION = ops.UNKNOWN_WEATHER


@query(
    f"""
    WITH {CODES}
    SELECT event_id, cast(floor(value) AS integer) AS weather_code, coalesce(icon, '{ICON}') AS icon,
           coalesce(description, '{DESCRIPTION}') AS description
    FROM events LEFT JOIN codes ON code = cast(floor(value) AS integer)
    """
)
def code_lookup_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select("event_id", F.floor("value").cast("int").alias("weather_code"))
    return ops.lookup_code(rows, "weather_code")


@query(
    f"""
    WITH {CODES}
    SELECT event_id, cast(floor(value) AS integer) AS weather_code,
           cast(floor(value + 0.5) AS bigint) AS temperature,
           cast(floor(value - 20 + 0.5) AS bigint) || '°C' AS feels_like,
           regexp_replace(cast(cast(user_id / 2 AS decimal(18,2)) AS varchar), '\\.?0+$', '') || '%' AS humidity,
           regexp_replace(cast(cast(cast(cast(value AS decimal(18,2)) / 4 AS decimal(18,6)) AS decimal(18,1)) AS varchar),
                          '\\.?0+$', '') || ' km/h' AS wind_speed,
           coalesce(icon, '{ICON}') AS icon, coalesce(description, '{DESCRIPTION}') AS description
    FROM events LEFT JOIN codes ON code = cast(floor(value) AS integer)
    """
)
def current_conditions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.current_conditions(ops.parse_payload(payloads(spark, sf_dir), "body"))


@query("SELECT event_id, cast(json_extract_string(props, '$.k') AS bigint) AS k FROM events")
def json_payload_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.parse_payload(table(spark, sf_dir, "events").select("event_id", "props"), "props", "k bigint")


@query(
    """
    SELECT vec_id, cast(unnest(range(len(embedding))) AS integer) AS position, unnest(embedding) AS value
    FROM embeddings
    """
)
def array_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.array_positions(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), "embedding")


_WEEKDAY = "CASE dayofweek(day) " + " ".join(f"WHEN {i} THEN '{w}'" for i, w in enumerate(WEEKDAY_LABELS)) + " END"


@query(
    f"""
    WITH {CODES},
    days AS (
        SELECT event_id, cast(i AS integer) AS position, cast(ts AS date) + cast(i AS integer) AS day,
               cast(floor(value) AS integer) + cast(i AS integer) AS weather_code,
               cast(floor(value + i + 0.5) AS bigint) AS high, cast(floor(i - value + 0.5) AS bigint) AS low
        FROM events, range({DAYS}) AS r(i)
    )
    SELECT days.*, {_WEEKDAY} AS weekday, coalesce(icon, '{ICON}') AS icon,
           coalesce(description, '{DESCRIPTION}') AS description
    FROM days LEFT JOIN codes ON code = weather_code
    """
)
def forecast_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.forecast_rows(ops.parse_payload(payloads(spark, sf_dir), "body"))


@query(
    """
    SELECT c_custkey,
           concat_ws(', ', CASE WHEN c_mktsegment <> 'BUILDING' THEN nullif(n_name, 'NATION_3') END,
                     CASE WHEN r_name <> 'AFRICA' THEN r_name END) AS region
    FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
    """
)
def region_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nation and region of each customer as one label; some parts are blank, some missing."""
    customer, nation, region = (table(spark, sf_dir, name) for name in ("customer", "nation", "region"))
    joined = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).join(
        region, F.col("n_regionkey") == F.col("r_regionkey")
    )
    first = F.when(F.col("c_mktsegment") != "BUILDING", F.when(F.col("n_name") == "NATION_3", "").otherwise(F.col("n_name")))
    second = F.when(F.col("r_name") == "AFRICA", "").otherwise(F.col("r_name"))
    return joined.select("c_custkey", join_parts(first, second).alias("region"))
