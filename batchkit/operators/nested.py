"""Nested forecast documents: fields of a payload, one row per array position, code labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from batchkit.functions.dates import weekday_label
from batchkit.functions.numbers import number_text, round_nearest, with_unit

FORECAST_SCHEMA = (
    "current struct<temperature_2m: double, relative_humidity_2m: double, apparent_temperature: double, "
    "weather_code: int, wind_speed_10m: double, wind_direction_10m: double>, "
    "daily struct<time: array<string>, weather_code: array<int>, "
    "temperature_2m_max: array<double>, temperature_2m_min: array<double>>"
)

# Weather codes with their icon and description, and the default for other codes.
WEATHER_CODES = (
    (0, "☀️", "晴"),
    (1, "🌤️", "大部晴朗"),
    (2, "⛅", "多云"),
    (3, "☁️", "阴"),
    (45, "🌫️", "雾"),
    (48, "🌫️", "雾凇"),
    (51, "🌦️", "小毛毛雨"),
    (53, "🌦️", "毛毛雨"),
    (55, "🌧️", "大毛毛雨"),
    (56, "🌧️", "冻毛毛雨"),
    (57, "🌧️", "冻毛毛雨"),
    (61, "🌧️", "小雨"),
    (63, "🌧️", "中雨"),
    (65, "🌧️", "大雨"),
    (66, "🌧️", "冻雨"),
    (67, "🌧️", "冻雨"),
    (71, "🌨️", "小雪"),
    (73, "🌨️", "中雪"),
    (75, "❄️", "大雪"),
    (77, "🌨️", "雪粒"),
    (80, "🌦️", "阵雨"),
    (81, "🌧️", "中阵雨"),
    (82, "⛈️", "大阵雨"),
    (85, "🌨️", "小阵雪"),
    (86, "❄️", "大阵雪"),
    (95, "⛈️", "雷暴"),
    (96, "⛈️", "雷暴+小冰雹"),
    (99, "⛈️", "雷暴+大冰雹"),
)
UNKNOWN_WEATHER = ("🌡️", "未知")


def code_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(WEATHER_CODES, "code int, icon string, description string")


def lookup_code(df: DataFrame, code: str) -> DataFrame:
    """Add the icon and the description of a code; unknown and missing codes get the default.

    The code table is the constant above, so broadcasting it needs no size check.
    """
    icon, description = UNKNOWN_WEATHER
    codes = F.broadcast(code_table(df.sparkSession).withColumnRenamed("code", "_code"))
    return (
        df.join(codes, F.col(code) == F.col("_code"), "left")
        .withColumns(
            {
                "icon": F.coalesce("icon", F.lit(icon)),
                "description": F.coalesce("description", F.lit(description)),
            }
        )
        .drop("_code")
    )


def parse_payload(df: DataFrame, text: str, schema: str = FORECAST_SCHEMA) -> DataFrame:
    """Replace a JSON text column by its top-level fields; text that is no JSON gives NULLs."""
    return df.withColumn("_payload", F.from_json(text, schema)).drop(text).select("*", "_payload.*").drop("_payload")


def current_conditions(parsed: DataFrame) -> DataFrame:
    """Display values of the current weather: rounded temperatures, texts with units, code labels."""
    kept = [c for c in parsed.columns if c not in ("current", "daily")]
    now = parsed.select(
        *kept,
        F.col("current.weather_code").alias("weather_code"),
        round_nearest(F.col("current.temperature_2m")).alias("temperature"),
        with_unit(round_nearest(F.col("current.apparent_temperature")).cast("string"), "°C").alias("feels_like"),
        with_unit(number_text(F.col("current.relative_humidity_2m")), "%").alias("humidity"),
        with_unit(number_text(F.col("current.wind_speed_10m")), " km/h").alias("wind_speed"),
    )
    return lookup_code(now, "weather_code")


def array_positions(df: DataFrame, column: str, alias: str = "value") -> DataFrame:
    """One row per array element with its position, starting at 0."""
    kept = [c for c in df.columns if c != column]
    return df.select(*kept, F.posexplode(column).alias("position", alias))


def _at(array: str, position: Column) -> Column:
    return F.get(F.col(array), position)


def forecast_rows(parsed: DataFrame) -> DataFrame:
    """One row per day of the forecast: weekday label, code labels, rounded high and low.

    The days are the positions of the time array; a shorter parallel array gives missing values.
    """
    kept = [c for c in parsed.columns if c not in ("current", "daily")]
    day = F.col("position")
    days = parsed.select(*kept, "daily", F.posexplode("daily.time").alias("position", "_time")).select(
        *kept,
        "position",
        F.col("_time").try_cast("date").alias("day"),
        _at("daily.weather_code", day).alias("weather_code"),
        round_nearest(_at("daily.temperature_2m_max", day)).alias("high"),
        round_nearest(_at("daily.temperature_2m_min", day)).alias("low"),
    )
    return lookup_code(days.withColumn("weekday", weekday_label(F.col("day"))), "weather_code")
