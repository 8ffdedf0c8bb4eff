"""Forecast payloads."""

import json

from batchkit.operators import nested as ops


def parsed(spark, *payloads):
    df = spark.createDataFrame([(i, p) for i, p in enumerate(payloads)], "i int, body string")
    return ops.parse_payload(df, "body")


PAYLOAD = json.dumps(
    {
        "current": {"temperature_2m": -2.5, "apparent_temperature": 30.5, "relative_humidity_2m": 61,
                    "weather_code": 45, "wind_speed_10m": 12.5, "wind_direction_10m": 10},
        "daily": {"time": ["2026-07-18", "2026-07-19"], "weather_code": [0, 4],
                  "temperature_2m_max": [30.5, 29.4], "temperature_2m_min": [-2.5]},
    }
)


def test_current(spark):
    row = ops.current_conditions(parsed(spark, PAYLOAD)).first()
    assert (row["temperature"], row["feels_like"], row["humidity"], row["wind_speed"]) == (-2, "31°C", "61%", "12.5 km/h")
    assert (row["icon"], row["description"]) == ("🌫️", "雾")


def test_forecast(spark):
    rows = ops.forecast_rows(parsed(spark, PAYLOAD)).orderBy("position").collect()
    assert [(r["weekday"], r["description"], r["high"], r["low"]) for r in rows] == [
        ("周六", "晴", 31, -2),
        ("周日", "未知", 29, None),
    ]


def test_broken_payload(spark):
    assert ops.forecast_rows(parsed(spark, "no json", None)).isEmpty()
    row = ops.current_conditions(parsed(spark, "no json")).first()
    assert row["temperature"] is None and row["description"] == "未知"


def test_code_table_is_complete():
    assert len(ops.WEATHER_CODES) == 28 and len({c for c, _, _ in ops.WEATHER_CODES}) == 28
