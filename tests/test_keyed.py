"""The keyed table: last write per cell, reruns, scans."""

import uuid

import pytest

from batchkit.errors import DataError, ReconcileError
from batchkit.operators import keyed as ops

SCHEMA = "row_key string, user_id string, order_count string, total_amount string, update_time string, biz_date date"


@pytest.fixture
def name(spark, tmp_path):
    table = f"stats_{uuid.uuid4().hex}"
    ops.ensure_table(spark, table, batch(spark).schema, str(tmp_path / "stats"))
    return table


def batch(spark, *rows):
    df = spark.createDataFrame(list(rows), SCHEMA.replace("biz_date date", "d string"))
    return df.selectExpr("*", "cast(d as date) as biz_date").drop("d")


def content(spark, table):
    return {r["row_key"]: (r["order_count"], r["total_amount"]) for r in spark.table(table).collect()}


def test_last_write_wins_per_cell(spark, name):
    ops.upsert(spark, name, batch(spark, ("20260718#u1", "u1", "3", "9.00", "t1", "2026-07-18")), ["update_time"])
    ops.upsert(spark, name, batch(spark, ("20260718#u1", "u1", "4", None, "t0", "2026-07-18")), ["update_time"])
    assert content(spark, name) == {"20260718#u1": ("4", "9.00")}


def test_order_inside_a_batch(spark, name):
    rows = [("20260718#u1", "u1", n, None, t, "2026-07-18") for n, t in (("2", "t2"), ("3", "t3"), ("1", "t1"), (None, "t9"))]
    ops.upsert(spark, name, batch(spark, *rows), ["update_time"], ["2026-07-18"])
    assert content(spark, name) == {"20260718#u1": ("3", None)}


def test_other_dates_stay(spark, name):
    first = batch(spark, ("20260718#u1", "u1", "1", "1", "t", "2026-07-18"), ("20260719#u1", "u1", "2", "2", "t", "2026-07-19"))
    ops.upsert(spark, name, first, ["update_time"])
    for _ in range(2):
        ops.upsert(spark, name, batch(spark, ("20260719#u2", "u2", "5", "5", "t", "2026-07-19")), ["update_time"], ["2026-07-19"])
    assert content(spark, name) == {"20260718#u1": ("1", "1"), "20260719#u1": ("2", "2"), "20260719#u2": ("5", "5")}
    ops.require_slice(spark, name, "2026-07-19", 2)
    with pytest.raises(ReconcileError):
        ops.require_slice(spark, name, "2026-07-19", 3)


def test_rows_of_other_dates_are_refused(spark, name):
    rows = batch(spark, ("20260718#u1", "u1", "1", "1", "t", "2026-07-18"), ("20260719#u1", "u1", "1", "1", "t", "2026-07-19"))
    with pytest.raises(DataError):
        ops.upsert(spark, name, rows, ["update_time"], ["2026-07-18"])
    assert content(spark, name) == {}


def test_a_known_path_becomes_a_table_again(spark, name, tmp_path):
    ops.upsert(spark, name, batch(spark, ("20260718#u1", "u1", "1", "1", "t", "2026-07-18")), ["update_time"])
    again = f"stats_{uuid.uuid4().hex}"
    for _ in range(2):
        ops.ensure_table(spark, again, batch(spark).schema, str(tmp_path / "stats"))
    assert content(spark, again) == {"20260718#u1": ("1", "1")}


def test_scans(spark, name):
    rows = [(f"202607{d}#u{u}", f"u{u}", "1", None, "t", f"2026-07-{d}") for d in (18, 19) for u in range(8)]
    ops.upsert(spark, name, batch(spark, *rows), ["update_time"])
    table = spark.table(name)
    assert ops.prefix_scan(table, "20260718#").count() == 8
    assert ops.prefix_scan(table, "202607").count() == 16
    assert ops.point_get(table, "20260719#u3").first()["user_id"] == "u3"
    assert ops.point_get(table, "20260720#u3").isEmpty()
    assert [r["row_key"] for r in ops.limit_scan(table, 3).collect()] == ["20260718#u0", "20260718#u1", "20260718#u2"]
    cells = {r["cell"]: r["value"] for r in ops.cells_of(ops.point_get(table, "20260719#u3"), "cf").collect()}
    assert cells == {
        "cf:user_id": "u3",
        "cf:order_count": "1",
        "cf:update_time": "t",
        "cf:biz_date": "2026-07-19",
    }


def test_cells_decode_bytes(spark):
    df = spark.sql("select 'row1' as row_key, cast('张三' as binary) as name, cast('杭州' as binary) as city")
    assert {tuple(r) for r in ops.cells_of(df, "info").collect()} == {("row1", "info:name", "张三"), ("row1", "info:city", "杭州")}


def test_bad_date_is_refused(spark):
    with pytest.raises(DataError):
        ops.user_stat_rows(spark.createDataFrame([("u", 1, 1.0)], "user_id string, order_count long, total_amount double"), "2026-02-30", "t")
