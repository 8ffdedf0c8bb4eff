"""Rows and reruns that went wrong once."""

import os

import pytest
from pyspark.sql import functions as F

from batchkit.errors import DataError, EmptyResultError, SchemaError
from batchkit.functions.numbers import number_text, with_unit
from batchkit.operators import checks, keyed, retail
from batchkit.plans.order_job import run_daily
from batchkit.plans.retail_job import prepare_raw
from batchkit.plans.score_job import run_scores
from batchkit.sources.csv import text_scan, typed_scan
from batchkit.sources.versions import current


def put(path, text):
    os.makedirs(path, exist_ok=True)
    with open(f"{path}/part.csv", "w", newline="") as file:
        file.write(text)
    return str(path)


def test_long_quoted_cells_with_extra_and_missing_cells(spark, tmp_path):
    long = 'x,""y""' * 15_000
    path = put(tmp_path / "in", f'a,b\n1,"{long}",3\n"{long}"\n1,2\n')
    flags = sorted(r._extra_cells for r in text_scan(spark, path, flag_extra=True).collect())
    assert flags == [False, False, True]


def orders(tmp_path, day, users):
    rows = "".join(f"o{i},{u},1.50\n" for i, u in enumerate(users))
    put(tmp_path / "raw" / day.replace("-", ""), f"order_id,user_id,amount\n{rows}")


def test_rerun_of_a_date_replaces_its_slice(spark, tmp_path):
    table, path = f"rerun_{os.getpid()}", str(tmp_path / "table")
    for day, users in (("2026-07-17", ["u9"]), ("2026-07-18", ["u1", "u2", "u3"]), ("2026-07-18", ["u1", "u3"])):
        orders(tmp_path, day, users)
        run_daily(spark, str(tmp_path), day, "t", table, path)
    keys = sorted(r.row_key for r in spark.table(table).collect())
    spark.sql(f"DROP TABLE {table}")
    assert keys == ["20260717#u9", "20260718#u1", "20260718#u3"]


def test_cells_with_line_breaks_need_multiline(spark, tmp_path):
    put(tmp_path / "raw" / "20260718", 'order_id,user_id,product,amount\no1,u1,"a\nb",5.00\no2,u2,c,1.00\n')
    table, path = f"broken_{os.getpid()}", str(tmp_path / "table")
    with pytest.raises(DataError):
        run_daily(spark, str(tmp_path), "2026-07-18", "t", table, path)
    result = run_daily(spark, str(tmp_path), "2026-07-18", "t", table, path, multiline=True)
    spark.sql(f"DROP TABLE {table}")
    assert (result.valid_rows, result.skipped_rows) == (2, 0)


def test_an_empty_result_leaves_the_old_one(spark, tmp_path):
    good = put(tmp_path / "good", "name,score\nann,90\n")
    from batchkit.operators.scores import SCORE_SCHEMA

    names = [f.name for f in SCORE_SCHEMA.fields]
    kinds = {f.name: f.dataType.simpleString() for f in SCORE_SCHEMA.fields}
    row = ",".join("90" if kinds[n] != "string" else "ann" for n in names)
    good = put(tmp_path / "good", ",".join(names) + "\n" + row + "\n")
    empty = put(tmp_path / "empty", ",".join(names) + "\n")
    target = str(tmp_path / "out")
    run_scores(spark, good, target)
    before = text_scan(spark, current(spark, target)).collect()
    with pytest.raises(EmptyResultError):
        run_scores(spark, empty, target)
    assert text_scan(spark, current(spark, target)).collect() == before


def test_copy_check_sees_a_microsecond(spark):
    a = spark.sql("SELECT timestamp_ntz'2024-01-01 00:00:00.123456' AS t, timestamp'2024-01-01 00:00:00.123456' AS z")
    for column in ("t", "z"):
        b = a.withColumn(column, F.col(column) + F.expr("INTERVAL '0.000001' SECOND"))
        assert checks.copy_check(a, b).first()["missing"] == 1
    assert checks.copy_check(a, a).first()["missing"] == 0


def test_raw_layer_keeps_padding_and_names_extra_columns(spark, tmp_path):
    names = list(retail.STANDARD_NAMES)
    source = put(tmp_path / "src", ",".join([*names, "more"]) + "\n" + ",".join(["  lamp "] * len(names) + ["x"]) + "\n")
    raw = str(tmp_path / "raw")
    assert prepare_raw(spark, source, raw) == ["more"]
    schema = spark.read.option("header", True).csv(raw).schema
    assert set(typed_scan(spark, raw, schema).first()) == {"  lamp "}


def test_missing_numbers_get_no_unit(spark):
    row = spark.sql("SELECT cast(NULL AS double) AS x, 12.50D AS y").select(
        with_unit(number_text(F.col("x")), "%").alias("x"), with_unit(number_text(F.col("y")), "%").alias("y")
    )
    assert tuple(row.first()) == (None, "12.5%")


def test_undated_keys_and_upsert_of_one_date(spark, tmp_path):
    name = f"undated_{os.getpid()}"
    rows = spark.createDataFrame([("row1", "a", None), ("20240102#u", "b", "2024-01-02"), ("20240203#u", "c", "2024-02-03")], "row_key string, v string, d string")
    rows = rows.select("row_key", "v", F.col("d").cast("date").alias("biz_date"))
    keyed.ensure_table(spark, name, rows.schema, str(tmp_path / "t"))
    with pytest.raises(SchemaError):
        keyed.ensure_table(spark, name, rows.withColumnRenamed("v", "w").schema, str(tmp_path / "t"))
    keyed.replace_slices(rows, name)
    assert keyed.point_get(spark.table(name), "row1").first().v == "a"
    assert [r.v for r in keyed.prefix_scan(spark.table(name), "202402").collect()] == ["c"]
    other = tmp_path / "t" / "biz_date=2024-02-03"
    before = sorted(os.listdir(other))
    keyed.upsert(spark, name, rows.filter("v = 'b'").withColumn("v", F.lit("n")), ["v"])
    assert sorted(os.listdir(other)) == before
    assert keyed.point_get(spark.table(name), "20240102#u").first().v == "n"
    spark.sql(f"DROP TABLE {name}")


def test_customer_amounts_are_exact_and_unusable_lines_counted(spark):
    typed = spark.sql(
        "SELECT 'c' AS customer_id, 'i' AS invoice_no, 'd' AS description, q AS quantity, p AS unit_price FROM VALUES "
        "(1e6D, 0.123456D), (1D, 1e15D), (double('inf'), 1D) AS t(q, p)"
    )
    row = retail.customer_summary(retail.clean(typed)).first()
    assert (str(row.total_amount), row.line_count, row.unusable_lines) == ("1000000000123456.00", 3, 1)
