"""Whole jobs on files."""

import os
import uuid

import pytest

from batchkit.errors import EmptyResultError
from batchkit.operators.retail import STANDARD_NAMES
from batchkit.plans import order_job, retail_job, score_job
from batchkit.sources.versions import current

# The example orders and their summary.
ORDERS = """order_id,user_id,product,amount,order_time
o001,u001,phone,3999.00,2026-07-18 09:10:00
o002,u002,book,59.00,2026-07-18 09:20:00
o003,u001,mouse,129.00,2026-07-18 10:00:00
o004,u003,keyboard,299.00,2026-07-18 10:30:00
o005,u002,pen,10.00,2026-07-18 11:00:00
o006,u001,cable,39.00,2026-07-18 11:30:00
"""
SUMMARY = "user_id,order_count,total_amount\nu001,3,4167.00\nu002,2,69.00\nu003,1,299.00\n"


def put(path, content):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as file:
        file.write(content)


def joined(path):
    parts = sorted(n for n in os.listdir(path) if n.endswith(".csv"))
    return "".join(open(f"{path}/{n}", encoding="utf-8").read() for n in parts)


def run(spark, base, table, date="2026-07-18", time="2026-07-18 23:00:00"):
    return order_job.run_daily(spark, str(base), date, time, table, f"{base}/stats", single_file=True)


def test_daily_orders(spark, tmp_path):
    table = f"stat_{uuid.uuid4().hex}"
    put(f"{tmp_path}/raw/20260718/orders.csv", ORDERS)
    result = run(spark, tmp_path, table)
    assert (result.valid_rows, result.skipped_rows, result.users) == (6, 0, 3)
    assert joined(result.summary_path) == SUMMARY

    run(spark, tmp_path, table, time="2026-07-18 23:30:00")
    rows = spark.table(table).orderBy("row_key").collect()
    assert [(r["row_key"], r["order_count"], r["total_amount"], r["update_time"]) for r in rows] == [
        ("20260718#u001", "3", "4167.00", "2026-07-18 23:30:00"),
        ("20260718#u002", "2", "69.00", "2026-07-18 23:30:00"),
        ("20260718#u003", "1", "299.00", "2026-07-18 23:30:00"),
    ]

    put(f"{tmp_path}/raw/20260719/orders.csv", "order_id,user_id,amount\no1,u001,5\no2,,5\n")
    result = run(spark, tmp_path, table, "2026-07-19")
    assert (result.valid_rows, result.skipped_rows, result.users) == (1, 1, 1)
    header, reject = joined(result.rejects_path).splitlines()
    assert header == "order_id,user_id,amount_source,reason,_file"
    assert reject.startswith("o2,,5,user_id_empty,") and reject.endswith("/raw/20260719/orders.csv")
    assert spark.table(table).count() == 4


def test_daily_orders_without_a_valid_row(spark, tmp_path):
    put(f"{tmp_path}/raw/20260718/orders.csv", "order_id,user_id,amount\n,u1,5\n")
    with pytest.raises(EmptyResultError):
        run(spark, tmp_path, f"stat_{uuid.uuid4().hex}")
    assert not os.path.exists(f"{tmp_path}/result")


def test_scores(spark, tmp_path):
    lines = ["学号,姓名,科目,分数,班级", "s1,张三,math,80,1", "s1,张三,math,90,1", "s1,张三,art,75,1", "s2,李四,math,101,2", "s2,李四,art,95,2"]
    put(f"{tmp_path}/in/scores.csv", "\n".join(lines) + "\n")
    result = score_job.run_scores(spark, f"{tmp_path}/in", f"{tmp_path}/out", strict=True, single_file=True)
    assert result == score_job.ScoreResult(2, "88.8")
    assert result.path == current(spark, f"{tmp_path}/out") and joined(result.path) == "学号,姓名,班级,平均分,总分,最高分,科目数\ns1,张三,1,82.5,165,90,2\ns2,李四,2,95.0,95,95,1\n"


def test_retail(spark, tmp_path):
    source = ",".join([*STANDARD_NAMES, "Note"]) + "\n"
    source += "C1,a,lamp,-1,2011-01-01 08:00:00,2.50,k1,UK,x\n"
    source += "2,b,\"cup, red\",3,2011-01-02 08:00:00,1.25,,FR,x\n" * 3
    put(f"{tmp_path}/source/retail.csv", source)
    raw, typed_path = f"{tmp_path}/raw", f"{tmp_path}/typed"
    retail_job.prepare_raw(spark, f"{tmp_path}/source", raw, f"{tmp_path}/sample")
    assert joined(raw).splitlines()[0] == ",".join(STANDARD_NAMES.values())
    assert len(joined(f"{tmp_path}/sample").splitlines()) == 5
    typed = retail_job.land_typed(spark, raw, typed_path)
    report = {(r["section"], r["metric"]): r["value"] for r in retail_job.profile(typed).collect()}
    assert report["duplicates", "count"] == "2" and report["null_count", "customer_id"] == "3"
    retail_job.write_clean(typed, typed_path, f"{tmp_path}/clean", f"{tmp_path}/quarantine")
    cleaned = {r["invoice_no"]: r for r in spark.read.parquet(f"{tmp_path}/clean").collect()}
    assert len(cleaned) == 2 and cleaned["C1"]["is_cancelled"] and not cleaned["2"]["customer_usable"]
    quarantine = spark.read.parquet(f"{tmp_path}/quarantine").collect()
    assert [(r["invoice_no"], r["extra_copies"]) for r in quarantine] == [("2", 2)]
