"""Order rows: the golden pair, faulty rows, strict checks."""

from decimal import Decimal

import pytest

from batchkit.errors import DataError, EmptyResultError, ReconcileError
from batchkit.operators import checks
from batchkit.operators import orders as ops
from batchkit.sources.csv import text_scan

FAULTS = """ order_id , user_id,amount
o1,u1,1.005
,u1,2
o3, ,2
o4,u2,abc
o5,u2,-1
o6,u2,
o7,u3,0
o7,u3,5
o8,u3,NaN
o9,u3,1,9
o10,u3
"""


@pytest.fixture
def tagged(spark, tmp_path):
    (tmp_path / "orders.csv").write_text(FAULTS)
    return ops.tag_rejects(text_scan(spark, str(tmp_path), ops.REQUIRED, flag_extra=True))


def test_reasons(tagged):
    counts = {r["reason"]: r["row_count"] for r in ops.reject_counts(tagged).collect()}
    assert counts == {
        "valid": 3,
        "order_id_empty": 1,
        "user_id_empty": 1,
        "amount_invalid": 4,
        "amount_negative": 1,
        "extra_cells": 1,
    }


def test_rejects_keep_the_record(tagged):
    record = ops.rejects(tagged).filter("order_id = 'o4'").first()
    assert (record["user_id"], record["amount_source"], record["reason"]) == ("u2", "abc", "amount_invalid")


def test_summary_counts_rows_and_keeps_zero(tagged):
    expected = {("u1", 1, Decimal("1.00")), ("u3", 2, Decimal("5.00"))}
    assert {tuple(r) for r in ops.user_summary(tagged).collect()} == expected
    rollup = ops.order_rollup(tagged)
    assert {tuple(r) for r in ops.summary_of(rollup).collect()} == expected
    assert tuple(ops.counts_of(rollup).first()) == (3, 8, 2)


def test_dedup_is_opt_in(spark):
    rows = [("o1", "u1", "5"), ("o1", "u1", "5")]
    tagged = ops.tag_rejects(spark.createDataFrame(rows, "order_id string, user_id string, amount string"))
    assert ops.user_summary(tagged).first()["order_count"] == 2
    assert ops.user_summary(tagged, dedup=True).first()["order_count"] == 1


def test_missing_cells_are_empty(spark):
    df = spark.createDataFrame([(None, "u1", "1")], "order_id string, user_id string, amount string")
    assert ops.tag_rejects(df).first()["reason"] == "order_id_empty"


def test_text_is_sorted_by_code_point(spark):
    rows = [("b", "1"), ("B", "1"), ("é", "1"), ("a", "0.125"), ("中", "2")]
    df = spark.createDataFrame([("o", u, a) for u, a in rows], "order_id string, user_id string, amount string")
    text = ops.summary_text(ops.user_summary(ops.tag_rejects(df))).collect()
    assert [r["user_id"] for r in text] == sorted(u for u, _ in rows)
    assert {r["user_id"]: r["total_amount"] for r in text}["a"] == "0.12"


def summary(spark, *rows):
    return spark.createDataFrame(list(rows), "user_id string, order_count string, total_amount string")


def test_strict_summary(spark):
    df = summary(
        spark, ("u1", "1", "2.00"), ("", "1", "1"), ("u2", "1.5", "1"), ("u3", "-1", "1"), ("u4", "1", "x"), ("u5", "1", "-1")
    )
    assert [r["reason"] for r in checks.summary_violations(df).collect()] == [
        "user_id_empty",
        "order_count_invalid",
        "order_count_negative",
        "total_amount_invalid",
        "total_amount_negative",
    ]
    with pytest.raises(DataError):
        checks.require_clean(checks.summary_violations(df))
    checks.require_clean(checks.summary_violations(summary(spark, ("u1", "1", "2.00"))))


def test_require_rows(spark):
    with pytest.raises(EmptyResultError):
        checks.require_rows(summary(spark), "summary")


def test_readback(spark):
    written = summary(spark, ("u1", "1", "2"), ("u1", "1", "2"), ("u2", None, "3"))
    assert checks.require_readback(written, written) == 3
    lost = summary(spark, ("u1", "1", "2"), ("u2", None, "3"), ("u4", "1", "1"))
    assert tuple(checks.readback_diff(written, lost).first()) == (3, 3, 1, 1)
    assert {(r["user_id"], r["surplus"]) for r in checks.multiset_diff(written, lost).collect()} == {("u1", 1), ("u4", -1)}
    with pytest.raises(ReconcileError):
        checks.require_readback(written, lost)


def test_row_count_check(spark):
    assert tuple(checks.row_count_check(spark.range(8), 8).first()) == (8, 8, True)
    assert tuple(checks.row_count_check(spark.range(7), 8).first()) == (7, 8, False)
