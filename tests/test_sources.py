"""CSV scans on irregular files, sinks, layers, files."""

import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from batchkit.errors import DataError, SchemaError
from batchkit.operators.checks import copy_check, manifest_diff, require_columns
from batchkit.operators.scores import SCORE_SCHEMA
from batchkit.sources import csv, files, layers

SCHEMA = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("name", T.StringType())])


def write(tmp_path, content, name="data.csv"):
    (tmp_path / name).write_text(content, encoding="utf-8")
    return str(tmp_path)


def test_typed_scan_is_lenient(spark, tmp_path):
    path = write(tmp_path, "x,y\n1,a\nbad,b\n3\n4,d,extra\n")
    rows = csv.typed_scan(spark, path, SCHEMA).collect()
    assert [tuple(r) for r in rows] == [(1, "a"), (None, "b"), (3, None), (4, "d")]


def test_typed_scan_strict_checks_the_header(spark, tmp_path):
    path = write(tmp_path, "x,y\n1,a\n")
    with pytest.raises(Exception, match="(?i)header"):
        csv.typed_scan(spark, path, SCHEMA, strict=True).collect()


def test_typed_scan_keeps_corrupt_records(spark, tmp_path):
    path = write(tmp_path, "id,name\n1,a\nbad,b\n")
    df = csv.typed_scan(spark, path, SCHEMA, corrupt_column="_corrupt")
    assert [r["_corrupt"] for r in df.select("id", "_corrupt").collect()] == [None, "bad,b"]


def test_score_cells(spark, tmp_path):
    lines = ["s1,n,m,85,c", "s2,n,m,85.5,c", "s3,n,m,,c", "s4,n,m,abc,c", "s5,n,m, 70,c", "s6,n,m", "s7,n,m,60,c,x"]
    path = write(tmp_path, "学号,姓名,科目,分数,班级\n" + "\n".join(lines) + "\n")
    scores = {r["学号"]: r["分数"] for r in csv.typed_scan(spark, path, SCORE_SCHEMA).collect()}
    assert scores == {"s1": 85, "s2": None, "s3": None, "s4": None, "s5": None, "s6": None, "s7": 60}


def test_inferred_scan(spark, tmp_path):
    path = write(tmp_path, "id,day,name\n1,2026-01-01,a\n2,2026-01-02,b\n")
    assert csv.inferred_scan(spark, path).dtypes == [("id", "int"), ("day", "date"), ("name", "string")]


def test_text_scan_trims_and_fills(spark, tmp_path):
    path = write(tmp_path, ' order_id , user_id,amount\no1,\t u1 ,5\n,u2\n"o,3",u3,"a ""q"""\n\n')
    rows = csv.text_scan(spark, path, ("order_id", "amount")).collect()
    assert [tuple(r) for r in rows] == [("o1", "u1", "5"), ("", "u2", ""), ("o,3", "u3", 'a "q"')]


def test_text_scan_flags_extra_cells(spark, tmp_path):
    path = write(tmp_path, 'a,b\n1,2\n1\n1,2,3\n1,,\n"x,y",2\n"x,y",2,"p,q"\n"x ""z"", y",2\n')
    df = csv.text_scan(spark, path, flag_extra=True)
    assert [r[csv.EXTRA_CELLS] for r in df.collect()] == [False, False, True, True, False, True, False]
    assert [r[csv.EXTRA_CELLS] for r in df.select("a", csv.EXTRA_CELLS).collect()].count(True) == 3


def test_text_scan_requires_columns(spark, tmp_path):
    with pytest.raises(SchemaError, match="amount"):
        csv.text_scan(spark, write(tmp_path, "order_id,user_id\no1,u1\n"), ("order_id", "amount"))


def test_require_columns_reports_extras():
    assert require_columns(["a", "b", "c"], ["a", "b"]) == ["c"]


def test_na_scan_keeps_identifiers(spark, tmp_path):
    path = write(tmp_path, "country,invoice_no\nNA,00123\n,C45\nUK,null\n")
    rows = csv.na_scan(spark, path, ("invoice_no", "country")).collect()
    assert [tuple(r) for r in rows] == [("00123", None), ("C45", None), (None, "UK")]


def test_csv_round_trip_of_hard_text(spark, tmp_path):
    values = [(1, 'say "hi", ok'), (2, " padded "), (3, "back\\slash"), (4, "a,b"), (5, None)]
    df = spark.createDataFrame(values, "id int, name string")
    csv.write_csv(df, str(tmp_path / "out"))
    back = csv.typed_scan(spark, str(tmp_path / "out"), df.schema, strict=True)
    assert sorted(tuple(r) for r in back.collect()) == values


def test_cells_with_line_breaks(spark, tmp_path):
    path = write(tmp_path, 'id,name\n1,"two\nlines"\n2,b\n')
    assert [tuple(r) for r in csv.text_scan(spark, path, multiline=True).collect()] == [("1", "two\nlines"), ("2", "b")]
    assert csv.na_scan(spark, path, ("name",), multiline=True).first()["name"] == "two\nlines"
    assert csv.typed_scan(spark, path, SCHEMA, multiline=True).count() == 2


def test_empty_csv_has_a_header(spark, tmp_path):
    path = str(tmp_path / "out")
    csv.write_csv(spark.createDataFrame([], "id int, name string"), path, single_file=True)
    parts = [n for n in os.listdir(path) if n.endswith(".csv")]
    assert [open(f"{path}/{n}").read() for n in parts] == ["id,name\n"]
    assert os.path.exists(f"{path}/_SUCCESS")


def dated(spark, rows):
    return spark.createDataFrame(rows, "v int, d string").select("v", F.col("d").cast("date").alias("biz_date"))


def test_slices_replace_only_their_dates(spark, tmp_path):
    path = str(tmp_path / "layer")
    layers.write_slices(dated(spark, [(1, "2026-01-01"), (2, "2026-01-02"), (3, "2026-01-02")]), path)
    for _ in range(2):
        layers.write_slices(dated(spark, [(9, "2026-01-02")]), path, ("v",))
    rows = layers.read_layer(spark, path).orderBy("v").collect()
    assert [(r["v"], str(r["biz_date"])) for r in rows] == [(1, "2026-01-01"), (9, "2026-01-02")]
    assert [r["v"] for r in layers.read_slice(spark, path, "2026-01-01").collect()] == [1]


def test_layers_never_overwrite_their_input():
    for source, target in (("/a/raw", "/a/raw"), ("/a/raw", "/a/raw/x"), ("/a/raw/x", "/a/raw/")):
        with pytest.raises(DataError):
            layers.require_new_layer(source, target)
    layers.require_new_layer("/a/raw", "/a/raw2")


def test_files(spark, tmp_path):
    for side in ("one", "two"):
        os.makedirs(tmp_path / side / "sub")
        (tmp_path / side / "a.txt").write_text("x\ny\n")
        (tmp_path / side / "sub" / "a.txt").write_text("same" if side == "one" else "diff")
    (tmp_path / "two" / "more.txt").write_text("more")
    one, two = (files.file_digests(spark, str(tmp_path / side)) for side in ("one", "two"))
    assert manifest_diff(one, one).isEmpty()
    assert sorted(r["name"] for r in manifest_diff(one, two).collect()) == ["more.txt", "sub/a.txt"]
    assert {r["name"]: r["size_bytes"] for r in files.file_manifest(spark, str(tmp_path / "one")).collect()} == {
        "a.txt": 4,
        "sub/a.txt": 4,
    }
    assert files.line_count(spark, str(tmp_path / "one" / "a.txt")).first()["lines"] == 2


def test_copy_check(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x"), (2, None)], "i int, t string")
    b = spark.createDataFrame([(1, "x"), (2, None), (3, "z")], "i int, t string")
    assert tuple(copy_check(a, a).first()) == (3, 3, 0, 0)
    assert tuple(copy_check(a, b).first()) == (3, 3, 1, 1)
