"""Records with line breaks over many splits of a file, against Python's serial reader and Spark's."""

import csv as serial
import os
import random
import uuid

import pytest
from pyspark.sql import functions as F

from batchkit.errors import DataError
from batchkit.functions.quotes import cell_count, ends_inside, inside_after
from batchkit.operators import orders
from batchkit.plans.order_job import run_daily
from batchkit.sources import csv, records


@pytest.fixture
def small_splits(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300b")
    spark.conf.set("spark.sql.files.openCostInBytes", "50b")
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


def cell(pick):
    kind = pick.random()
    if kind < 0.15:
        return pick.choice(["", '5" pipe', 'a "b" c', "NA", "é日", " x "])
    text = "".join(pick.choices('ab,"\n é', k=pick.randint(0, 30 if kind < 0.9 else 900)))
    if '"' in text or "," in text or "\n" in text or kind < 0.4:
        return '"' + text.replace('"', '""') + '"'
    return text


def put(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w", newline="", encoding="utf-8") as file:
        file.write(text)


def made(folder, seed, eol="\n"):
    pick = random.Random(seed)
    for k in range(3):
        lines = ["id,name,note"]
        for n in range(pick.choice([0, 5, 120])):
            lines.append(",".join([str(n), cell(pick), cell(pick)]))
            if pick.random() < 0.1:
                lines.append("")
        put(folder, f"{k}.csv", eol.join(lines) + pick.choice(["", eol]))


def serial_rows(folder):
    out = []
    for name in sorted(os.listdir(folder)):
        with open(f"{folder}/{name}", newline="", encoding="utf-8") as file:
            rows = [r for r in serial.reader(file) if r]
        out += [(name, n, *row) for n, row in enumerate(rows[1:], 2)]
    return out


def cells(row):
    return tuple(value or "" for value in row)


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("eol, broadcast_splits", [("\n", records.BROADCAST_SPLITS), ("\r\n", 0)])
def test_against_the_serial_reader(spark, tmp_path, small_splits, monkeypatch, seed, eol, broadcast_splits):
    folder = str(tmp_path / "in")
    made(folder, seed, eol)
    monkeypatch.setattr(records.record_scan, "__defaults__", (",", records.MAX_RECORD_BYTES, broadcast_splits))
    rows = csv.text_scan(spark, folder, name_file=True, name_line=True, multiline=True)
    got = [(os.path.basename(r._file), r._line, r.id, r.name, r.note) for r in rows.collect()]
    want = [(f, n, *(c.strip() for c in row)) for f, n, *row in serial_rows(folder)]
    assert sorted(got) == sorted(want)


@pytest.mark.parametrize("seed", range(2))
def test_the_same_rows_as_the_reader_of_whole_files(spark, tmp_path, small_splits, seed):
    folder = str(tmp_path / "in")
    made(folder, seed)
    whole = spark.read.option("header", True).option("escape", '"').option("multiLine", True).csv(folder)
    got, extra = csv.untouched_scan(spark, folder, ("id", "name", "note"), multiline=True)
    assert extra == [] and sorted(map(cells, got.collect())) == sorted(map(cells, whole.collect()))


def test_many_tasks_read_one_file(spark, tmp_path, small_splits):
    put(str(tmp_path / "in"), "a.csv", "id,note\n" + "".join(f'{n},"two\nlines {n}"\n' for n in range(500)))
    lines = records.text_lines(spark, str(tmp_path / "in"))
    assert lines.rdd.getNumPartitions() > 8
    assert records.record_scan(spark, str(tmp_path / "in")).count() == 501


def test_the_state_of_a_split_follows_from_all_before_it(spark, tmp_path, small_splits):
    """One cell over many splits, and a quote that is never closed."""
    long = "\n".join(f'line {n}, with ""quotes""' for n in range(200))
    put(str(tmp_path / "in"), "a.csv", f'id,note\n1,"{long}"\n2,"x"\n3,"left open\n4,y\n')
    got = {r.id: r.note for r in csv.text_scan(spark, str(tmp_path / "in"), multiline=True).collect()}
    assert got == {"1": long.replace('""', '"'), "2": "x", "3": "left open\n4,y"}
    with pytest.raises(Exception, match="more than 100 bytes"):
        records.record_scan(spark, str(tmp_path / "in"), max_record_bytes=100).collect()


def test_other_headers_and_empty_files(spark, tmp_path):
    put(str(tmp_path / "in"), "a.csv", "id,note\n1,x\n")
    put(str(tmp_path / "in"), "b.csv", "id,other\n2,y\n")
    with pytest.raises(Exception, match="another header"):
        csv.text_scan(spark, str(tmp_path / "in"), multiline=True).collect()
    put(str(tmp_path / "only"), "a.csv", "id,note\n")
    assert csv.text_scan(spark, str(tmp_path / "only"), multiline=True).count() == 0
    with pytest.raises(DataError):
        csv.text_scan(spark, str(tmp_path / "only"), name_line=True)


def test_quotes_within_cells(spark):
    pick = random.Random(7)
    texts = ["".join(pick.choices('a,""x', k=pick.randint(0, 12))) for _ in range(500)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    judged = df.select("t", ends_inside(F.col("t")).alias("inside"), cell_count(F.col("t")).alias("cells"))
    got = {r.t: (r.inside, r.cells) for r in judged.collect()}
    for text in texts:
        assert got[text][0] == inside_after(text.encode(), False), text
        assert got[text][1] == max(1, len(next(serial.reader([text])))), text


def test_a_row_with_an_inch_mark_passes_a_daily_run(spark, tmp_path):
    table = f"inch_{uuid.uuid4().hex}"
    put(str(tmp_path / "raw/20260718"), "a.csv", 'order_id,user_id,product,amount\no1,u1,5" pipe,3.00\no2,u1,6" nut,-1\n')
    result = run_daily(spark, str(tmp_path), "2026-07-18", "t", table, str(tmp_path / "table"))
    spark.sql(f"DROP TABLE {table}")
    assert (result.valid_rows, result.skipped_rows) == (1, 1)


def test_rejects_carry_the_ordinals_of_a_serial_reader(spark, tmp_path, small_splits):
    pick = random.Random(3)
    rows = [f'o{n},{pick.choice(["u1", "", "u2"])},"p\n{n}",{pick.choice(["1.5", "x", "-2", ""])}' for n in range(300)]
    put(str(tmp_path / "in"), "a.csv", "order_id,user_id,product,amount\n" + "\n".join(r + pick.choice(["", "\n"]) for r in rows))
    tagged = orders.tag_rejects(csv.text_scan(spark, str(tmp_path / "in"), orders.REQUIRED, multiline=True, name_line=True))
    got = sorted((r._line, r.reason) for r in orders.rejects(tagged).collect())
    want = []
    with open(tmp_path / "in/a.csv", newline="") as file:
        for n, row in enumerate(serial.DictReader(file), 2):
            if not row["user_id"]:
                want.append((n, orders.NO_USER))
            elif row["amount"] in ("x", ""):
                want.append((n, orders.BAD_AMOUNT))
            elif row["amount"] == "-2":
                want.append((n, orders.NEGATIVE))
    assert got == want and want


def test_first_rows_in_the_order_of_files(spark, tmp_path, small_splits):
    folder = str(tmp_path / "in dir")
    for k in range(6):
        put(folder, f"{k}.csv", "id,note\n" + "".join(f'{k}-{n},"a\n{n}"\n' for n in range(100)))
    rows = csv.head_scan(spark, folder, spark.createDataFrame([], "id string, note string").schema, 150)
    got = sorted((os.path.basename(r._file), r._line, r.id) for r in rows.collect())
    assert got == [(f"{k}.csv", n + 2, f"{k}-{n}") for k in range(2) for n in range(100)][:150]
    assert csv.head_scan(spark, folder, rows.select("id", "note").schema, 0).count() == 0
