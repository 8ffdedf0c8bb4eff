"""Results replaced as a whole, tables without dates, scans that stop early."""

import os
import uuid

import pytest
from pyspark.sql import functions as F

from batchkit.errors import DataError, MissingResultError, SchemaError
from batchkit.operators import buckets, keyed
from batchkit.plans import order_job, score_job
from batchkit.sources import versions


def put(folder, text):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/part.csv", "w") as file:
        file.write(text)


def shown(folder):
    return sorted(line for n in os.listdir(folder) if n.endswith(".csv") for line in open(f"{folder}/{n}"))


STEPS = ["land", "totals_text", "write_csv", "summary_violations", "require_readback", "commit"]


@pytest.mark.parametrize("step", STEPS)
def test_a_daily_run_that_stops_leaves_the_old_result(spark, tmp_path, monkeypatch, step):
    base, table = str(tmp_path), f"steps_{uuid.uuid4().hex}"
    run = lambda: order_job.run_daily(spark, base, "2026-07-18", "t", table, f"{base}/table")
    put(f"{base}/raw/20260718", "order_id,user_id,amount\no1,u1,5\n")
    run()
    result = f"{base}/result/20260718"
    before = versions.current(spark, result), shown(f"{versions.current(spark, result)}/user_summary")
    put(f"{base}/raw/20260718", "order_id,user_id,amount\no1,u1,6\no2,u2,7\n")

    def stop(*args, **kwargs):
        raise RuntimeError("stopped")

    with monkeypatch.context() as patch:
        patch.setattr(order_job, step, stop)
        with pytest.raises(RuntimeError):
            run()
    assert (versions.current(spark, result), shown(f"{versions.current(spark, result)}/user_summary")) == before
    again = run()
    assert shown(again.summary_path) == ["u1,1,6.00\n", "u2,1,7.00\n", "user_id,order_count,total_amount\n"]
    assert again.summary_path == f"{versions.current(spark, result)}/user_summary"
    spark.sql(f"DROP TABLE {table}")


def test_versions_are_dropped_by_age_but_for_the_current_one(spark, tmp_path):
    path = str(tmp_path / "result")
    with pytest.raises(MissingResultError):
        versions.current(spark, path)
    assert versions.versions(spark, path) == []
    made = []
    for n in range(3):
        made.append(versions.new_version(path))
        spark.range(n + 1).write.parquet(made[-1])
        if n < 2:
            versions.commit(spark, path, made[-1])
    assert versions.current(spark, path) == made[1]
    assert versions.drop_versions(spark, path, older_than=3600) == []
    names = [m.rsplit("/", 1)[-1] for m in made]
    assert versions.drop_versions(spark, path, older_than=0) == [names[0], names[2]]
    assert spark.read.parquet(versions.current(spark, path)).count() == 2
    for wrong in (versions.new_version(path), str(tmp_path), made[0]):
        with pytest.raises(MissingResultError):
            versions.commit(spark, path, wrong)


def test_scores_are_committed_after_they_were_read_back(spark, tmp_path, monkeypatch):
    put(f"{tmp_path}/in", "学号,姓名,科目,分数,班级\ns1,张三,math,80,1\n")
    first = score_job.run_scores(spark, f"{tmp_path}/in", f"{tmp_path}/out")

    def stop(*args):
        raise RuntimeError("stopped")

    monkeypatch.setattr(score_job, "output_stats", stop)
    with pytest.raises(RuntimeError):
        score_job.run_scores(spark, f"{tmp_path}/in", f"{tmp_path}/out")
    assert versions.current(spark, f"{tmp_path}/out") == first.path


def files(path):
    found = {}
    for folder, _, names in os.walk(path):
        found |= {f"{folder}/{n}": os.stat(f"{folder}/{n}").st_mtime_ns for n in names if n.endswith(".parquet")}
    return found


@pytest.fixture
def undated(spark, tmp_path):
    name = f"undated_{uuid.uuid4().hex}"
    rows = spark.createDataFrame([(f"row{n}", f"name {n}", str(n)) for n in range(60)], "row_key string, name string, age string")
    buckets.ensure_table(spark, name, rows.schema, str(tmp_path / "table"), 8)
    buckets.put(spark, name, rows, ["name"])
    yield name, rows
    spark.sql(f"DROP TABLE {name}")


def test_a_put_rewrites_only_the_buckets_it_touches(spark, tmp_path, undated):
    name, rows = undated
    before = files(tmp_path / "table")
    touched = buckets.put(spark, name, rows.filter("row_key = 'row7'").select("row_key", F.lit("new").alias("name"), F.lit(None).cast("string").alias("age")), ["name"])
    after = files(tmp_path / "table")
    same = {f for f in before if f"bucket={touched[0]}/" not in f}
    assert len(touched) == 1 and same and {f: after.get(f) for f in same} == {f: before[f] for f in same}
    assert tuple(buckets.get(spark, name, "row7").first()) == ("row7", "new", "7")
    assert buckets.scan(spark, name).count() == 60 and buckets.get(spark, name, "none").isEmpty()
    plan = buckets.get(spark, name, "row7")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan
    assert [r.row_key for r in buckets.scan(spark, name, "row5", 3).collect()] == ["row5", "row50", "row51"]


def test_odd_puts(spark, undated):
    name, rows = undated
    assert buckets.put(spark, name, rows.limit(0), ["name"]) == []
    twice = spark.createDataFrame([("é", "a", "1"), ("é", "b", None), ("", "c", "2")], rows.schema)
    buckets.put(spark, name, twice, ["name"])
    assert tuple(buckets.get(spark, name, "é").first()) == ("é", "b", "1") and buckets.get(spark, name, "").count() == 1
    with pytest.raises(DataError):
        buckets.put(spark, name, spark.createDataFrame([(None, "a", "1")], rows.schema), ["name"])
    with pytest.raises(SchemaError):
        buckets.ensure_table(spark, name, rows.drop("age").schema, "unused")


def test_first_rows_read_only_the_dates_they_need(spark, tmp_path):
    name = f"early_{uuid.uuid4().hex}"
    days = [f"2024-01-{d:02d}" for d in range(1, 21)]
    rows = spark.createDataFrame([(f"{d.replace('-', '')}#u{n}", str(n), d) for d in days for n in range(4)], "row_key string, v string, d string")
    rows = rows.select("row_key", "v", F.col("d").cast("date").alias("biz_date"))
    keyed.ensure_table(spark, name, rows.schema, str(tmp_path / "t"))
    keyed.replace_slices(rows, name)
    first = keyed.first_rows(spark, name, 10)
    scan = next(x for x in first._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan" in x)
    assert "PartitionFilters: [" in scan and "PartitionFilters: []" not in scan
    assert len(first.inputFiles()) > 0
    want = sorted(r.row_key for r in rows.collect())
    for n in (0, 1, 10, 79, 80, 200):
        assert [r.row_key for r in keyed.first_rows(spark, name, n).collect()] == want[:n]
    keyed.replace_slices(spark.createDataFrame([("00first", "x"), ("zz", "y")], "row_key string, v string").withColumn("biz_date", F.lit(None).cast("date")), name)
    assert [r.row_key for r in keyed.first_rows(spark, name, 2).collect()] == ["00first", want[0]]
    spark.sql(f"DROP TABLE {name}")


@pytest.mark.parametrize("key, rows", [("20240101#000050000x", 0), ("20240101#000050000", 1)])
def test_an_absent_key_reads_no_row_group(spark, tmp_path, key, rows):
    """Keys on both sides exist, and there are too many for a dictionary page: only the Bloom filter can tell."""
    name = f"bloom_{uuid.uuid4().hex}"
    made = spark.range(150_000).select(F.format_string("20240101#%09d", "id").alias("row_key"), F.lit("x").alias("v"))
    made = made.withColumn("biz_date", F.lit("2024-01-01").cast("date"))
    keyed.ensure_table(spark, name, made.schema, str(tmp_path / "t"))
    keyed.replace_slices(made, name)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        got = keyed.point_get(spark.table(name), key)
        assert len(got.collect()) == rows
        scanned = got._jdf.queryExecution().executedPlan().collectLeaves().apply(0).metrics().apply("numOutputRows").value()
        assert (scanned > 0) == (rows > 0)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.sql(f"DROP TABLE {name}")
