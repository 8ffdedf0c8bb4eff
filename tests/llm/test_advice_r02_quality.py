"""Quality policy v2 against labels."""

from pyspark.sql import functions as F

from batchkit.llm import quality
from batchkit.session import land

LABELLED = "/root/testdata/sf0.1"


def test_policy_v2_keeps_labelled_documents(spark):
    docs = spark.read.parquet(f"{LABELLED}/documents.parquet")
    labels = spark.read.parquet(f"{LABELLED}/labels.parquet").filter("quality = 1").select("doc_id")
    rows = land(quality.ledger(docs.join(labels, "doc_id")), "ledger")
    kept = {p: {r.doc_id for r in quality.apply_policy(rows, p).filter("kept").collect()} for p in ("v1", "v2")}
    other = quality.POLICIES["v1"] & ~quality.mask_of("repeated_lines")
    lost = rows.filter((F.col("failed").bitwiseAND(F.lit(other)) == 0) & (F.col("failed") != 0))
    lost = {r.doc_id for r in lost.collect()}
    assert lost and not lost & kept["v1"] and lost <= kept["v2"] and kept["v1"] <= kept["v2"]


def test_policy_v2_on_repeats_and_scripts_without_spaces(spark):
    own = [" ".join("abcdefghijklmnopqrstuvwxyz"[i + k] * 4 for k in range(12)) for i in (0, 12)]
    most = "\n".join(["the same line again"] * 6 + own)
    short = "\n".join([own[0], "Yes.", own[1], "Yes."])
    han = " ".join("这是一段没有空格的很长的中文文字内容" + chr(0x4E00 + i) for i in range(30))
    glued = " ".join("abcdefghijklmnopqrs" + "abcdefghijklmnopqrstuvwxyz"[i % 26] for i in range(26))
    rows = spark.createDataFrame([(1, most), (2, short), (3, han), (4, glued)], "doc_id long, text string")
    kept = {r.doc_id: r.kept for r in quality.apply_policy(quality.ledger(rows), "v2").collect()}
    assert kept == {1: False, 2: True, 3: True, 4: False}
