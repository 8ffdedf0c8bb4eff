"""Joins that move texts have one plan at every size, so what small input takes tells what large input will."""

import pytest
from pyspark.sql import functions as F

from batchkit.llm import minhash, mixing

ROWS = [(i, f"{'one two three four five six ' * 5}{i % 4}", "s") for i in range(40)]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def wanted(df):
    return df.select(F.col("doc_id").alias("node"), F.col("doc_id").alias("id"), F.lit(b"").alias("key"))


@pytest.mark.parametrize(
    "moved",
    [
        mixing.mix_documents,
        minhash.drop_near_copies,
        lambda df: minhash.shingle_sets(df, wanted(df.limit(3)), "doc_id", "text", 5),
    ],
    ids=["mixing", "rows that stay", "shingle sets"],
)
def test_joins_of_texts_are_merged_on_small_input(spark, moved):
    text = plan(moved(spark.createDataFrame(ROWS, "doc_id long, text string, source string")))
    assert "SortMergeJoin" in text and "BroadcastHashJoin" not in text
