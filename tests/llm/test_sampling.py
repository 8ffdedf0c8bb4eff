"""Samples for fits."""

from pyspark.sql import functions as F

from batchkit.llm.sampling import first_texts


def test_a_sample_is_bounded_and_the_same_on_every_run(spark):
    rows = [(n % 90, f"text {n % 45}") for n in range(900)] + [(None, "x"), (None, None), (91, None), (92, "long" * 30_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"place": F.lit(1), "digest": F.lit("x")})
    got = first_texts(df, "doc_id", F.col("text"), 30)
    assert got == first_texts(df.repartition(7), "doc_id", F.col("text"), 30) and 0 < len(got) <= 30
    assert set(first_texts(df, "doc_id", F.col("text"), 2000)) == {t for _, t in rows if t is not None}
    assert first_texts(df.limit(0), "doc_id", F.col("text"), 5) == []
