"""From raw documents to token ids: filter, deduplicate, mix, encode.

Each stage reads what its predecessor wrote to the shared folder, so none is run twice and a lost executor costs its
own tasks only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from batchkit.llm import bpe, exact, minhash, mixing, quality
from batchkit.session import land

BLOCK_BYTES = 4 << 20  # text of a block of the last stage


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents the current quality policy keeps."""
    return quality.keep_documents(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group with equal texts."""
    return exact.drop_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, similarity of 0.8 or more."""
    return minhash.drop_near_copies(docs, shingle_words=5)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mix_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per document taken: its token ids, and digests of them and of their decoding.

    The ids stay in the rows, so a task holds smaller blocks than the operator's default.
    """
    return bpe.encode(docs, keep_ids=True, block_bytes=BLOCK_BYTES)


STAGES = [
    ("quality rules", quality_rules),
    ("exact dedup", exact_dedup),
    ("near dedup", near_dedup),
    ("mixing", mix_sources),
    ("byte-level BPE", encode),
]

# Components of near copies have no SQL; tests/llm holds the whole pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = land(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
