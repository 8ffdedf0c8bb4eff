"""Files as rows: listings, line counts, digests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from batchkit.functions.text import digest


def _below(path: str) -> Column:
    """The file's path below the folder that was asked for."""
    return F.substring_index("path", f"{path.rstrip('/')}/", -1).alias("name")


def file_manifest(spark: SparkSession, path: str) -> DataFrame:
    """One row per file: name, size and time of change. The content is never read.

    Spark's file scan leaves out files of length 0.
    """
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(path)
        .select(
            _below(path),
            F.col("length").alias("size_bytes"),
            F.col("modificationTime").alias("modified"),
        )
    )


def file_digests(spark: SparkSession, path: str) -> DataFrame:
    """One row per file: name, size and SHA-256.

    Each file is one value of one task and at most 2 GB; Spark refuses a larger one. Compare larger
    data by rows with ``operators.checks.copy_check``.
    """
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(path)
        .select(
            _below(path),
            F.col("length").alias("size_bytes"),
            digest(F.col("content")).alias("sha256"),
        )
    )


def line_count(spark: SparkSession, path: str) -> DataFrame:
    """The number of lines, headers included."""
    return spark.read.text(path).agg(F.count(F.lit(1)).alias("lines"))
