"""Layer tables (raw, clean, result) kept in one folder per business date."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from batchkit.errors import DataError

BIZ_DATE = "biz_date"


def read_layer(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A whole layer; the schema avoids a look into the files."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def read_slice(spark: SparkSession, path: str, biz_date: str, schema: T.StructType | None = None) -> DataFrame:
    """The rows of one business date; other dates' folders are not opened."""
    return read_layer(spark, path, schema).filter(F.col(BIZ_DATE) == F.lit(biz_date).cast("date"))


def write_slices(df: DataFrame, path: str, sort_by: tuple[str, ...] = ()) -> None:
    """Write ``df`` by business date, replacing exactly the dates it holds and no others.

    Rebalancing by date keeps files few and large, and splits a date that holds much of the data
    over several tasks instead of sending it to one. Sorting inside files lets a scan by key skip
    row groups.
    """
    rebalanced = df.hint("rebalance", BIZ_DATE)
    if sort_by:
        rebalanced = rebalanced.sortWithinPartitions(BIZ_DATE, *sort_by)
    (
        rebalanced.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(BIZ_DATE)
        .parquet(path)
    )


def require_new_layer(source: str, target: str) -> None:
    """Refuse to write a layer over, into or above the one it is made from."""
    a, b = source.rstrip("/") + "/", target.rstrip("/") + "/"
    if a.startswith(b) or b.startswith(a):
        raise DataError(f"a layer must not overwrite its input: {source} -> {target}")


def slice_counts(df: DataFrame, alias: str) -> DataFrame:
    """Rows per business date."""
    return df.groupBy(BIZ_DATE).agg(F.count(F.lit(1)).alias(alias))
