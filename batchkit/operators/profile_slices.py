"""The quality profile kept per business date: a new date is summarised alone, and the report merges the summaries.

Per date three tables are stored: the plain metrics, the values of the counted columns with their numbers of rows, and
the digests of rows with their numbers of copies. All of them add up over dates: counts as sums, times as the smallest
and largest, different values and copies as unions with summed counts. A rerun of a date replaces its summaries.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from batchkit.functions.text import or_label
from batchkit.operators.checks import row_digest
from batchkit.operators.profile import MISSING_LABEL, plain_metrics, ranked_values, report_of
from batchkit.session import land
from batchkit.sources.layers import BIZ_DATE, read_layer, write_slices

TIMES = {"first_time": F.min, "last_time": F.max}


@dataclass(frozen=True)
class ProfileSpec:
    """What ``operators.profile.quality_report`` looks at."""

    distinct: Mapping[str, str]
    mark: str
    measures: Sequence[str]
    core: Sequence[str]
    time: str
    top: str


def summaries(df: DataFrame, spec: ProfileSpec) -> dict[str, DataFrame]:
    """The tables of summaries of the dates in ``df``, by name. Partial counts combine on the map side."""
    columns = [c for c in df.columns if c != BIZ_DATE]
    counted = sorted({*spec.distinct.values(), spec.top})
    pairs = [F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in counted]
    rows = F.count(F.lit(1)).alias("n")
    return {
        "metrics": df.groupBy(BIZ_DATE).agg(*plain_metrics(columns, spec.mark, spec.measures, spec.time)),
        "values": df.select(BIZ_DATE, F.inline(F.array(*pairs))).groupBy(BIZ_DATE, "column", "value").agg(rows),
        "copies": df.select(BIZ_DATE, F.unhex(row_digest(columns)).alias("sha256")).groupBy(BIZ_DATE, "sha256").agg(rows),
    }


def update(df: DataFrame, path: str, spec: ProfileSpec) -> None:
    """Store the summaries of exactly the dates in ``df``. Only these rows are read, none of earlier dates."""
    for name, table in summaries(df, spec).items():
        write_slices(table, f"{path}/{name}")


def merged_report(spark: SparkSession, path: str, columns: Sequence[str], spec: ProfileSpec) -> DataFrame:
    """The report over all stored dates; equal to the report of all their rows."""
    metrics, values, copies = (read_layer(spark, f"{path}/{name}") for name in ("metrics", "values", "copies"))
    zero = F.lit(0).cast("bigint")
    plain = metrics.agg(
        *[
            TIMES[c](c).alias(c) if c in TIMES else F.coalesce(F.sum(c), zero).alias(c)
            for c in metrics.columns
            if c != BIZ_DATE
        ]
    )
    # Two parts of the report look at the merged values; the stored ones are as many as the rows in the worst case.
    by_value = land(values.groupBy("column", "value").agg(F.sum("n").alias("row_count")), "by-value")
    different = by_value.filter(F.col("value").isNotNull()).agg(
        *[F.count_if(F.col("column") == c).alias(f"distinct_{c}") for c in spec.distinct.values()]
    )
    repeated = copies.groupBy("sha256").agg(F.sum("n").alias("n"))
    duplicates = repeated.agg(
        F.coalesce(F.sum("n"), zero).alias("row_count"), F.coalesce(F.sum(F.col("n") - 1), zero).alias("duplicate_count")
    )
    label = or_label(F.col("value"), MISSING_LABEL).alias("label")
    by_label = by_value.filter(F.col("column") == spec.top).groupBy(label).agg(F.sum("row_count").alias("row_count"))
    top = ranked_values(by_label, 10)
    return report_of(plain, different, duplicates, top, columns, spec.distinct, spec.measures, spec.core)
