"""Retail: normalise to the raw layer, profile it, write the clean layer beside it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from batchkit.operators.profile import collapse_duplicates, quality_report
from batchkit.operators.profile_slices import ProfileSpec
from batchkit.operators.retail import COLUMNS, STANDARD_NAMES, clean, coerce_types, normalise
from batchkit.sources.csv import SOURCE_FILE, head_scan, header, na_scan, require_whole_lines, untouched_scan, write_csv
from batchkit.sources.layers import require_new_layer
from batchkit.sources.records import LINE

SAMPLE_ROWS = 1000


def prepare_raw(
    spark: SparkSession,
    source: str,
    raw: str,
    sample: str | None = None,
    multiline: bool = False,
    sample_rows: int = SAMPLE_ROWS,
) -> list[str]:
    """Standard names and column order, values as they are; optionally a sample of the first rows: those of the source
    in the order of its files and lines.

    Returns the names of columns that are not taken over. Cells with line breaks need ``multiline`` and
    raise without.
    """
    require_new_layer(source, raw)
    if not multiline:
        require_whole_lines(spark, source)
    rows, extra = untouched_scan(spark, source, list(STANDARD_NAMES), multiline)
    rows = normalise(rows)
    write_csv(rows, raw)
    if sample is not None:
        names = header(spark, source)
        schema = T.StructType([T.StructField(name.strip(), T.StringType()) for name in names])
        first = head_scan(spark, source, schema, sample_rows).coalesce(1).sortWithinPartitions(SOURCE_FILE, LINE)
        write_csv(normalise(first), sample, single_file=True)
    return extra


def land_typed(spark: SparkSession, raw: str, typed: str, multiline: bool = False) -> DataFrame:
    """The raw text with types, once as Parquet: every later step reads only its columns.

    Cells with line breaks need ``multiline`` and raise without.
    """
    require_new_layer(raw, typed)
    if not multiline:
        require_whole_lines(spark, raw)
    coerce_types(na_scan(spark, raw, COLUMNS, multiline)).write.mode("overwrite").parquet(typed)
    return spark.read.parquet(typed)


PROFILE = ProfileSpec(
    distinct={
        "invoices": "invoice_no",
        "products": "stock_code",
        "customers": "customer_id",
        "countries": "country",
    },
    mark="invoice_no",
    measures=("quantity", "unit_price"),
    core=("invoice_no", "description", "customer_id", "invoice_date"),
    time="invoice_date",
    top="country",
)


def profile(typed: DataFrame) -> DataFrame:
    """The quality report of the typed retail table."""
    return quality_report(typed, **vars(PROFILE), wide=("description",))


def write_clean(typed: DataFrame, source: str, target: str, quarantine: str) -> None:
    """Each different row once, with flags and the number of further copies it had; rows that had
    copies also set apart. Nothing is written over ``source``.
    """
    require_new_layer(source, target)
    require_new_layer(source, quarantine)
    require_new_layer(target, quarantine)
    clean(collapse_duplicates(typed)).write.mode("overwrite").parquet(target)
    cleaned = typed.sparkSession.read.parquet(target)
    cleaned.filter("extra_copies > 0").select(*COLUMNS, "extra_copies").write.mode("overwrite").parquet(quarantine)
