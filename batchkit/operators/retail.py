"""The retail table: standard names, typed values, cleaning rules, customer summary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from batchkit.functions import exact
from batchkit.functions.dates import to_time
from batchkit.functions.numbers import to_number
from batchkit.functions.text import has_mark, na_to_null, strip_or_empty, strip_ws
from batchkit.operators.checks import require_columns

# The column names of the source file and their standard names.
STANDARD_NAMES = {
    "InvoiceNo": "invoice_no",
    "StockCode": "stock_code",
    "Description": "description",
    "Quantity": "quantity",
    "InvoiceDate": "invoice_date",
    "UnitPrice": "unit_price",
    "CustomerID": "customer_id",
    "Country": "country",
}
COLUMNS = tuple(STANDARD_NAMES.values())

# All other columns are text.
_TYPES = {"quantity": T.DoubleType(), "unit_price": T.DoubleType(), "invoice_date": T.TimestampNTZType()}

RETAIL_SCHEMA = T.StructType([T.StructField(name, _TYPES.get(name, T.StringType())) for name in COLUMNS])


def normalise(df: DataFrame) -> DataFrame:
    """Source names to standard names; exactly the eight columns in their order."""
    require_columns(df.columns, list(STANDARD_NAMES))
    return df.withColumnsRenamed(STANDARD_NAMES).select(*COLUMNS)


# Measures as they were written, beside their doubles.
TEXTS = {"quantity": "quantity_text", "unit_price": "unit_price_text"}


def coerce_types(df: DataFrame, keep_texts: bool = False) -> DataFrame:
    """Text columns to their types; what cannot be converted is missing.

    ``keep_texts`` keeps the texts of the measures in columns of their own, for exact sums.
    """
    require_columns(df.columns, COLUMNS)
    texts = [na_to_null(F.col(c)).alias(name) for c, name in TEXTS.items() if keep_texts]
    return df.select(*[na_to_null(F.col(c)).alias(c) for c in COLUMNS], *texts).withColumns(
        {
            "quantity": to_number(F.col("quantity")),
            "invoice_date": to_time(F.col("invoice_date")),
            "unit_price": to_number(F.col("unit_price")),
        }
    )


def sign_class(c: str) -> Column:
    """The class of a measure: positive, zero, negative or missing."""
    return (
        F.when(F.col(c) > 0, "positive")
        .when(F.col(c) == 0, "zero")
        .when(F.col(c) < 0, "negative")
        .otherwise("missing")
    )


def clean(typed: DataFrame) -> DataFrame:
    """Flags and classes beside the data: no row is dropped here.

    Cancelled invoices, the signs of quantity and price, whether the row may enter customer
    analysis, whether it lacks a description.
    """
    return typed.withColumns(
        {
            "is_cancelled": has_mark(F.col("invoice_no")),
            "quantity_class": sign_class("quantity"),
            "price_class": sign_class("unit_price"),
            "customer_usable": strip_or_empty(F.col("customer_id")) != "",
            "lacks_description": strip_or_empty(F.col("description")) == "",
        }
    )


CUSTOMER_SUMMARY = """
SELECT customer_id,
       count(*) AS line_count,
       count_if(is_cancelled) AS cancelled_lines,
       count_if(plain IS NULL AND wide IS NULL) AS unusable_lines,
       sum(plain) AS plain,
       sum(wide.limb_0) AS limb_0, sum(wide.limb_1) AS limb_1, sum(wide.limb_2) AS limb_2, sum(wide.limb_3) AS limb_3
FROM {lines}
WHERE customer_usable
GROUP BY customer_id
"""

_PLAIN_PLACES = 14


def _line_amounts(cleaned: DataFrame) -> DataFrame:
    """Quantity times price, exactly: short texts as decimals, others as limbs."""
    texts = [
        strip_ws(F.col(name) if name in cleaned.columns else F.col(c).cast("string")) for c, name in TEXTS.items()
    ]
    quantity, price = texts
    short = exact.is_short(quantity, 11, 6) & exact.is_short(price, 10, 8)
    plain = F.when(short, quantity.try_cast("decimal(18,6)") * price.try_cast("decimal(19,8)"))
    wide = F.when(plain.isNull(), exact.product(quantity, price))
    lines = cleaned.select("customer_id", "is_cancelled", "customer_usable", plain.alias("plain"), wide.alias("product"))
    return lines.withColumn("wide", F.col("product.wide")).drop("product")


def customer_summary(cleaned: DataFrame) -> DataFrame:
    """Per customer: lines, cancelled lines and amount, as SQL over the cleaned table.

    Quantity and price are multiplied and summed exactly, from the texts kept by ``coerce_types`` or else from the short
    decimals that read back as the doubles. Lines whose measures are missing or no numbers, have more than 18
    significant digits, or make an amount of 1e81 or of more than 27 decimals are counted as unusable and enter no sum.
    """
    sums = cleaned.sparkSession.sql(CUSTOMER_SUMMARY, lines=_line_amounts(cleaned))
    total = exact.joined_money(F.col("plain"), [F.col(c) for c in exact.LIMBS], _PLAIN_PLACES)
    return sums.select(
        "customer_id",
        "line_count",
        "cancelled_lines",
        "unusable_lines",
        F.when(F.col("line_count") > F.col("unusable_lines"), total).alias("total_amount"),
    )
