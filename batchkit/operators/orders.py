"""Order rows: tagging of bad rows, exact sums per user, the text summary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from batchkit.functions import exact
from batchkit.functions.numbers import money_text
from batchkit.functions.text import strip_or_empty
from batchkit.operators.checks import keep_where
from batchkit.sources.csv import EXTRA_CELLS

REQUIRED = ("order_id", "user_id", "amount")

EXTRA = "extra_cells"
NO_ORDER = "order_id_empty"
NO_USER = "user_id_empty"
BAD_AMOUNT = "amount_invalid"
NEGATIVE = "amount_negative"
OUT_OF_RANGE = "amount_out_of_range"
TOO_FINE = "amount_too_fine"

WIDE = "amount_wide"
_EXACT = "_amount_exact"


def _is_text(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, T.StringType)


def _identifier(df: DataFrame, name: str) -> tuple[Column, Column]:
    """The identifier, trimmed if it is text, and whether it is empty."""
    if _is_text(df, name):
        return strip_or_empty(F.col(name)), F.col(name) == ""
    return F.col(name), F.col(name).isNull()


def _exact(df: DataFrame) -> Column:
    amount = F.col("amount")
    if _is_text(df, "amount"):
        return exact.from_text(amount)
    if isinstance(df.schema["amount"].dataType, (T.DoubleType, T.FloatType)):
        return exact.from_double(amount.cast("double"))
    return exact.from_text(amount.cast("string"))


def tag_rejects(df: DataFrame) -> DataFrame:
    """Add ``reason``, the first rule a row breaks (NULL if it is valid), and make the amount exact.

    ``amount`` becomes ``decimal(38,10)``, or NULL where ``amount_wide`` holds it: see ``functions.exact``. What it came
    from is kept as ``amount_source``. Infinite and not-a-number amounts are invalid; numbers of 1e81 and more are out
    of range, those with more than 27 decimals too fine. An amount of zero is valid. Text identifiers are trimmed,
    others keep their type.
    """
    order_id, no_order = _identifier(df, "order_id")
    user_id, no_user = _identifier(df, "user_id")
    checks = [(no_order, NO_ORDER), (no_user, NO_USER)]
    if EXTRA_CELLS in df.columns:
        checks.insert(0, (F.col(EXTRA_CELLS), EXTRA))
    checks.append((F.col(f"{_EXACT}.negative"), NEGATIVE))
    reason = F.coalesce(
        *[F.when(broken, F.lit(name)) for broken, name in checks], F.concat(F.lit("amount_"), F.col(f"{_EXACT}.fault"))
    )
    parsed = df.withColumns({"order_id": order_id, "user_id": user_id, "amount_source": F.col("amount"), _EXACT: _exact(df)})
    exact_columns = {"amount": F.col(f"{_EXACT}.plain"), WIDE: F.col(f"{_EXACT}.wide"), "reason": reason}
    return parsed.withColumns(exact_columns).drop(_EXACT)


def rejects(tagged: DataFrame) -> DataFrame:
    """The rejected records with their reason."""
    return keep_where(tagged, F.col("reason").isNotNull())


def order_rollup(tagged: DataFrame) -> DataFrame:
    """Rows and amount per (reason, user), the user being NULL for rejected rows.

    One pass over the orders yields a table small enough to serve both the summary and the counts
    of rejects. Count and sum combine on the map side, so a user with most of the rows is no hot spot.
    """
    valid = F.col("reason").isNull()
    return tagged.groupBy("reason", F.when(valid, F.col("user_id")).alias("user_id")).agg(
        F.count(F.lit(1)).alias("order_count"),
        F.sum(F.when(valid, F.col("amount"))).alias("amount"),
        *exact.sum_limbs(F.when(valid, F.col(WIDE)), ""),
    )


def _totals(amount: str) -> tuple[Column, list[Column]]:
    return F.col(amount), [F.col(c) for c in exact.LIMBS]


def summary_of(rollup: DataFrame) -> DataFrame:
    """Per user: number of orders and exact total with two places; a total of 1e36 or more raises."""
    total = exact.joined_money(*_totals("amount")).alias("total_amount")
    return rollup.filter(F.col("reason").isNull()).select("user_id", "order_count", total)


def totals_text(rollup: DataFrame) -> DataFrame:
    """``summary_text`` of the rollup itself, with totals of any size.

    The sums are sorted, not their texts: a sort looks at its rows twice, and the texts are the costly part.
    """
    sums = rollup.filter(F.col("reason").isNull()).withColumn("user_id", F.col("user_id").cast("string"))
    return sums.orderBy("user_id").select(
        "user_id",
        F.col("order_count").cast("string").alias("order_count"),
        exact.joined_text(*_totals("amount")).alias("total_amount"),
    )


def counts_of(rollup: DataFrame) -> DataFrame:
    """One row: valid rows, skipped rows, users."""
    valid = F.col("reason").isNull()
    zero = F.lit(0).cast("bigint")
    return rollup.agg(
        F.coalesce(F.sum(F.when(valid, F.col("order_count"))), zero).alias("valid_rows"),
        F.coalesce(F.sum(F.when(~valid, F.col("order_count"))), zero).alias("skipped_rows"),
        F.count_if(valid).alias("users"),
    )


def reject_counts(tagged: DataFrame) -> DataFrame:
    """Rows per reason; the valid ones are counted under ``valid``."""
    return tagged.groupBy(F.coalesce("reason", F.lit("valid")).alias("reason")).agg(
        F.count(F.lit(1)).alias("row_count")
    )


def user_summary(tagged: DataFrame, dedup: bool = False) -> DataFrame:
    """Per user: number of valid orders and exact total with two places.

    Rows are counted, not distinct order ids; with ``dedup`` fully equal (order, user, amount) rows
    count once.
    """
    is_valid = F.col("reason").isNull()
    typed = not any(_is_text(tagged, c) for c in ("order_id", "user_id", "amount_source"))
    if typed and EXTRA_CELLS not in tagged.columns:
        # The same test as plain conjuncts, which the scan takes.
        amount = F.col("amount_source")
        present = F.col("order_id").isNotNull() & F.col("user_id").isNotNull()
        valid = tagged.filter(present & (amount >= 0) & (amount < F.lit(exact.BOUND)) & is_valid)
    else:
        valid = keep_where(tagged, is_valid)
    if dedup:
        valid = valid.select("order_id", "user_id", "amount", WIDE).distinct()
    summed = valid.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("order_count"), F.sum("amount").alias("amount"), *exact.sum_limbs(F.col(WIDE), "")
    )
    return summed.select("user_id", "order_count", exact.joined_money(*_totals("amount")).alias("total_amount"))


def summary_text(summary: DataFrame) -> DataFrame:
    """The summary as text in its fixed column order, sorted by user in code-point order."""
    return summary.select(
        F.col("user_id").cast("string").alias("user_id"),
        F.col("order_count").cast("string").alias("order_count"),
        money_text(F.col("total_amount")).alias("total_amount"),
    ).orderBy("user_id")
