"""Contracts on tables, and comparison of what was written with what is read back."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from batchkit.errors import DataError, EmptyResultError, ReconcileError, SchemaError
from batchkit.functions import exact
from batchkit.functions.numbers import to_count
from batchkit.functions.text import digest, strip_or_empty


def keep_where(df: DataFrame, condition: Column) -> DataFrame:
    """The rows where ``condition`` is true, for a condition on columns that are costly to compute.

    A filter would be moved below the projection that computes them and repeat their expressions,
    once per mention; a generator of one or no row stays where it is.
    """
    kept = F.explode(F.when(condition, F.array(F.lit(True))))
    return df.select("*", kept.alias("_kept")).drop("_kept")


def require_columns(actual: Iterable[str], required: Sequence[str]) -> list[str]:
    """Raise if a required column is missing; return the columns that were not asked for."""
    actual = list(actual)
    missing = sorted(set(required) - set(actual))
    if missing:
        raise SchemaError(f"missing columns: {', '.join(missing)}; found: {', '.join(actual)}")
    return [name for name in actual if name not in required]


def require_rows(df: DataFrame, what: str) -> None:
    """Raise if ``df`` is empty. Runs a job that stops at the first row."""
    if df.isEmpty():
        raise EmptyResultError(f"no rows in {what}")


def row_count_check(df: DataFrame, expected: int | Column) -> DataFrame:
    """One row: the number of rows, the expected number, whether they agree.

    ``expected`` may be an aggregate over the same table.
    """
    wanted = F.lit(expected) if isinstance(expected, int) else expected
    counted = df.agg(F.count(F.lit(1)).alias("row_count"), wanted.cast("bigint").alias("expected"))
    return counted.withColumn("matches", F.col("row_count") == F.col("expected"))


def table_shape(df: DataFrame) -> DataFrame:
    """One row: the number of rows and of columns."""
    return df.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.lit(len(df.columns)).cast("bigint").alias("column_count"),
    )


def _not_negative(value: Column, name: str) -> Column:
    """NULL where the value is 0 or more, which is tested first: it is the common case."""
    return (
        F.when(value >= 0, F.lit(None))
        .when(value < 0, F.lit(f"{name}_negative"))
        .otherwise(F.lit(f"{name}_invalid"))
    )


def summary_violations(df: DataFrame) -> DataFrame:
    """The rows of a text summary (user_id, order_count, total_amount) that break a rule.

    ``reason`` is the first rule broken: an empty user, a count or an amount that is none or negative.
    """
    parsed = df.withColumns(
        {
            "_user": strip_or_empty(F.col("user_id")),
            "_count": to_count(F.col("order_count")),
            "_total": exact.from_text(F.col("total_amount")),
        }
    )
    reason = F.coalesce(
        F.when(F.col("_user") == "", F.lit("user_id_empty")),
        _not_negative(F.col("_count"), "order_count"),
        F.when(F.col("_total.negative"), F.lit("total_amount_negative")),
        # A number beyond what sums hold is still a number.
        F.when(F.col("_total.fault") == exact.INVALID, F.lit("total_amount_invalid")),
    )
    tagged = parsed.withColumn("reason", reason).drop("_user", "_count", "_total")
    return keep_where(tagged, F.col("reason").isNotNull())


def require_clean(violations: DataFrame) -> None:
    """Raise on the first violating row. Runs a job that stops there."""
    first = violations.take(1)
    if first:
        raise DataError(f"invalid row: {first[0].asDict()}")


def multiset_diff(written: DataFrame, read: DataFrame) -> DataFrame:
    """Rows whose number of copies differs, with ``surplus`` = copies written - copies read.

    Both sides are counted in one aggregation: a single shuffle of partial counts, so a row with
    very many copies is no hot spot. Missing equals missing.
    """
    columns = written.columns
    require_columns(read.columns, columns)
    both = written.withColumn("_side", F.lit(1)).unionByName(
        read.select(*columns).withColumn("_side", F.lit(-1))
    )
    return both.groupBy(*columns).agg(F.sum("_side").alias("surplus")).filter(F.col("surplus") != 0)


def readback_diff(written: DataFrame, read: DataFrame) -> DataFrame:
    """One row: rows written, rows read, rows lost and rows that nobody wrote."""
    columns = written.columns
    require_columns(read.columns, columns)
    both = written.select(*columns, F.lit(1).alias("_w"), F.lit(0).alias("_r")).unionByName(
        read.select(*columns, F.lit(0).alias("_w"), F.lit(1).alias("_r"))
    )
    per_row = both.groupBy(*columns).agg(F.sum("_w").alias("w"), F.sum("_r").alias("r"))
    zero = F.lit(0).cast("bigint")
    return per_row.agg(
        F.coalesce(F.sum("w"), zero).alias("written"),
        F.coalesce(F.sum("r"), zero).alias("read"),
        F.coalesce(F.sum(F.greatest(F.col("w") - F.col("r"), zero)), zero).alias("missing"),
        F.coalesce(F.sum(F.greatest(F.col("r") - F.col("w"), zero)), zero).alias("unexpected"),
    )


def require_readback(written: DataFrame, read: DataFrame) -> int:
    """Raise unless both tables hold the same rows; return their number."""
    diff = readback_diff(written, read).first()
    if diff["missing"] or diff["unexpected"]:
        raise ReconcileError(f"read-back differs: {diff.asDict()}")
    return diff["read"]


def row_digest(columns: Sequence[str]) -> Column:
    """The SHA-256 of a row over the columns in order; times count to the microsecond."""
    exact_times = {
        "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
        "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
        "ignoreNullFields": "false",
    }
    return digest(F.to_json(F.struct(*[F.col(f"`{c}`") for c in columns]), exact_times))


def row_digests(df: DataFrame) -> DataFrame:
    """One digest per row over all columns."""
    return df.select(row_digest(df.columns).alias("sha256"))


def copy_check(source: DataFrame, copy: DataFrame) -> DataFrame:
    """``readback_diff`` on row digests: wide rows are compared while 64 characters each are shuffled."""
    return readback_diff(row_digests(source), row_digests(copy.select(*source.columns)))


def manifest_diff(source: DataFrame, copy: DataFrame) -> DataFrame:
    """Files by name whose size or digest differs, or that only one side has."""
    a, b = source.alias("a"), copy.alias("b")
    same = F.col("a.size_bytes").eqNullSafe(F.col("b.size_bytes")) & F.col("a.sha256").eqNullSafe(
        F.col("b.sha256")
    )
    return (
        a.join(b, F.col("a.name") == F.col("b.name"), "full")
        .filter(~same)
        .select(
            F.coalesce("a.name", "b.name").alias("name"),
            F.col("a.size_bytes").alias("source_bytes"),
            F.col("b.size_bytes").alias("copy_bytes"),
        )
    )


def layer_presence(raw_counts: DataFrame, result_counts: DataFrame, key: str = "biz_date") -> DataFrame:
    """Per date: rows in the raw and in the result layer, and whether both hold any."""
    joined = raw_counts.join(result_counts, key, "full").select(
        key,
        F.coalesce(F.col("raw_rows"), F.lit(0)).cast("bigint").alias("raw_rows"),
        F.coalesce(F.col("result_rows"), F.lit(0)).cast("bigint").alias("result_rows"),
    )
    return joined.withColumn("complete", (F.col("raw_rows") > 0) & (F.col("result_rows") > 0))
