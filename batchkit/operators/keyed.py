"""A keyed table: one row per key ``YYYYMMDD#entity``, text cells, one version per cell.

It is a Parquet table in one folder per business date, sorted by key inside the files.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from batchkit.errors import DataError, ReconcileError, SchemaError
from batchkit.functions.dates import biz_date_key, row_key
from batchkit.functions.numbers import money_text
from batchkit.operators.checks import require_rows
from batchkit.session import land
from batchkit.sources.layers import BIZ_DATE

KEY = "row_key"

# Of a table's files: a write replaces the folders it holds, and a filter on the key tells which row groups lack a key.
TABLE_OPTIONS = f"OPTIONS ('partitionOverwriteMode' = 'dynamic', 'parquet.bloom.filter.enabled#{KEY}' = 'true')"


def stamp(df: DataFrame, day: Column, entity: Column, update_time: str) -> DataFrame:
    """Add the row key, the business date and the time of the run.

    The time is a parameter, not the clock, so a rerun can repeat its result.
    """
    return df.withColumns(
        {KEY: row_key(day, entity), BIZ_DATE: day.cast("date"), "update_time": F.lit(update_time)}
    )


def user_stat_rows(summary: DataFrame, biz_date: str, update_time: str) -> DataFrame:
    """The per-user summary of one date, its totals exact numbers or text already, as keyed rows with text cells."""
    biz_date_key(biz_date)
    total = F.col("total_amount")
    if not isinstance(summary.schema["total_amount"].dataType, T.StringType):
        total = money_text(total)
    return stamp(summary, F.lit(biz_date), F.col("user_id"), update_time).select(
        KEY,
        "user_id",
        F.col("order_count").cast("string").alias("order_count"),
        total.alias("total_amount"),
        "update_time",
        BIZ_DATE,
    )


def ensure_table(spark: SparkSession, name: str, schema: T.StructType, path: str) -> None:
    """Create the table at ``path`` unless it exists.

    Writes replace only the business dates they hold. Files already at ``path`` become its content.
    """
    if spark.catalog.tableExists(name):
        present = {f.name: f.dataType for f in spark.table(name).schema}
        if present != {f.name: f.dataType for f in schema.fields}:
            raise SchemaError(f"{name} exists with other columns: {', '.join(present)}")
        return
    fields = [f for f in schema.fields if f.name != BIZ_DATE]
    # An append of no rows makes the folder, if it is not there, and leaves files in it alone.
    spark.createDataFrame([], schema).write.mode("append").partitionBy(BIZ_DATE).parquet(path)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}, {BIZ_DATE} date) USING parquet "
        f"{TABLE_OPTIONS} PARTITIONED BY ({BIZ_DATE}) LOCATION '{path}'"
    )
    spark.catalog.recoverPartitions(name)


def latest_per_key(
    df: DataFrame, key: str, cells: Sequence[str], order_by: Sequence[str], keep: Sequence[str] = ()
) -> DataFrame:
    """One row per key: of each cell the latest value that is present.

    The maximum combines on the map side, so a key written very often is no hot spot. ``keep`` names
    columns that the key determines.
    """
    version = F.struct(*order_by)
    return df.groupBy(key, *keep).agg(
        *[F.max_by(c, F.when(F.col(c).isNotNull(), version)).alias(c) for c in cells]
    )


def merge_cells(
    existing: DataFrame, batch: DataFrame, key: str, cells: Sequence[str], order_by: Sequence[str], keep: Sequence[str] = ()
) -> DataFrame:
    """The table after writing ``batch`` over ``existing``: the last write of each cell wins.

    ``order_by`` orders the writes inside the batch, and any write of the batch is later than what
    exists. A cell that the batch lacks keeps its value.
    """
    old = existing.select(key, *keep, *cells, F.lit(0).alias("_write"))
    new = batch.select(key, *keep, *cells, F.lit(1).alias("_write"), *[F.col(c).alias(f"_by_{c}") for c in order_by])
    both = old.unionByName(new, allowMissingColumns=True)
    return latest_per_key(both, key, cells, ["_write", *[f"_by_{c}" for c in order_by]], keep)


def upsert(
    spark: SparkSession,
    name: str,
    batch: DataFrame,
    order_by: Sequence[str],
    biz_dates: Sequence[str] | None = None,
) -> None:
    """Write keyed rows into the table; a rerun leaves no second row for a key.

    Only the folders of dates that the batch holds are read and replaced: ``biz_dates`` names them;
    without it the batch is set aside once and asked for its dates. The merged dates are written aside before they replace the old
    ones: a failed job loses neither. One writer per date at a time.
    """
    table = spark.table(name)
    if biz_dates is None:
        batch = land(batch, "batch")
        held = batch.select(BIZ_DATE).distinct().collect()
        if any(r[BIZ_DATE] is None for r in held):
            raise DataError("the batch holds rows without a business date")
        biz_dates = [str(r[BIZ_DATE]) for r in held]
    if not biz_dates:
        return
    named = F.col(BIZ_DATE).isin([F.lit(d).cast("date") for d in biz_dates])
    existing = table.filter(named)
    cells = [c for c in table.columns if c not in (KEY, BIZ_DATE)]
    merged = land(merge_cells(existing, batch, KEY, cells, order_by, keep=[BIZ_DATE]), "upsert")
    if not merged.filter(~F.coalesce(named, F.lit(False))).isEmpty():
        raise DataError(f"the batch holds rows of other dates than {', '.join(biz_dates)}")
    replace_slices(merged, name)


def replace_slices(df: DataFrame, name: str) -> None:
    """Replace, in the table, exactly the business dates that ``df`` holds."""
    (
        df.hint("rebalance", BIZ_DATE)
        .sortWithinPartitions(BIZ_DATE, KEY)
        .select(*df.sparkSession.table(name).columns)
        .write.insertInto(name, overwrite=True)
    )


def _date_of(prefix: str) -> Column:
    return F.lit(f"{prefix[:4]}-{prefix[4:6]}-{prefix[6:8]}").try_cast("date")


def _within(table: DataFrame, prefix: str) -> DataFrame:
    """The folders in which keys with the prefix can be. A prefix that is no date, or its beginning, prunes nothing."""
    if len(prefix) >= 8 and prefix[:8].isdigit():
        return table.filter(F.col(BIZ_DATE) == _date_of(prefix))
    if prefix.isdigit():
        return table.filter(F.date_format(BIZ_DATE, "yyyyMMdd").startswith(prefix))
    return table


def prefix_scan(table: DataFrame, prefix: str) -> DataFrame:
    """Rows whose key starts with the prefix; only folders of dates that fit it are opened."""
    return _within(table, prefix).filter(F.col(KEY).startswith(prefix))


def point_get(table: DataFrame, key: str) -> DataFrame:
    """The row of one key; key order and Bloom filters inside the files let the scan skip the other row groups."""
    return _within(table, key).filter(F.col(KEY) == key)


def limit_scan(table: DataFrame, n: int = 10) -> DataFrame:
    """The first ``n`` rows in key order."""
    return table.orderBy(KEY).limit(n)


def first_rows(spark: SparkSession, name: str, n: int = 10) -> DataFrame:
    """The first ``n`` rows of the table in key order, from as few dates as hold them.

    Keys begin with their date, so dates in order are keys in order. The catalog lists the dates; they are looked at in
    growing groups until enough rows are there. Keys without a date can stand anywhere, so their folder is always read.
    """
    table = spark.table(name)
    listed = spark.sql(f"SHOW PARTITIONS {name}").collect()
    dates = sorted(value for value in (r[0].split("=", 1)[1] for r in listed) if not value.startswith("__"))
    found = at = 0
    step = 1
    while found < n and at < len(dates):
        group = dates[at : at + step]
        found += table.filter(_dated(group[0], group[-1])).limit(n - found).count()
        at, step = at + len(group), 2 * step
    if at == len(dates):
        return limit_scan(table, n)
    undated = F.col(BIZ_DATE).isNull()
    return limit_scan(table.filter(_dated(dates[0], dates[at - 1]) | undated), n)


def _dated(first: str, last: str) -> Column:
    return F.col(BIZ_DATE).between(F.lit(first).cast("date"), F.lit(last).cast("date"))


def cells_of(table: DataFrame, family: str = "cf") -> DataFrame:
    """The sparse form: one row per present cell, named ``family:column``, its value decoded to text."""
    columns = [c for c in table.columns if c != KEY]
    named = table.select(
        KEY,
        *[
            (F.decode(F.col(f.name), "UTF-8") if isinstance(f.dataType, T.BinaryType) else F.col(f.name).cast("string"))
            .alias(f"{family}:{f.name}")
            for f in table.schema.fields
            if f.name != KEY
        ],
    )
    return named.unpivot([KEY], [f"`{family}:{c}`" for c in columns], "cell", "value").filter(
        F.col("value").isNotNull()
    )


def require_slice(spark: SparkSession, name: str, biz_date: str, expected: int) -> None:
    """Raise unless the date's rows in the table are as many as were written."""
    rows = prefix_scan(spark.table(name), f"{biz_date_key(biz_date)}#")
    require_rows(rows, f"{name} of {biz_date}")
    scanned = rows.count()
    if scanned != expected:
        raise ReconcileError(f"{name} of {biz_date}: wrote {expected} rows, scanned {scanned}")
