"""A keyed table without dates: put, get and scan over hash buckets of the key.

Rows lie in one folder per bucket, sorted by key inside the files. A put merges its rows with the buckets they fall into
and rewrites those, and only those: the files of all other buckets stay as they are. A get opens one bucket.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from batchkit.errors import DataError, SchemaError
from batchkit.operators.keyed import KEY, TABLE_OPTIONS, merge_cells
from batchkit.session import land

BUCKET = "bucket"
_COUNT = "batchkit.buckets"


def ensure_table(spark: SparkSession, name: str, schema: T.StructType, path: str, buckets: int = 256) -> None:
    """Create the table at ``path`` unless it exists. The number of buckets is its property and stays.

    Choose it so that a bucket, which a put rewrites whole, has some hundred megabytes.
    """
    if spark.catalog.tableExists(name):
        present = {f.name: f.dataType for f in spark.table(name).schema if f.name != BUCKET}
        if present != {f.name: f.dataType for f in schema.fields}:
            raise SchemaError(f"{name} exists with other columns: {', '.join(present)}")
        return
    if BUCKET in schema.names or KEY not in schema.names:
        raise SchemaError(f"the table needs a column {KEY}, and keeps {BUCKET} for itself")
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}, {BUCKET} int) USING parquet "
        f"{TABLE_OPTIONS} PARTITIONED BY ({BUCKET}) LOCATION '{path}' "
        f"TBLPROPERTIES ('{_COUNT}' = '{buckets}')"
    )


def bucket_count(spark: SparkSession, name: str) -> int:
    return int(spark.sql(f"SHOW TBLPROPERTIES {name} ('{_COUNT}')").first()["value"])


def _bucket(key: Column, count: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(count)).cast("int")


def put(spark: SparkSession, name: str, batch: DataFrame, order_by: Sequence[str]) -> list[int]:
    """Write keyed rows: the last write of each cell wins, a cell that the batch lacks keeps its value.

    ``order_by`` orders the writes inside the batch. Returns the buckets written. The merged buckets are set aside
    before they replace the old ones: a failed put loses neither. One writer at a time. A row without a key raises.
    """
    table, count = spark.table(name), bucket_count(spark, name)
    batch = land(batch.withColumn(BUCKET, _bucket(F.col(KEY), count)), "put")
    held = batch.groupBy(BUCKET).agg(F.count_if(F.col(KEY).isNull()).alias("unkeyed")).collect()  # one row per bucket
    if any(r["unkeyed"] for r in held):
        raise DataError("the batch holds rows without a key")
    touched = sorted(r[BUCKET] for r in held)
    if not touched:
        return touched
    cells = [c for c in table.columns if c not in (KEY, BUCKET)]
    existing = table.filter(F.col(BUCKET).isin(touched))
    merged = land(merge_cells(existing, batch, KEY, cells, order_by, keep=[BUCKET]), "merged")
    (
        merged.hint("rebalance", BUCKET)
        .sortWithinPartitions(BUCKET, KEY)
        .select(*table.columns)
        .write.insertInto(name, overwrite=True)
    )
    return touched


def get(spark: SparkSession, name: str, key: str) -> DataFrame:
    """The row of one key, from its bucket."""
    own = spark.range(1).select(_bucket(F.lit(key), bucket_count(spark, name)).alias(BUCKET)).first()[BUCKET]
    return spark.table(name).filter((F.col(BUCKET) == own) & (F.col(KEY) == key)).drop(BUCKET)


def scan(spark: SparkSession, name: str, prefix: str = "", n: int | None = None) -> DataFrame:
    """Rows whose key starts with the prefix, or the first ``n`` of them in key order. Key order inside the files lets
    the scan skip row groups."""
    rows = spark.table(name).drop(BUCKET)
    if prefix:
        rows = rows.filter(F.col(KEY).startswith(prefix))
    return rows if n is None else rows.orderBy(KEY).limit(n)
