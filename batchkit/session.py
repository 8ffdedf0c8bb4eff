"""Session settings and the shared folder for tables that jobs write between steps."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from batchkit.errors import ConfigError

CHECKPOINT_KEY = "spark.checkpoint.dir"

_local_root: str | None = None


def build_session(app_name: str = "batchkit", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators rely on; entries of ``conf`` are set after them."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
    )
    if master is not None:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder named by ``spark.checkpoint.dir``.

    Tables written between two steps go here, so that every executor can read them and they outlive
    a lost executor. Only a local session may fall back to a temporary folder of its own machine.
    """
    global _local_root
    root = spark.conf.get(CHECKPOINT_KEY, None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ConfigError(f"set {CHECKPOINT_KEY} to a folder that all executors share")
        if _local_root is None:
            _local_root = tempfile.mkdtemp(prefix="batchkit-")
        root = _local_root
    return f"{root.rstrip('/')}/batchkit/{label}-{uuid.uuid4().hex}"


def land(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    Used where several results need the same intermediate table: the lineage is cut at a written
    table, so neither a retry nor a second consumer runs the work again.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
