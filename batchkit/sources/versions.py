"""Results that are replaced as a whole: every run writes a folder of its own, and one small file names the current one.

A version is written and checked under a new name; readers do not see it until ``commit`` renames a pointer file over
the old one. A job that stops at any step before leaves the last result as it was. Versions are dropped by age, the
current one never.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import SparkSession

from batchkit.errors import MissingResultError

POINTER = "_current"
VERSIONS = "versions"


def _hadoop(spark: SparkSession):
    return spark.sparkContext._jvm.org.apache.hadoop.fs, spark.sparkContext._jsc.hadoopConfiguration()


def _path(spark: SparkSession, path: str):
    return _hadoop(spark)[0].Path(path)


def _file_system(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(_hadoop(spark)[1])


def new_version(path: str) -> str:
    """The folder a new version of the result at ``path`` is written to; its name begins with the time in nanoseconds."""
    return f"{path.rstrip('/')}/{VERSIONS}/{time.time_ns():020d}-{uuid.uuid4().hex}"


def commit(spark: SparkSession, path: str, version: str) -> None:
    """Make the version the current one. The rename is one step on file systems that have such a step."""
    folder = path.rstrip("/")
    name = version.rsplit("/", 1)[-1]
    if version != f"{folder}/{VERSIONS}/{name}" or not _file_system(spark, version).exists(_path(spark, version)):
        raise MissingResultError(f"{version} is no version of {path}")
    draft = f"{folder}/{POINTER}-{uuid.uuid4().hex}"
    stream = _file_system(spark, folder).create(_path(spark, draft), True)
    try:
        stream.write(bytearray(name.encode()))
    finally:
        stream.close()
    jvm, configuration = spark.sparkContext._jvm, _hadoop(spark)[1]
    rename = getattr(jvm, "org.apache.hadoop.fs.Options$Rename")
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    context = _hadoop(spark)[0].FileContext.getFileContext(_path(spark, folder).toUri(), configuration)
    context.rename(_path(spark, draft), _path(spark, f"{folder}/{POINTER}"), options)


def current(spark: SparkSession, path: str) -> str:
    """The folder of the current version; raises if none was committed."""
    folder = path.rstrip("/")
    pointer = _path(spark, f"{folder}/{POINTER}")
    system = _file_system(spark, folder)
    if not system.exists(pointer):
        raise MissingResultError(f"{path} has no committed result")
    stream = system.open(pointer)
    try:
        name = bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()
    return f"{folder}/{VERSIONS}/{name}"


def versions(spark: SparkSession, path: str) -> list[str]:
    """The names of all versions, the oldest first, committed or not."""
    folder = f"{path.rstrip('/')}/{VERSIONS}"
    system = _file_system(spark, folder)
    if not system.exists(_path(spark, folder)):
        return []
    return sorted(status.getPath().getName() for status in system.listStatus(_path(spark, folder)))


def drop_versions(spark: SparkSession, path: str, older_than: float) -> list[str]:
    """Delete the versions begun more than ``older_than`` seconds ago, but for the current one; returns their names.

    Choose an age beyond that of any job or reader still at work.
    """
    kept = current(spark, path).rsplit("/", 1)[-1]
    oldest = time.time_ns() - int(older_than * 1e9)
    dropped = [name for name in versions(spark, path) if name != kept and int(name.split("-")[0]) < oldest]
    for name in dropped:
        folder = f"{path.rstrip('/')}/{VERSIONS}/{name}"
        _file_system(spark, folder).delete(_path(spark, folder), True)
    return dropped
