"""The published result cache (K5, S6), always readable while it is replaced.

A cache is a folder of versions and pointers:

    <path>/versions/<number>-<id>/part-*.csv    complete with ``_SUCCESS``
    <path>/pointers/<number>-<id>               an empty file

Version numbers grow with time.  A publisher writes a new version and then
creates its pointer; the reader takes the version of the highest pointer.
A pointer is one small file that appears whole, nothing a reader may hold
is renamed, and a version goes only when it is neither among the newest
``keep`` nor younger than ``grace_seconds``.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from stationlake.fs import HadoopFS
from stationlake.schemas import CACHE_SCHEMA

#: Versions that stay, and seconds that a replaced version stays for its readers.
KEEP_VERSIONS, GRACE_SECONDS = 3, 3600
_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"


def _names(fs: HadoopFS, folder: str) -> list[str]:
    """Names ``<number>-<id>`` in order of time."""
    return sorted(p.rsplit("/", 1)[1] for p in fs.list_dir(folder) if p.rsplit("/", 1)[1].split("-", 1)[0].isdigit())


def _complete(fs: HadoopFS, path: str, name: str) -> bool:
    return fs.exists(f"{path}/versions/{name}/_SUCCESS")


def current_version(spark: SparkSession, path: str) -> str | None:
    """The folder of the newest published version."""
    fs = HadoopFS(spark, path)
    path = fs.qualify(path).rstrip("/")
    pointers = _names(fs, f"{path}/pointers")
    return f"{path}/versions/{pointers[-1]}" if pointers else None


def publish_cache(df: DataFrame, path: str, keep: int = KEEP_VERSIONS, grace_seconds: float = GRACE_SECONDS) -> str:
    """K5: publish a result as the CSV cache, replacing the previous version.

    The cache is a folder of part files (no single-task ``coalesce(1)``).
    Publishers at the same time each make a version; the one of the higher
    number stays current.  Returns the version's folder.
    """
    spark = df.sparkSession
    fs = HadoopFS(spark, path)
    path = fs.qualify(path).rstrip("/")
    versions = _names(fs, f"{path}/versions")
    number = int(versions[-1].split("-", 1)[0]) + 1 if versions else 1
    name = f"{number:012d}-{time.time_ns() // 10**6:013d}-{uuid.uuid4().hex[:12]}"
    (df.write.mode("errorifexists").option("header", True).option("timestampNTZFormat", _TIME_FORMAT)
     .csv(f"{path}/versions/{name}"))
    fs.mkdirs(f"{path}/pointers")
    fs.create_new(f"{path}/pointers/{name}", "")
    _drop_old(fs, path, keep, grace_seconds)
    return f"{path}/versions/{name}"


def _drop_old(fs: HadoopFS, path: str, keep: int, grace_seconds: float) -> None:
    """Pointers go before their versions.  What is without pointer may still be
    being written: it goes once it is old and not newer than the current one."""
    young = (time.time() - grace_seconds) * 1000
    pointers = _names(fs, f"{path}/pointers")
    # A version was current until its successor's time: that is when it was replaced.
    replaced = {name: int(after.split("-")[1]) for name, after in zip(pointers, pointers[1:])}
    gone = [p for p in pointers[:-max(1, keep)] if replaced[p] <= young]
    for name in gone:
        fs.delete(f"{path}/pointers/{name}", recursive=False)
    left = set(pointers) - set(gone)
    for name in _names(fs, f"{path}/versions"):
        if name not in left and (name in gone or (int(name.split("-")[1]) <= young and name < pointers[-1])):
            fs.delete(f"{path}/versions/{name}")


def recover_cache(spark: SparkSession, path: str) -> bool:
    """Finish a publish that stopped before its pointer: if the newest complete
    version has none, it gets one.  Returns whether it did."""
    fs = HadoopFS(spark, path)
    path = fs.qualify(path).rstrip("/")
    pointers = _names(fs, f"{path}/pointers")
    for name in reversed(_names(fs, f"{path}/versions")):
        if pointers and name <= pointers[-1]:
            return False
        if _complete(fs, path, name):
            fs.mkdirs(f"{path}/pointers")
            return fs.create_new(f"{path}/pointers/{name}", "")
    return False


def read_cache(spark: SparkSession, path: str, schema: T.StructType = CACHE_SCHEMA) -> DataFrame:
    """The published result cache (CSV with header, explicit schema).

    The version is fixed when the DataFrame is made.  A path without pointers
    is read as plain CSV files.
    """
    return (spark.read.schema(schema).option("header", True).option("timestampNTZFormat", _TIME_FORMAT)
            .option("mode", "FAILFAST").csv(current_version(spark, path) or path))
