"""Table scans (S4, S5, legacy trees).

Every scan passes an explicit schema: partition columns stay zero-padded
strings, narrow files (backfill, 4 columns) read their absent columns as
NULL, and stray columns some writers add are dropped.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stationlake.fs import HadoopFS, canon
from stationlake.schemas import PART_COLS, STATUS_SCHEMA, STATUS_TABLE_SCHEMA

# Legacy bare layout ``.../YYYY/MM/DD/HH/<file>``.
_LEGACY_RE = r"/(\d{4})/(\d{2})/(\d{2})/(\d{2})/[^/]+$"


def read_table(spark: SparkSession, root: str,
               schema: T.StructType = STATUS_TABLE_SCHEMA) -> DataFrame:
    """A ``year=/month=/day=/hour=`` table.  Filters on the partition
    columns prune folders before any file is opened."""
    return spark.read.schema(schema).parquet(root)


def window_day_dirs(spark: SparkSession, root: str, start: dt.date, bare: bool = False) -> list[str]:
    """Day folders dated on or after ``start``, of a ``year=/month=/day=``
    table or (``bare``) of a ``YYYY/MM/DD`` tree.

    Lists folder names level by level (years, then months of the remaining
    years, then days of the remaining months), never the files of other days:
    the cost follows the window, not the age of the table.
    """
    fs = HadoopFS(spark, root)
    root = fs.qualify(root).rstrip("/")

    def values(parent: str, key: str) -> list[tuple[int, str]]:
        out = []
        for d in fs.glob_dirs(f"{parent}/*" if bare else f"{parent}/{key}=*"):
            v = d.rsplit("/" if bare else "=", 1)[1]
            if v.isdigit() and (not bare or len(v) == (4 if key == "year" else 2)):
                out.append((int(v), d))
        return out

    days = []
    for y, ydir in values(root, "year"):
        if y < start.year:
            continue
        for m, mdir in values(ydir, "month"):
            if (y, m) < (start.year, start.month):
                continue
            for d, ddir in values(mdir, "day"):
                if (y, m, d) >= (start.year, start.month, start.day):
                    days.append(ddir)
    return sorted(days)


def _window_start(as_of, days: int) -> dt.date:
    """The first date that a trailing window of ``days`` can need (None = now, UTC)."""
    if as_of is None:
        as_of = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    if isinstance(as_of, str):
        as_of = dt.datetime.fromisoformat(as_of)
    if not isinstance(as_of, dt.datetime):  # a date: its midnight
        as_of = dt.datetime.combine(as_of, dt.time())
    if as_of.tzinfo is not None:
        as_of = as_of.astimezone(dt.timezone.utc).replace(tzinfo=None)
    return (as_of - dt.timedelta(days=days)).date()


def read_recent(spark: SparkSession, root: str, as_of=None, days: int = 8,
                schema: T.StructType = STATUS_TABLE_SCHEMA) -> DataFrame:
    """S5 for a path-based table: read only the day folders a trailing
    window can need (dated after ``as_of - days``, later dates included).

    ``as_of`` must be known on the driver here (None = now, UTC).  The
    window predicate itself is applied by the caller (``recent_status``),
    so the result is the same as over the whole table.
    """
    dirs = window_day_dirs(spark, root, _window_start(as_of, days))
    if not dirs:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", root).parquet(*dirs)


def _legacy_rows(spark: SparkSession, paths: list[str], schema: T.StructType) -> DataFrame:
    df = (spark.read.schema(schema).option("recursiveFileLookup", True)
          .option("pathGlobFilter", "*.parquet").parquet(*paths))
    path = F.col("_metadata.file_path")
    parts = [F.regexp_extract(path, _LEGACY_RE, i + 1).alias(c) for i, c in enumerate(PART_COLS)]
    return df.where(path.rlike(_LEGACY_RE)).select(*[F.col(f.name) for f in schema.fields], *parts)


def read_legacy_tree(spark: SparkSession, root: str,
                     schema: T.StructType = STATUS_SCHEMA) -> DataFrame:
    """A bare ``YYYY/MM/DD/HH`` tree as a table with partition columns.

    Partition values come from each file's path (``_metadata.file_path``);
    files in other places are no part of the table.  All folders are listed:
    see :func:`read_legacy_recent` for a trailing window.
    """
    return _legacy_rows(spark, [root], schema)


def read_legacy_recent(spark: SparkSession, root: str, as_of=None, days: int = 8,
                       schema: T.StructType = STATUS_SCHEMA) -> DataFrame:
    """The part of a bare tree that a trailing window can need: only its day
    folders are listed and read.  The window predicate itself is applied by
    the caller (``recent_status``), as for :func:`read_recent`."""
    dirs = window_day_dirs(spark, root, _window_start(as_of, days), bare=True)
    if not dirs:
        return spark.createDataFrame([], T.StructType([*schema.fields, *(T.StructField(c, T.StringType()) for c in PART_COLS)]))
    return _legacy_rows(spark, dirs, schema)


def data_files(df: DataFrame) -> list[str]:
    """Files behind a file-based DataFrame, from Spark's own listing (one
    call into the JVM, parallel listing for many folders)."""
    return sorted(canon(f) for f in df.inputFiles())


def files_under(spark: SparkSession, roots: list[str]) -> list[str]:
    """Data files below ``roots`` (recursive), through Spark's file index:
    one call into the JVM; up to 32 roots are listed on the driver without
    a job, more in a parallel listing job.  Missing roots are skipped."""
    if not roots:
        return []
    fs = HadoopFS(spark, roots[0])
    existing = [r for r in roots if fs.exists(r)]
    if not existing:
        return []
    df = (spark.read.schema("x int").option("recursiveFileLookup", True)
          .format("parquet").load(existing))
    return data_files(df)
