"""Table maintenance: partition registration (K6), concatenation by name
(U1), and the migration of legacy trees.  Compaction is in ``compaction``."""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stationlake.fs import HadoopFS
from stationlake.functions.paths import hive_hour_path
from stationlake.functions.time import partition_hour_start, with_partition_values
from stationlake.operators.writer import write_hourly
from stationlake.schemas import PART_COLS, STATUS_KEYS, STATUS_SCHEMA, STATUS_TABLE_SCHEMA
from stationlake.sources.tables import read_legacy_tree

# --------------------------------------------------------------------------- U1

def union_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    """Concatenate by column name; duplicates kept, missing columns NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


# --------------------------------------------------------------------------- K6

def _quote(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _ident(name: str) -> str:
    if not re.fullmatch(r"[A-Za-z_][A-Za-z0-9_]*(\.[A-Za-z_][A-Za-z0-9_]*)?", name):
        raise ValueError(f"bad table name {name!r}")
    return name


def create_hour_table(spark: SparkSession, name: str, location: str,
                      schema: T.StructType = STATUS_TABLE_SCHEMA) -> None:
    """A catalog table over ``location`` partitioned by the hour columns."""
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {_ident(name)} ({cols}) USING parquet "
        f"PARTITIONED BY ({', '.join(PART_COLS)}) LOCATION {_quote(location)}"
    )


def register_hour_partitions(spark: SparkSession, table: str, hours: DataFrame,
                             batch: int = 500) -> int:
    """K6: ``ALTER TABLE ... ADD IF NOT EXISTS PARTITION (...) LOCATION ...``.

    ``hours`` has ``year, month, day, hour, location``.  Only hours that the
    catalog does not list are added, so a second registration issues no DDL.
    Partition specs are catalog metadata; they reach the driver one Spark
    partition at a time (``toLocalIterator``) and are added ``batch`` at a
    time, so the driver never holds the whole list.  Returns the number added.
    """
    specs = hours.select(*PART_COLS, "location").distinct()
    listed = show_partitions(spark, table).select(F.col("partition").alias("_listed"))
    absent = specs.join(listed, hive_hour_path(*PART_COLS) == F.col("_listed"), "left_anti")
    n, chunk = 0, []
    for r in absent.toLocalIterator():
        chunk.append(r)
        if len(chunk) == batch:
            _add_partitions(spark, table, chunk)
            n, chunk = n + len(chunk), []
    if chunk:
        _add_partitions(spark, table, chunk)
        n += len(chunk)
    return n


def _add_partitions(spark: SparkSession, table: str, rows) -> None:
    clauses = "\n".join(
        "PARTITION (" + ", ".join(f"{c} = {_quote(r[c])}" for c in PART_COLS) + ") "
        f"LOCATION {_quote(r['location'])}"
        for r in rows
    )
    spark.sql(f"ALTER TABLE {_ident(table)} ADD IF NOT EXISTS\n{clauses}")


def recover_partitions(spark: SparkSession, table: str) -> None:
    """Register every ``year=/month=/day=/hour=`` folder found under the table."""
    spark.sql(f"ALTER TABLE {_ident(table)} RECOVER PARTITIONS")


def show_partitions(spark: SparkSession, table: str) -> DataFrame:
    return spark.sql(f"SHOW PARTITIONS {_ident(table)}")


def file_counts(df: DataFrame) -> DataFrame:
    """Rows and files per hour partition of a table scan."""
    return df.groupBy(*PART_COLS).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.countDistinct(F.col("_metadata.file_path")).alias("n_files"),
    )


# --------------------------------------------------------------------------- legacy

def write_legacy_tree(df: DataFrame, root: str, ts_col: str, columns: Sequence[str] = STATUS_KEYS) -> None:
    """Append rows in the reference's bare ``YYYY/MM/DD/HH`` layout.

    The hours are registered (K6) with their bare folders as locations, in a
    table that exists for the write only, and Spark inserts into these
    partitions: tasks write the files and the job's commit puts them in place.
    """
    spark = df.sparkSession
    root = HadoopFS(spark, root).qualify(root).rstrip("/")
    table = f"stationlake_legacy_{uuid.uuid4().hex[:12]}"
    schema = T.StructType([df.schema[c] for c in columns] + [T.StructField(c, T.StringType()) for c in PART_COLS])
    rows = with_partition_values(df, ts_col).select(*columns, *PART_COLS)
    create_hour_table(spark, table, root, schema)
    try:
        hours = rows.select(*PART_COLS).distinct()
        register_hour_partitions(spark, table, hours.withColumn("location", F.concat_ws("/", F.lit(root), *PART_COLS)))
        rows.hint("rebalance", *PART_COLS).write.insertInto(table)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {table}")  # external: the files stay


def migrate_legacy(spark: SparkSession, legacy_root: str, root: str,
                   schema: T.StructType | None = None) -> None:
    """Copy a bare ``YYYY/MM/DD/HH`` tree into a ``year=/month=/day=/hour=``
    table, keeping each row in its hour (one Spark job, hour-routed write).
    Append-only: the legacy files are left in place."""
    schema = schema or STATUS_SCHEMA
    legacy = read_legacy_tree(spark, legacy_root, schema)
    rows = legacy.withColumn("_hour_start", partition_hour_start())
    write_hourly(rows, root, "_hour_start", [f.name for f in schema.fields])
