"""History CSV -> status rows.

A history file is ``|``-separated with a header; the columns of *each file*
are matched by name, so files may differ in order and in extra columns.  Spark
splits the files into input splits, which replaces the reference's
1,000,000-row chunks; nothing is held whole in memory.
"""

from __future__ import annotations

import csv

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stationlake.functions.casts import strict_cast
from stationlake.functions.time import as_of_column, epoch_seconds, parse_ts, partition_key
from stationlake.schemas import HISTORY_KEEP, HISTORY_RENAMES

# The types the history columns are cast to.
HISTORY_TYPES = {
    "station_id": "string",
    "num_bikes_available": "bigint",
    "num_docks_available": "bigint",
}


#: The raw columns every file must have.
HISTORY_REQUIRED = ("execution_time", *HISTORY_RENAMES)
#: Distinct headers that one read may have, and files with another header than
#: the first one that are broadcast (about 20 MB of paths).
MAX_HEADERS, BROADCAST_FILES = 100, 100_000


def header_index(spark: SparkSession, path, required=HISTORY_REQUIRED) -> DataFrame:
    """(file, header, n_headers, n_lines): the header line of every file.

    One text scan, aggregated by file: the header is the line, in a file's
    first block, that holds all required names.  ``header`` is NULL where
    there is none; ``n_headers`` counts different ones.
    """
    line = F.col("value")
    is_header = F.col("_metadata.file_block_start") == 0
    for name in required:
        is_header = is_header & line.contains(name)
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.when(is_header, line).alias("header"))
    return lines.groupBy("file").agg(F.min("header").alias("header"), F.max("header").alias("last"), F.count("*").alias("n_lines"))


def _columns(header: str, sep: str) -> list[str]:
    return [c.strip() for c in next(csv.reader([header], delimiter=sep))]


def read_history(spark: SparkSession, path, sep: str = "|", required=HISTORY_REQUIRED) -> DataFrame:
    """S3: every column as STRING, by the names in each file's own header.

    The headers are indexed first; the files are then scanned once, by
    position, and each row's values are put under the names of its file's
    header.  Columns that only some files have are NULL in the others; a file
    that lacks a required column, or has two headers, raises.  Where all files
    have one header, the scan is that of plain CSV.
    """
    index = header_index(spark, path, required)
    bad = index.where("header IS NULL OR header <> last").select("file").head()
    if bad:
        raise ValueError(f"not one header with the columns {', '.join(required)}: {bad['file']}")
    groups = index.groupBy("header").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "header").limit(MAX_HEADERS + 1).collect()
    if len(groups) > MAX_HEADERS:
        raise ValueError(f"more than {MAX_HEADERS} different headers below {path}")
    headers = [_columns(r["header"], sep) for r in groups]
    for columns in headers:
        lacking = [c for c in required if c not in columns]
        if lacking or len(set(columns)) < len(columns):
            raise ValueError(f"history header {columns} lacks or repeats columns: {lacking or columns}")
    if not headers:
        return spark.createDataFrame([], ", ".join(f"`{c}` string" for c in required))

    def scan(names: list[str]) -> DataFrame:
        schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
        return spark.read.option("sep", sep).option("header", True).schema(schema).csv(path)

    if len(headers) == 1:
        return scan(headers[0])
    width, names = max(map(len, headers)), list(dict.fromkeys(c for columns in headers for c in columns))
    # The most frequent header needs no entry: a row without one has it.
    kind = F.array_position(F.array(*(F.lit(r["header"]) for r in groups)), F.col("header")) - 1
    others = index.select(F.col("file").alias("_file"), kind.cast("int").alias("_kind")).where("_kind > 0")
    if sum(r["n"] for r in groups[1:]) <= BROADCAST_FILES:
        others = F.broadcast(others)
    rows = scan([f"_c{k}" for k in range(width)]).withColumn("_file", F.col("_metadata.file_path")).join(others, "_file", "left")

    def value(name: str) -> str:
        cases = " ".join(f"WHEN {k} THEN _c{columns.index(name)}" for k, columns in enumerate(headers) if name in columns)
        return f"CASE coalesce(_kind, 0) {cases} END AS `{name}`"
    return rows.selectExpr(*map(value, names))


def normalize_history(raw: DataFrame, cutoff=None) -> DataFrame:
    """P4-P6, X1, X2, X4, F1.

    rename by map -> ANSI cast (a non-numeric count raises; an empty field
    stays NULL) -> ``last_reported`` in unix seconds (NULL time -> NULL) ->
    ``execution_time`` parsed -> ``partition_key`` ``yyyy-MM-dd HH`` ->
    strict cutoff ``execution_time < cutoff`` (NULL times drop out).
    """
    missing = [c for c in ("execution_time", *HISTORY_RENAMES) if c not in raw.columns]
    if missing:
        raise ValueError(f"history file lacks columns: {missing}")
    df = raw.withColumnsRenamed(HISTORY_RENAMES)
    df = df.select(
        parse_ts("execution_time").alias("execution_time"),
        *[F.expr(strict_cast(f"`{c}`", t)).alias(c) for c, t in HISTORY_TYPES.items()],
        epoch_seconds(parse_ts("last_reported")).alias("last_reported"),
    )
    df = df.select("execution_time", *HISTORY_KEEP)
    if cutoff is not None:
        df = df.where(F.col("execution_time") < as_of_column(cutoff))
    else:
        df = df.where(F.col("execution_time").isNotNull())
    return df.withColumn("partition_key", partition_key("execution_time"))
