"""Partitioned Parquet writes.

Rows are routed to ``year=/month=/day=/hour=`` folders by the UTC hour of
an ingest timestamp.  The write goes through a ``REBALANCE`` hint on the
partition columns: each hour lands in one task, so one file per hour and
task, while AQE splits an hour that is larger than the advisory partition
size (a hot hour does not become one giant task) and merges tiny hours into
shared tasks.  ``maxRecordsPerFile`` caps file size on top of that.
Spark names part files uniquely per job, which replaces the reference's
uuid file names; folders without rows are never created (F3).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationlake.fs import HadoopFS
from stationlake.functions.time import with_partition_values
from stationlake.schemas import HISTORY_KEEP, PART_COLS, STATUS_KEYS
from stationlake.sources.tables import data_files, files_under, read_table


def write_hourly(df: DataFrame, root: str, ts_col: str, columns: Sequence[str] = STATUS_KEYS,
                 mode: str = "append", max_records_per_file: int | None = None, one_hour: bool = False) -> None:
    """K1: append ``columns`` of ``df`` to the table at ``root``, routed by
    the hour of ``ts_col`` (TIMESTAMP_NTZ, UTC wall clock).  ``one_hour``:
    all rows are of one hour (a live snapshot), which needs no shuffle.

    Append only: re-running a load adds rows again (as in the reference);
    the streaming sink adds its own exactly-once bookkeeping.
    """
    out = with_partition_values(df, ts_col).select(*columns, *PART_COLS)
    if not one_hour:
        out = out.hint("rebalance", *PART_COLS)
    w = (out.write.mode(mode).partitionBy(*PART_COLS)
         .option("compression", "snappy"))
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", int(max_records_per_file))
    w.parquet(root)


def write_history(normalized: DataFrame, root: str,
                  max_records_per_file: int | None = None) -> None:
    """K2/G1: write normalised history rows by the hour of ``execution_time``.

    Only the 4 history columns are written (narrow files); readers of the
    table use the full schema and see the other columns as NULL.
    """
    write_hourly(normalized.where(F.col("execution_time").isNotNull()), root,
                 "execution_time", HISTORY_KEEP, max_records_per_file=max_records_per_file)


def publish_staged(spark, staging: str, root: str) -> int:
    """Move the files of a staged hourly write into the table at ``root``.

    Hours the table does not have yet get the whole staged hour folder
    renamed in (one rename per hour); hours it has get their files renamed
    one by one.  Both are repeatable: what was moved is gone from staging.
    A folder nested because an hour appeared concurrently is flattened.
    Returns the number of files published.
    """
    fs = HadoopFS(spark, root)
    root = fs.qualify(root).rstrip("/")
    staging = fs.qualify(staging).rstrip("/")
    if not fs.exists(staging):
        return 0
    staged: dict[str, list[str]] = {}
    for f in data_files(read_table(spark, staging)):
        rel_hour, name = f[len(staging) + 1:].rsplit("/", 1)
        staged.setdefault(rel_hour, []).append(name)
    if not staged:
        return 0
    days = sorted({h.rsplit("/", 1)[0] for h in staged})
    # Hour folders that exist, with or without files (registering a
    # partition creates an empty one): at most 24 names per touched day.
    present = {h[len(root) + 1:] for d in days for h in fs.glob_dirs(f"{root}/{d}/hour=*")}
    for d in days:
        fs.mkdirs(f"{root}/{d}")
    file_moves, dir_moves = [], []
    for h, names in staged.items():
        if h in present:
            file_moves += [(f"{staging}/{h}/{n}", f"{root}/{h}/{n}") for n in names]
        else:
            dir_moves.append((f"{staging}/{h}", f"{root}/{h}"))
    fs.move_many(file_moves, make_parents=False)
    fs.rename_many(dir_moves)
    # An hour folder created between the check above and the rename gets the
    # staged folder nested inside it: move those files up, drop the folder.
    nested, nested_dirs = [], set()
    for f in files_under(spark, [dst for _, dst in dir_moves]):
        parent, name = f.rsplit("/", 1)
        hour_dir, last = parent.rsplit("/", 1)
        if last.startswith("hour=") and hour_dir.rsplit("/", 1)[1].startswith("hour="):
            nested.append((f, f"{hour_dir}/{name}"))
            nested_dirs.add(parent)
    fs.move_many(nested)
    for d in nested_dirs:
        fs.delete(d)
    # Nothing may be deleted or recorded before every staged file stands in the table.
    there = set(files_under(spark, [f"{root}/{h}" for h in staged]))
    lost = [f"{root}/{h}/{n}" for h, names in staged.items() for n in names if f"{root}/{h}/{n}" not in there]
    if lost:
        raise OSError(f"{len(lost)} staged files are not in the table, among them {lost[0]}")
    return sum(len(v) for v in staged.values())
