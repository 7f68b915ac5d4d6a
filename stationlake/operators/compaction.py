"""Compaction (K3) and the trash (K4).

A run plans by bytes: the files of each hour are put into bins of at most
``target_bytes`` (first fit, largest first), and only bins of several files
are rewritten, each as one file; an hour at its least number of files is
left alone.  One Spark job rewrites all bins of the run.  Old files are then
moved, one by one, to the trash, and the new ones into their hours; a
journal lists these moves, so an interrupted run is finished by the next.
Finished journals are the trash's manifest: a row per retired file, from
which a run can be undone (:func:`restore_run`) or its old files deleted
(:func:`purge_trash`).  Runs hold the table's lease; appends do not need it.
"""

from __future__ import annotations

import datetime as dt
import json
import re
import uuid
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stationlake.fs import HadoopFS, canon
from stationlake.functions.paths import TRASH_DIR, trash_path_py
from stationlake.operators.lease import LEASE_SECONDS, LeaseLost, TableLease
from stationlake.schemas import PART_COLS, STATUS_TABLE_SCHEMA
from stationlake.sources.tables import read_table

# Object stores keep trash under ``bucket/trash/...``; other file systems, and
# tables that are a whole bucket, get a ``_trash`` folder inside the table
# root (ignored by readers).
_BUCKET_SCHEMES = ("s3", "s3a", "s3n", "gs", "abfs", "abfss", "wasb", "wasbs", "oss")

#: Bytes of a compacted file; days compacted per Spark job and journal (this
#: bounds the file lists the driver holds).
TARGET_BYTES, DAYS_PER_JOB = 128 << 20, 31
#: Planned files up to this many are broadcast to the job that rewrites them (about 10 MB).
BROADCAST_FILES = 100_000

# A compacted file carries the bytes of the files it was made of, so that a
# later plan weighs it as this one did, however well it compressed.
_COMPACTED = re.compile(r"^compact-[0-9a-f]+-\d+-w(\d+)\.parquet$")


# -- the trash's place -----------------------------------------------------

def _relative(path: str, root: str) -> str:
    root = root.rstrip("/") + "/"
    if not path.startswith(root):
        raise ValueError(f"{path} is not under {root}")
    return path[len(root):]


def trash_dir(root: str, trash_root: str | None = None) -> str:
    """Trash folder of a table: ``trash_root``, else ``bucket/trash/<table
    key>`` on object stores, else ``<root>/_trash``."""
    if trash_root:
        return trash_root.rstrip("/")
    root = root.rstrip("/")
    scheme, _, rest = root.partition("://")
    if rest and scheme.lower() in _BUCKET_SCHEMES and "/" in rest:
        return trash_path_py(root).rstrip("/")
    return f"{root}/_{TRASH_DIR}"


def trash_location(path: str, root: str, trash_root: str | None = None) -> str:
    """Where a retired file goes (K4): its path below the table's trash folder."""
    return f"{trash_dir(root, trash_root)}/{_relative(path, root)}"


# -- files and the plan ----------------------------------------------------

@dataclass(frozen=True)
class DataFile:
    hour: str    # the hour's path below the table root
    name: str
    size: int

    @property
    def weight(self) -> int:
        m = _COMPACTED.match(self.name)
        return int(m.group(1)) if m else self.size


def _day_dir(root: str, d: dt.date) -> str:
    return f"{root}/year={d.year:04d}/month={d.month:02d}/day={d.day:02d}"


def list_days(spark: SparkSession, root: str) -> list[dt.date]:
    """The days that have folders in a ``year=/month=/day=`` table (listing only)."""
    fs = HadoopFS(spark, root)
    days = []
    for d in fs.glob_dirs(f"{root.rstrip('/')}/year=*/month=*/day=*"):
        m = re.search(r"year=(\d{4})/month=(\d{2})/day=(\d{2})$", d)
        if m:
            days.append(dt.date(int(m.group(1)), int(m.group(2)), int(m.group(3))))
    return days


def _day_dirs(spark: SparkSession, root: str, days: Iterable[dt.date]) -> list[str]:
    fs = HadoopFS(spark, root)
    return [p for p in (_day_dir(root, d) for d in sorted(set(days))) if fs.exists(p)]


def read_days(spark: SparkSession, root: str, days: Iterable[dt.date],
              schema: T.StructType = STATUS_TABLE_SCHEMA) -> DataFrame | None:
    """The given days of a table.  Only those day folders are listed, by
    Spark's file index; the listing is fixed when the DataFrame is created."""
    dirs = _day_dirs(spark, root, days)
    return spark.read.schema(schema).option("basePath", root).parquet(*dirs) if dirs else None


def sized_files(spark: SparkSession, dirs: list[str]) -> list[tuple[str, int]]:
    """(path, bytes) of the Parquet files below ``dirs`` (folders that exist);
    listed by Spark, no file is opened."""
    if not dirs:
        return []
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", True)
             .option("pathGlobFilter", "*.parquet").load(dirs))
    return sorted((canon(r["path"]), r["length"]) for r in files.select("path", "length").collect())


def plan_bins(files: Iterable[DataFile], target_bytes: int) -> list[list[DataFile]]:
    """The bins of one hour that are to be rewritten.

    First fit, largest first.  A bin's file weighs what the bin weighed and no
    two bins fit into one, so a plan over its own result is empty.
    """
    bins: list[list[DataFile]] = []
    room: list[int] = []
    for f in sorted(files, key=lambda f: (-f.weight, f.name)):
        k = next((k for k, r in enumerate(room) if f.weight <= r), -1)
        if k < 0:
            bins.append([])
            room.append(max(target_bytes, f.weight))
        bins[k].append(f)
        room[k] -= f.weight
    return [b for b in bins if len(b) > 1]


# -- compaction ------------------------------------------------------------

def compact_days(spark: SparkSession, root: str, days: Iterable[dt.date],
                 schema: T.StructType = STATUS_TABLE_SCHEMA, trash_root: str | None = None,
                 target_bytes: int = TARGET_BYTES, days_per_job: int = DAYS_PER_JOB,
                 lease_seconds: float = LEASE_SECONDS) -> dict:
    """K3 + K4 over any number of days, ``days_per_job`` days per run of
    :func:`compact_run` (each a complete, recoverable compaction)."""
    days = sorted(set(days))
    total = {"hours": 0, "files_before": 0, "files_after": 0, "rows": 0}
    for i in range(0, len(days), max(1, days_per_job)):
        rep = compact_run(spark, root, days[i:i + days_per_job], schema, trash_root, target_bytes, lease_seconds)
        for k in total:
            total[k] += rep[k]
    return total


def compact_run(spark: SparkSession, root: str, days: Iterable[dt.date],
                schema: T.StructType = STATUS_TABLE_SCHEMA, trash_root: str | None = None,
                target_bytes: int = TARGET_BYTES, lease_seconds: float = LEASE_SECONDS) -> dict:
    """K3 + K4: one compaction of ``days``, all rows kept.

    Safe order (the reference writes the new file next to the old ones and
    then moves those, so a crash in between leaves duplicates):

    1. take the lease; finish the journals of interrupted runs;
    2. list the days' files with their bytes and plan; files that arrive
       later are in no bin and are not touched;
    3. rewrite the bins to ``_staging/<run>`` in one job, counting rows on the
       way (``observe``), and compare with the staged files' rows;
    4. check the lease, write the journal, check the lease again, and make
       the journal's moves.  Readers see a short gap in an hour, never rows
       twice.

    A run whose lease was taken over before step 4's last check leaves the
    table as it is and raises LeaseLost; afterwards, it and the run that took
    over make the same moves, each of which can be repeated.
    """
    fs = HadoopFS(spark, root)
    root = fs.qualify(root).rstrip("/")
    with TableLease(fs, root, lease_seconds) as lease:
        _finish_journals(fs, root)
        run = f"{lease.number:010d}-{uuid.uuid4().hex[:12]}"
        return _compact(spark, fs, root, days, schema, trash_root, target_bytes, lease, run)


def _compact(spark, fs, root, days, schema, trash_root, target_bytes, lease, run) -> dict:
    report = {"hours": 0, "files_before": 0, "files_after": 0, "rows": 0}
    by_hour: dict[str, list[DataFile]] = {}
    for path, size in sized_files(spark, _day_dirs(spark, root, days)):
        hour, name = _relative(path, root).rsplit("/", 1)
        if hour.count("/") == 3:
            by_hour.setdefault(hour, []).append(DataFile(hour, name, size))
    bins = {(hour, k): b for hour, files in by_hour.items() for k, b in enumerate(plan_bins(files, target_bytes))}
    if not bins:
        return report

    staging = f"{root}/_staging/compact-{run}"
    rows = _rewrite(spark, root, days, schema, bins, staging, target_bytes, run)
    staged = [p for p, _ in sized_files(spark, [staging])]
    n_new = spark.read.schema(schema).option("basePath", staging).parquet(staging).count()
    if n_new != rows or len(staged) != len(bins):
        fs.delete(staging)
        raise RuntimeError(f"compaction {run}: {rows} rows in {len(bins)} bins were read, {n_new} rows in {len(staged)} files staged")

    moves = [{"run": run, "kind": "retired", "source": f"{root}/{f.hour}/{f.name}",
              "target": trash_location(f"{root}/{f.hour}/{f.name}", root, trash_root), "bytes": f.size}
             for b in bins.values() for f in b]
    for path in staged:
        hour, bin_dir, _ = _relative(path, staging).rsplit("/", 2)
        k = int(bin_dir.split("=", 1)[1])
        weight = sum(f.weight for f in bins[hour, k])
        moves.append({"run": run, "kind": "published", "source": path, "bytes": weight,
                      "target": f"{root}/{hour}/compact-{run.rsplit('-', 1)[1]}-{k}-w{weight}.parquet"})
    journal = f"{root}/_compaction/journal/{run}.json"
    try:
        lease.check()
        fs.write_text(journal, "".join(json.dumps(m) + "\n" for m in moves))
        lease.check()
    except LeaseLost:
        fs.delete(journal, recursive=False)
        fs.delete(staging)
        raise
    _finish(fs, root, journal, moves)
    report.update(hours=len({h for h, _ in bins}), files_before=len(moves) - len(staged), files_after=len(staged), rows=rows)
    return report


def _rewrite(spark, root, days, schema, bins, staging, target_bytes, run) -> int:
    """One job: the rows of the planned files, one staged file per bin."""
    plan = [(*(s.split("=", 1)[1] for s in hour.split("/")), f.name, k) for (hour, k), b in bins.items() for f in b]
    key = [*PART_COLS, "_file"]
    planned = spark.createDataFrame(plan, T.StructType([T.StructField(c, T.StringType()) for c in key] + [T.StructField("bin", T.IntegerType())]))
    if len(plan) <= BROADCAST_FILES:
        planned = F.broadcast(planned)
    rows = read_days(spark, root, days, schema).withColumn("_file", F.col("_metadata.file_name")).join(planned, key).drop("_file")
    n_bytes = sum(f.weight for b in bins.values() for f in b)
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), n_bytes // target_bytes)
    obs = Observation(f"compact_{run}")
    # Counted after the shuffle, in the writing (result) tasks: a result
    # partition's metrics are applied once even when tasks are retried or
    # map output is recomputed after an executor loss.
    (rows.repartition(parts, *PART_COLS, "bin").observe(obs, F.count(F.lit(1)).alias("rows"))
     .write.mode("errorifexists").partitionBy(*PART_COLS, "bin").option("compression", "snappy").parquet(staging))
    return obs.get["rows"]


# -- journals and the manifest ---------------------------------------------

_RESTORE = "-restore.json"
_MANIFEST = "run string, kind string, source string, target string, bytes bigint"


def _moves(fs: HadoopFS, journal: str) -> list[dict]:
    return [json.loads(line) for line in fs.read_text(journal).split("\n") if line]


def _finish(fs: HadoopFS, root: str, journal: str, moves: list[dict] | None = None) -> None:
    """Make a journal's moves, old files first; every step can be repeated,
    also by two runs at once."""
    moves = moves or _moves(fs, journal)
    for kind in ("retired", "published"):
        fs.move_many([(m["source"], m["target"]) for m in moves if m["kind"] == kind])
    name, log = journal.rsplit("/", 1)[1], f"{root}/_compaction"
    if name.endswith(_RESTORE):  # the run's files are no longer in the trash
        run = name.removesuffix(_RESTORE)
        fs.move(f"{log}/manifest/{run}.json", f"{log}/restored/{run}.json")
        fs.move(journal, f"{log}/restored/{name}")
    else:
        fs.move(journal, f"{log}/manifest/{name}")
        fs.delete(f"{root}/_staging/compact-{name.removesuffix('.json')}")


def _finish_journals(fs: HadoopFS, root: str) -> int:
    journals = [j for j in fs.list_dir(f"{root}/_compaction/journal") if j.endswith(".json")]
    for journal in journals:
        _finish(fs, root, journal)
    return len(journals)


def recover_compactions(spark: SparkSession, root: str, lease_seconds: float = LEASE_SECONDS) -> int:
    """Finish interrupted compactions; raises LeaseHeld while another run is at work."""
    fs = HadoopFS(spark, root)
    root = fs.qualify(root).rstrip("/")
    with TableLease(fs, root, lease_seconds):
        return _finish_journals(fs, root)


def trash_manifest(spark: SparkSession, root: str) -> DataFrame:
    """(run, path, trash_path, bytes): every file that compactions have
    retired and neither restored nor purged."""
    fs = HadoopFS(spark, root)
    folder = f"{fs.qualify(root).rstrip('/')}/_compaction/manifest"
    if not fs.list_dir(folder):
        return spark.createDataFrame([], "run string, path string, trash_path string, bytes bigint")
    return (spark.read.schema(_MANIFEST).json(f"{folder}/*.json").where("kind = 'retired'")
            .select("run", F.col("source").alias("path"), F.col("target").alias("trash_path"), "bytes"))


def restore_run(spark: SparkSession, root: str, run: str, trash_root: str | None = None,
                lease_seconds: float = LEASE_SECONDS) -> int:
    """Undo one compaction: its files go to the trash, the old ones come back.

    Needs the run's files to be in the table still (later compactions of them
    are undone first).  Returns the number of files brought back.
    """
    fs = HadoopFS(spark, root)
    root = fs.qualify(root).rstrip("/")
    with TableLease(fs, root, lease_seconds) as lease:
        _finish_journals(fs, root)
        manifest = f"{root}/_compaction/manifest/{run}.json"
        if not fs.exists(manifest):
            raise ValueError(f"no compaction {run} to restore")
        moves = _moves(fs, manifest)
        lost = [m["target"] for m in moves if not fs.exists(m["target"])]
        if lost:
            raise ValueError(f"{len(lost)} files of {run} are no longer in their place, among them {lost[0]}")
        back = [{"run": run, "kind": "retired", "source": m["target"], "bytes": m["bytes"],
                 "target": trash_location(m["target"], root, trash_root)} for m in moves if m["kind"] == "published"]
        back += [{"run": run, "kind": "published", "source": m["target"], "target": m["source"], "bytes": m["bytes"]}
                 for m in moves if m["kind"] == "retired"]
        journal = f"{root}/_compaction/journal/{run}{_RESTORE}"
        lease.check()
        fs.write_text(journal, "".join(json.dumps(m) + "\n" for m in back))
        _finish(fs, root, journal)
        return sum(m["kind"] == "published" for m in back)


def purge_trash(spark: SparkSession, root: str, before_run: str | None = None,
                lease_seconds: float = LEASE_SECONDS) -> int:
    """Delete for good what runs before ``before_run`` (default: all), and
    their restorations, retired.  Run names grow with time.  Returns the
    number of files deleted."""
    fs = HadoopFS(spark, root)
    root = fs.qualify(root).rstrip("/")
    n = 0
    with TableLease(fs, root, lease_seconds):
        _finish_journals(fs, root)
        logs = fs.list_dir(f"{root}/_compaction/manifest") + fs.list_dir(f"{root}/_compaction/restored")
        for manifest in logs:
            name = manifest.rsplit("/", 1)[1]
            if not name.endswith(".json") or (before_run and name >= f"{before_run}.json"):
                continue
            if "/restored/" in manifest and not name.endswith(_RESTORE):  # its old files are in the table again
                fs.move(manifest, f"{root}/_compaction/purged/{name}")
                continue
            old = [m["target"] for m in _moves(fs, manifest) if m["kind"] == "retired"]
            for path in old:
                fs.delete(path, recursive=False)
            fs.move(manifest, f"{root}/_compaction/purged/{name}")
            n += len(old)
    return n


def compact_yesterday(spark: SparkSession, root: str, as_of: dt.datetime | None = None, **kw) -> dict:
    """the reference's daily job - the 24 hours of the UTC day before ``as_of``."""
    now = as_of or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    return compact_days(spark, root, [now.date() - dt.timedelta(days=1)], **kw)
