"""Calls with effects, made once per key (G3): a ledger of finished calls.

``call_each`` makes one call per distinct key, in tasks, and records it in
the ledger table: JSON lines ``(key, result)`` below ``<ledger>/run=<run>``.
Keys that the ledger already has are left out by an anti-join, so a repeated
job makes only the calls that are missing.  Within a job a task makes its
calls in batches of a few at a time and writes a batch's record, whole, as
soon as the batch is done; a retried or speculative attempt finds the record
under the batch's name and calls nothing again.  Only calls of a batch that
was under way when its executor was lost can be repeated.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationlake.fs import HadoopFS
from stationlake.session import ship_package

#: Calls that a task makes at the same time; they are recorded together.
CONCURRENCY = 8
_RECORD = "key string, result string"


def _store(path: str):
    """(file system, path there) of a shared folder, in a task."""
    from pyarrow import fs

    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[len("file:"):].lstrip("/")
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


class RunLedger:
    """The records of one run, as a task reads and writes them."""

    def __init__(self, folder: str):
        self.fs, self.folder = _store(folder)

    def batch(self, keys: list[str]) -> str:
        return hashlib.sha256(json.dumps(keys).encode()).hexdigest()[:32]

    def find(self, name: str) -> list[dict] | None:
        from pyarrow import fs

        path = f"{self.folder}/{name}.json"
        if self.fs.get_file_info(path).type == fs.FileType.NotFound:
            return None
        with self.fs.open_input_stream(path) as f:
            return [json.loads(line) for line in f.read().decode().splitlines()]

    def record(self, name: str, rows: list[dict]) -> None:
        """Readers see the record whole or not at all."""
        self.fs.create_dir(self.folder, recursive=True)
        part = f"{self.folder}/_{name}-{uuid.uuid4().hex}"
        with self.fs.open_output_stream(part) as f:
            f.write("".join(json.dumps(r) + "\n" for r in rows).encode())
        self.fs.move(part, f"{self.folder}/{name}.json")


def _caller(call: Callable[[str], str], folder: str, concurrency: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ledger = RunLedger(folder)
        with ThreadPoolExecutor(max_workers=concurrency) as pool:
            for arrow in batches:
                keys = arrow.column("key").to_pylist()
                for at in range(0, len(keys), concurrency):
                    now = keys[at:at + concurrency]
                    name = ledger.batch(now)
                    rows = ledger.find(name)
                    if rows is None:
                        rows = [{"key": k, "result": r} for k, r in zip(now, pool.map(call, now))]
                        ledger.record(name, rows)
                    yield pa.RecordBatch.from_pylist([{"n": len(rows)}], pa.schema([("n", pa.int64())]))
    return run


def finished_calls(spark: SparkSession, ledger: str, run: str) -> DataFrame:
    """(key, result) of every recorded call of a run."""
    folder = f"{ledger.rstrip('/')}/run={run}"
    if not HadoopFS(spark, folder).list_dir(folder):
        return spark.createDataFrame([], _RECORD)
    # A batch that two attempts recorded at once has one record; keys that a
    # repeated job dealt into another batch are still called once.
    return spark.read.schema(_RECORD).json(f"{folder}/*.json").dropDuplicates(["key"])


def call_each(df: DataFrame, call: Callable[[str], str], ledger: str, run: str, key: str = "station_id",
              concurrency: int = CONCURRENCY, parallelism: int | None = None) -> DataFrame:
    """One ``call(key) -> result`` per distinct key of ``df`` that the ledger
    does not have for ``run`` yet; (``key``, result) of all calls of the run.

    The calls are made here, not when the result is read: reading it twice
    calls nothing.  A call that raises fails its task, and the job once Spark
    gives up on the task; what was recorded stays.  NULL is no key.
    """
    spark = df.sparkSession
    ship_package(spark)
    ledger = HadoopFS(spark, ledger).qualify(ledger)
    folder = f"{ledger.rstrip('/')}/run={run}"
    keys = df.select(F.col(key).cast("string").alias("key")).where("key IS NOT NULL").distinct()
    open_keys = keys.join(finished_calls(spark, ledger, run).select("key"), "key", "left_anti")
    tasks = parallelism or spark.sparkContext.defaultParallelism
    dealt = open_keys.repartition(tasks, "key").sortWithinPartitions("key")  # an attempt sees the batches of the one before
    dealt.mapInArrow(_caller(call, folder, concurrency), "n long").agg(F.sum("n")).collect()
    return finished_calls(spark, ledger, run).join(keys, "key", "left_semi").select(F.col("key").alias(key), "result")
