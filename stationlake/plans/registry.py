"""Named queries over the driver's tables, and their DuckDB oracles.

Each query reads the given tables (``events``, ``supplier``) at full size,
derives station data from them with Spark, runs one of the library's
operators end to end (writing to a fresh folder under the session's
checkpoint root where the operator writes) and returns a DataFrame.
``ORACLE_SQL`` holds, per query, SQL that DuckDB runs on the same parquet
tables and that must give the same multiset of rows.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Callable
from functools import partial
from typing import Any, Iterator, Tuple

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationlake.fs import HadoopFS
from stationlake.functions.paths import last_segment, legacy_hour_path, trash_path
from stationlake.functions.time import from_epoch_seconds, partition_hour_start, partition_values
from stationlake.operators.cache import publish_cache, read_cache
from stationlake.operators.calendar import hour_calendar
from stationlake.operators.compaction import (
    compact_days,
    compact_yesterday,
    list_days,
    read_days,
    sized_files,
    trash_dir,
    trash_manifest,
)
from stationlake.operators.ledger import RunLedger, call_each
from stationlake.operators.maintenance import (
    create_hour_table,
    file_counts,
    register_hour_partitions,
    show_partitions,
    union_by_name,
    write_legacy_tree,
)
from stationlake.operators.query import (
    distinct_keys,
    per_station_apply,
    recent_status,
    recent_status_sql,
)
from stationlake.operators.writer import write_history, write_hourly
from stationlake.plans.derive import (
    EXTRA_KEY,
    info_documents,
    station_rows,
    status_documents,
    write_history_csv,
    write_landing,
    write_small_files,
)
from stationlake.schemas import HISTORY_KEEP, INFO_SCHEMA, INFO_TABLE_SCHEMA, PART_COLS, STATUS_KEYS, STATUS_TABLE_SCHEMA
from stationlake.session import scratch_dir
from stationlake.sources.feeds import info_rows, missing_keys, read_feed, status_rows
from stationlake.sources.history import normalize_history, read_history
from stationlake.sources.tables import read_legacy_recent, read_legacy_tree, read_recent, read_table
from stationlake.streaming.ingest import run_available

# Fixed value: the backfill cutoff used by the registered history queries.
HISTORY_CUTOFF = "2024-01-20 18:52:03"


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _events(spark, sf_dir):
    return _read(spark, sf_dir, "events")


def status_table(spark: SparkSession, sf_dir: str, label: str = "status") -> str:
    """Station rows from ``events`` appended to a fresh hourly table."""
    root = scratch_dir(spark, label)
    write_hourly(station_rows(_events(spark, sf_dir)), root, "ingest_time")
    return root


def _max_ts(events: DataFrame):
    """``max(ts)`` as a scalar subquery: evaluated at run time, and still a
    partition filter (runtime pruning)."""
    return events.select(F.max("ts")).scalar()


# ----------------------------------------------------------------- queries

def q_recent_status(spark, sf_dir):
    """Flagship: the trailing 8 days as of the newest event.  Only the day
    folders of the window are listed (``read_recent``); the partition
    predicate then prunes to the exact window."""
    events = _events(spark, sf_dir)
    root = status_table(spark, sf_dir, "recent")
    as_of = events.agg(F.max("ts")).first()[0]
    return recent_status(read_recent(spark, root, as_of), as_of)


def q_snapshot_explode(spark, sf_dir):
    landing = scratch_dir(spark, "feed")
    status_documents(_events(spark, sf_dir)).write.text(landing)
    return status_rows(read_feed(spark, landing))


def q_station_info(spark, sf_dir):
    landing = scratch_dir(spark, "info")
    info_documents(_read(spark, sf_dir, "supplier")).write.text(landing)
    return info_rows(read_feed(spark, landing))


def q_station_info_table(spark, sf_dir):
    """S2 + K1 for info: documents -> rows -> hour folders of the document time."""
    landing = scratch_dir(spark, "info")
    root = scratch_dir(spark, "info-table")
    info_documents(_read(spark, sf_dir, "supplier")).write.text(landing)
    rows = info_rows(read_feed(spark, landing)).withColumn(
        "ingest_time", from_epoch_seconds("last_updated"))
    write_hourly(rows, root, "ingest_time", columns=[f.name for f in INFO_SCHEMA.fields])
    return read_table(spark, root, INFO_TABLE_SCHEMA)


def q_missing_keys(spark, sf_dir):
    landing = scratch_dir(spark, "feed")
    status_documents(_events(spark, sf_dir)).write.text(landing)
    return missing_keys(read_feed(spark, landing), STATUS_KEYS + (EXTRA_KEY,))


def _normalized(spark, sf_dir):
    path = scratch_dir(spark, "history")
    write_history_csv(_events(spark, sf_dir), path, mixed=True)  # two column orders
    return normalize_history(read_history(spark, path), cutoff=HISTORY_CUTOFF)


def q_backfill_normalize(spark, sf_dir):
    return _normalized(spark, sf_dir)


def q_backfill_write(spark, sf_dir):
    root = scratch_dir(spark, "backfill")
    write_history(_normalized(spark, sf_dir), root)
    return read_table(spark, root).groupBy(*PART_COLS).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum("num_bikes_available").alias("sum_bikes"),
    )


def q_partition_roundtrip(spark, sf_dir):
    root = status_table(spark, sf_dir, "roundtrip")
    return read_table(spark, root).select(*HISTORY_KEEP, *PART_COLS)


def q_compact_partition(spark, sf_dir):
    root = scratch_dir(spark, "compact")
    # Several files per hour (wide status files and narrow backfill files),
    # as a 2-minute ingest leaves them; then compact every day.
    write_small_files(_events(spark, sf_dir), root)
    compact_days(spark, root, list_days(spark, root))
    return file_counts(read_table(spark, root))


def q_retire_path(spark, sf_dir):
    events = _events(spark, sf_dir)
    y, m, d, h = partition_values("ts")
    scheme = F.when(F.col("event_type") == "view", F.lit("s3://")).otherwise(F.lit(""))
    path = F.concat(scheme, F.lit("bikes-bucket/"), legacy_hour_path(y, m, d, h),
                    F.lit("/snapshot-"), F.col("event_id").cast("string"), F.lit(".parquet"))
    paths = events.select(path.alias("path"))
    return paths.select("path", trash_path("path").alias("trash_path"),
                        last_segment("path").alias("file_name"))


def _days(events: DataFrame) -> DataFrame:
    return events.select(F.to_date("ts").alias("day_date")).distinct()


def q_partition_calendar(spark, sf_dir):
    cal = hour_calendar(_days(_events(spark, sf_dir)), offset_days=1)
    return cal.select("hour_start", *PART_COLS, "path")


def q_partition_registered(spark, sf_dir):
    location = scratch_dir(spark, "registered")
    location = HadoopFS(spark, location).qualify(location)
    table = f"stationlake_status_{uuid.uuid4().hex[:10]}"
    create_hour_table(spark, table, location)
    cal = hour_calendar(_days(_events(spark, sf_dir)), offset_days=1)
    hours = cal.select(*PART_COLS, legacy_hour_path(prefix=location).alias("location"))
    register_hour_partitions(spark, table, hours)
    register_hour_partitions(spark, table, hours)  # second time: no-op
    return show_partitions(spark, table)


def q_union_by_name(spark, sf_dir):
    events = _events(spark, sf_dir)
    is_wide = F.coalesce(F.col("event_type").isin("view", "click"), F.lit(False))
    wide = station_rows(events.where(is_wide)).select(*STATUS_KEYS)       # 10 columns
    narrow = station_rows(events.where(~is_wide)).select(*HISTORY_KEEP)   # 4 columns
    both = union_by_name([wide, narrow])
    # Per station: every row kept (n_rows), the 6 columns missing from the
    # narrow rows are NULL there (n_wide counts non-NULL values), values intact.
    return both.groupBy("station_id").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count("num_ebikes_available").alias("n_wide"),
        F.count("is_renting").alias("n_renting_known"),
        F.sum("num_bikes_available").alias("sum_bikes"),
        F.coalesce(F.sum("is_renting"), F.lit(0).cast("bigint")).alias("sum_renting"),
    )


def q_csv_cache(spark, sf_dir):
    events = _events(spark, sf_dir)
    root = status_table(spark, sf_dir, "cache-src")
    cache = scratch_dir(spark, "cache")
    publish_cache(recent_status(read_table(spark, root), _max_ts(events)), cache)
    return read_cache(spark, cache)


def q_distinct_keys(spark, sf_dir):
    return distinct_keys(station_rows(_events(spark, sf_dir)))


def q_param_sql(spark, sf_dir):
    events = _events(spark, sf_dir)
    root = status_table(spark, sf_dir, "param")
    view = f"status_{uuid.uuid4().hex[:10]}"
    as_of = events.agg(F.max("ts")).first()[0]
    read_recent(spark, root, as_of).createOrReplaceTempView(view)
    return recent_status_sql(spark, view, as_of)


def _count_and_latest(key: Tuple[Any, ...], batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    n, latest = 0, None
    for pdf in batches:
        n += len(pdf)
        m = pdf["last_reported"].max()
        if pd.notna(m):
            latest = m if latest is None else max(latest, m)
    yield pd.DataFrame({"station_id": [key[0]], "n_rows": [n],
                        "max_last_reported": [latest]})


def q_per_station_apply(spark, sf_dir):
    rows = station_rows(_events(spark, sf_dir)).select("station_id", "last_reported")
    schema = "station_id string, n_rows bigint, max_last_reported bigint"
    return per_station_apply(
        rows, _count_and_latest, schema, split_buckets="auto",
        combine=lambda part: part.groupBy("station_id").agg(
            F.sum("n_rows").alias("n_rows"), F.max("max_last_reported").alias("max_last_reported")),
    )


def send_request(outbox: str, station_id: str) -> str:
    """The fan-out's call: put a request for the station into the outbox."""
    payload = json.dumps({"station_id": station_id})
    RunLedger(outbox).record(uuid.uuid4().hex, [json.loads(payload)])
    return payload


def q_fan_out_calls(spark, sf_dir):
    """One call per station, each of which leaves a request file, by a job that
    is run twice: every station has one request."""
    events = _events(spark, sf_dir)
    outbox, ledger = scratch_dir(spark, "outbox"), scratch_dir(spark, "ledger")
    outbox = HadoopFS(spark, outbox).qualify(outbox)
    send = partial(send_request, outbox)
    call_each(station_rows(events.where("event_type = 'click'")), send, ledger, "daily")
    calls = call_each(station_rows(events), send, ledger, "daily")  # only the stations that are new
    requests = spark.read.schema("station_id string").json(outbox).groupBy("station_id").agg(F.count("*").alias("n_requests"))
    return calls.join(requests, "station_id")


def q_stream_ingest(spark, sf_dir):
    landing = scratch_dir(spark, "landing")
    root = scratch_dir(spark, "ingested")
    ckpt = scratch_dir(spark, "stream-ckpt")
    write_landing(_events(spark, sf_dir), landing)
    run_available(spark, landing, root, ckpt)
    run_available(spark, landing, root, ckpt)  # same checkpoint: adds nothing
    return read_table(spark, root).select(*HISTORY_KEEP, *PART_COLS)


def q_legacy_layout(spark, sf_dir):
    root = scratch_dir(spark, "legacy")
    write_legacy_tree(station_rows(_events(spark, sf_dir)), root, "ingest_time")
    return read_legacy_tree(spark, root).select(*HISTORY_KEEP, *PART_COLS)


def q_legacy_recent(spark, sf_dir):
    """The trailing window over a bare tree: only its days are listed."""
    events = _events(spark, sf_dir)
    root = scratch_dir(spark, "legacy-recent")
    write_legacy_tree(station_rows(events), root, "ingest_time")
    as_of = events.agg(F.max("ts")).first()[0]
    return recent_status(read_legacy_recent(spark, root, as_of), as_of)


def q_compact_sized(spark, sf_dir):
    """Compaction to files of a size that busy hours exceed; a second run
    rewrites nothing."""
    root = scratch_dir(spark, "compact-sized")
    write_small_files(_events(spark, sf_dir), root, spread=4)
    days = list_days(spark, root)
    by_hour = {}
    for path, size in sized_files(spark, [root]):
        by_hour[path.rsplit("/", 1)[0]] = by_hour.get(path.rsplit("/", 1)[0], 0) + size
    target = max(by_hour.values()) // 2
    compact_days(spark, root, days, target_bytes=target)
    again = compact_days(spark, root, days, target_bytes=target)
    counts = file_counts(read_table(spark, root)).drop("n_files")
    return counts.withColumn("rewritten_again", F.lit(again["files_before"]).cast("bigint"))


def q_compact_yesterday(spark, sf_dir):
    """F4 + K4: the daily compaction of the newest event's day, on the next
    day: live files, and what the trash holds of each hour, by the manifest."""
    events = _events(spark, sf_dir)
    root = scratch_dir(spark, "yesterday")
    for odd in (0, 1):  # two snapshots of every hour
        write_hourly(station_rows(events.where(F.pmod("event_id", F.lit(2)) == odd)), root, "ingest_time")
    newest = events.agg(F.max("ts")).first()[0]
    compact_yesterday(spark, root, as_of=newest + dt.timedelta(days=1))
    live = file_counts(read_days(spark, root, [newest.date()]))
    manifest = trash_manifest(spark, root)
    hour = r"year=(\d+)/month=(\d+)/day=(\d+)/hour=(\d+)/[^/]+$"
    retired = manifest.select(*[F.regexp_extract("path", hour, k + 1).alias(c) for k, c in enumerate(PART_COLS)],
                              F.regexp_extract("trash_path", "[^/]+$", 0).alias("file"))
    base = HadoopFS(spark, root).qualify(root).rstrip("/")
    held = (spark.read.schema(STATUS_TABLE_SCHEMA).option("basePath", trash_dir(base)).parquet(trash_dir(base))
            .groupBy(*PART_COLS, F.col("_metadata.file_name").alias("file")).agg(F.count("*").alias("n")))
    trash = (retired.join(held, [*PART_COLS, "file"]).groupBy(*PART_COLS)
             .agg(F.count("*").alias("trash_files"), F.sum("n").alias("trash_rows")))
    return live.join(trash, list(PART_COLS), "left").fillna(0, ["trash_files", "trash_rows"])


def q_live_ingest(spark, sf_dir):
    """X7 + S7: a stream at processing time; every row lands in the UTC hour
    of the run, whatever the documents say."""
    landing, root, ckpt = (scratch_dir(spark, x) for x in ("live", "live-table", "live-ckpt"))
    write_landing(_events(spark, sf_dir), landing)
    began = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None, minute=0, second=0, microsecond=0)
    run_available(spark, landing, root, ckpt, partition_time="processing")
    ended = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    hour = partition_hour_start()
    return read_table(spark, root).select(*HISTORY_KEEP, ((hour >= F.lit(began)) & (hour <= F.lit(ended))).alias("in_this_hour"))


def q_snapshot_files(spark, sf_dir):
    """File names are unique: the same snapshot, appended twice, leaves
    two files in every hour."""
    root = scratch_dir(spark, "snapshot-files")
    for _ in range(2):
        write_hourly(station_rows(_events(spark, sf_dir)), root, "ingest_time")
    return file_counts(read_table(spark, root))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "recent_status": q_recent_status,
    "snapshot_explode": q_snapshot_explode,
    "station_info": q_station_info,
    "station_info_table": q_station_info_table,
    "missing_keys": q_missing_keys,
    "backfill_normalize": q_backfill_normalize,
    "backfill_write": q_backfill_write,
    "partition_roundtrip": q_partition_roundtrip,
    "compact_partition": q_compact_partition,
    "retire_path": q_retire_path,
    "partition_calendar": q_partition_calendar,
    "partition_registered": q_partition_registered,
    "union_by_name": q_union_by_name,
    "csv_cache": q_csv_cache,
    "distinct_keys": q_distinct_keys,
    "param_sql": q_param_sql,
    "per_station_apply": q_per_station_apply,
    "fan_out_calls": q_fan_out_calls,
    "stream_ingest": q_stream_ingest,
    "legacy_layout": q_legacy_layout,
    "legacy_recent": q_legacy_recent,
    "compact_sized": q_compact_sized,
    "compact_yesterday": q_compact_yesterday,
    "live_ingest": q_live_ingest,
    "snapshot_files": q_snapshot_files,
}


# ----------------------------------------------------------------- oracles

_SID = "CAST(user_id AS VARCHAR)"
_BIKES = "CAST(floor(value) AS BIGINT)"
_DOCKS = "CAST(floor(value / 10) AS BIGINT)"
_SECS = "(epoch_us(ts) // 1000000)"
_SLOT = f"({_SECS} - {_SECS} % 120)"
_PARTS = ("strftime(ts, '%Y') AS year, strftime(ts, '%m') AS month, "
          "strftime(ts, '%d') AS day, strftime(ts, '%H') AS hour")
_CORE = (f"{_SID} AS station_id, {_BIKES} AS num_bikes_available, "
         f"{_DOCKS} AS num_docks_available, {_SECS} AS last_reported")
_OTHER = ("CAST(floor(value / 100) AS BIGINT) AS num_ebikes_available, "
          "CAST(event_type = 'error' AS BIGINT) AS num_bikes_disabled, "
          "CAST(0 AS BIGINT) AS num_docks_disabled, CAST(1 AS BIGINT) AS is_installed, "
          "CAST(event_type <> 'error' AS BIGINT) AS is_renting, CAST(1 AS BIGINT) AS is_returning")
_RECENT = (f"SELECT {_SID} AS station_id, date_trunc('second', ts) AS last_reported, "
           f"{_BIKES} AS num_bikes_available FROM events "
           "WHERE CAST(CAST(ts AS DATE) AS TIMESTAMP) > (SELECT max(ts) FROM events) - INTERVAL 8 DAY")
_HIST_WHERE = f"WHERE date_trunc('second', ts) < TIMESTAMP '{HISTORY_CUTOFF}'"
_NEXT_DAY_HOURS = (
    "WITH d AS (SELECT DISTINCT CAST(CAST(ts AS DATE) AS TIMESTAMP) AS d FROM events), "
    "h AS (SELECT unnest(generate_series(d + INTERVAL 1 DAY, d + INTERVAL 47 HOUR, "
    "INTERVAL 1 HOUR)) AS hour_start FROM d) "
)

ORACLE_SQL: dict[str, str] = {
    "recent_status": _RECENT,
    "snapshot_explode": (
        f"SELECT {_CORE}, {_OTHER}, {_SLOT} AS last_updated FROM events"
    ),
    "station_info": (
        "SELECT CAST(s_suppkey AS VARCHAR) AS station_id, s_name AS name, s_acctbal AS lat, "
        "CAST(s_nationkey AS DOUBLE) AS lon, CAST(s_nationkey AS VARCHAR) AS region_id, "
        "CAST(s_nationkey AS BIGINT) AS capacity, s_acctbal > 0 AS has_kiosk, "
        "CAST(1704067200 AS BIGINT) AS last_updated FROM supplier"
    ),
    "station_info_table": (
        "SELECT CAST(s_suppkey AS VARCHAR) AS station_id, s_name AS name, s_acctbal AS lat, "
        "CAST(s_nationkey AS DOUBLE) AS lon, CAST(s_nationkey AS VARCHAR) AS region_id, "
        "CAST(s_nationkey AS BIGINT) AS capacity, s_acctbal > 0 AS has_kiosk, "
        "CAST(1704067200 AS BIGINT) AS last_updated, '2024' AS year, '01' AS month, "
        "'01' AS day, '00' AS hour FROM supplier"
    ),
    "missing_keys": (
        f"SELECT {_SLOT} AS last_updated, 'legacy_id' AS missing_key FROM events "
        f"GROUP BY {_SLOT}, event_id // 500 "
        "HAVING max(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END) = 0"
    ),
    "backfill_normalize": (
        "SELECT date_trunc('second', ts) AS execution_time, "
        "lpad(CAST(user_id AS VARCHAR), 3, '0') AS station_id, "
        f"{_BIKES} AS num_bikes_available, CAST(floor(value / 10) AS BIGINT) AS num_docks_available, "
        "epoch_us(date_trunc('minute', ts)) // 1000000 AS last_reported, "
        f"strftime(ts, '%Y-%m-%d %H') AS partition_key FROM events {_HIST_WHERE}"
    ),
    "backfill_write": (
        f"SELECT {_PARTS}, count(*) AS n_rows, CAST(sum({_BIKES}) AS BIGINT) AS sum_bikes "
        f"FROM events {_HIST_WHERE} GROUP BY ALL"
    ),
    "partition_roundtrip": f"SELECT {_CORE}, {_PARTS} FROM events",
    "compact_partition": (
        f"SELECT {_PARTS}, count(*) AS n_rows, CAST(1 AS BIGINT) AS n_files FROM events GROUP BY ALL"
    ),
    "retire_path": (
        "WITH p AS (SELECT CASE WHEN event_type = 'view' THEN 's3://' ELSE '' END AS s, "
        "'station_status/' || strftime(ts, '%Y/%m/%d/%H') || '/snapshot-' || "
        "CAST(event_id AS VARCHAR) || '.parquet' AS rest, "
        "'snapshot-' || CAST(event_id AS VARCHAR) || '.parquet' AS f FROM events) "
        "SELECT s || 'bikes-bucket/' || rest AS path, s || 'bikes-bucket/trash/' || rest AS trash_path, "
        "f AS file_name FROM p"
    ),
    "partition_calendar": (
        _NEXT_DAY_HOURS
        + "SELECT hour_start, strftime(hour_start, '%Y') AS year, strftime(hour_start, '%m') AS month, "
        "strftime(hour_start, '%d') AS day, strftime(hour_start, '%H') AS hour, "
        "'station_status/' || strftime(hour_start, '%Y/%m/%d/%H') AS path FROM h"
    ),
    "partition_registered": (
        _NEXT_DAY_HOURS
        + "SELECT strftime(hour_start, 'year=%Y/month=%m/day=%d/hour=%H') AS \"partition\" FROM h"
    ),
    "union_by_name": (
        f"WITH u AS (SELECT {_CORE}, {_OTHER} FROM events "
        "WHERE coalesce(event_type IN ('view', 'click'), false) "
        f"UNION ALL BY NAME SELECT {_CORE} FROM events "
        "WHERE NOT coalesce(event_type IN ('view', 'click'), false)) "
        "SELECT station_id, count(*) AS n_rows, count(num_ebikes_available) AS n_wide, "
        "count(is_renting) AS n_renting_known, CAST(sum(num_bikes_available) AS BIGINT) AS sum_bikes, "
        "CAST(coalesce(sum(is_renting), 0) AS BIGINT) AS sum_renting FROM u GROUP BY station_id"
    ),
    "csv_cache": _RECENT,
    "distinct_keys": f"SELECT DISTINCT {_SID} AS station_id FROM events",
    "param_sql": _RECENT,
    "per_station_apply": (
        f"SELECT {_SID} AS station_id, count(*) AS n_rows, max({_SECS}) AS max_last_reported "
        "FROM events GROUP BY 1"
    ),
    "fan_out_calls": (
        f"SELECT DISTINCT {_SID} AS station_id, '{{\"station_id\": \"' || {_SID} || '\"}}' AS result, "
        "CAST(1 AS BIGINT) AS n_requests FROM events"
    ),
    "stream_ingest": f"SELECT {_CORE}, {_PARTS} FROM events",
    "legacy_layout": f"SELECT {_CORE}, {_PARTS} FROM events",
    "legacy_recent": _RECENT,
    "compact_sized": (
        f"SELECT {_PARTS}, count(*) AS n_rows, CAST(0 AS BIGINT) AS rewritten_again FROM events GROUP BY ALL"
    ),
    "compact_yesterday": (
        f"SELECT {_PARTS}, count(*) AS n_rows, CAST(1 AS BIGINT) AS n_files, "
        "CASE WHEN count(DISTINCT event_id % 2) = 2 THEN 2 ELSE 0 END::BIGINT AS trash_files, "
        "CASE WHEN count(DISTINCT event_id % 2) = 2 THEN count(*) ELSE 0 END AS trash_rows "
        "FROM events WHERE CAST(ts AS DATE) = (SELECT CAST(max(ts) AS DATE) FROM events) GROUP BY ALL"
    ),
    "live_ingest": f"SELECT {_CORE}, true AS in_this_hour FROM events",
    "snapshot_files": (
        f"SELECT {_PARTS}, 2 * count(*) AS n_rows, CAST(2 AS BIGINT) AS n_files FROM events GROUP BY ALL"
    ),
}
