"""Command-line jobs: the reference's scheduled functions and its backfill
script as ``spark-submit`` entry points.

    spark-submit stationlake/jobs.py status-ingest --landing L --table T --checkpoint C [--every "2 minutes"]
                                                   [--archive A] [--bad-records B]
    spark-submit stationlake/jobs.py info-ingest   --landing L --table T
    spark-submit stationlake/jobs.py backfill PATH --table T [--cutoff "2019-08-01 18:52:03"]
    spark-submit stationlake/jobs.py compact       --table T [--day D | --from D1 [--to D2]]  (default: yesterday, UTC)
    spark-submit stationlake/jobs.py register      --name N --table T [--day YYYY-MM-DD] (default: tomorrow, UTC)
    spark-submit stationlake/jobs.py fan-out       --name N --cache C [--days 8] [--as-of TS]
    spark-submit stationlake/jobs.py migrate LEGACY_ROOT --table T [--kind status|info]

Each job prints one JSON line describing what it did.  Scheduling (cron)
stays with the scheduler that submits these.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import os
import sys

if __package__ in (None, ""):
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from stationlake.functions.time import from_epoch_seconds, utc_now  # noqa: E402
from stationlake.operators.cache import publish_cache, read_cache  # noqa: E402
from stationlake.operators.calendar import day_hours  # noqa: E402
from stationlake.operators.compaction import TARGET_BYTES, compact_days  # noqa: E402
from stationlake.operators.maintenance import (  # noqa: E402
    create_hour_table,
    migrate_legacy,
    register_hour_partitions,
)
from stationlake.operators.query import TRAILING_DAYS, distinct_keys, recent_status  # noqa: E402
from stationlake.operators.writer import write_history, write_hourly  # noqa: E402
from stationlake.schemas import INFO_SCHEMA, INFO_TABLE_SCHEMA, STATUS_TABLE_SCHEMA  # noqa: E402
from stationlake.session import build_session  # noqa: E402
from stationlake.sources.feeds import info_rows, read_feed  # noqa: E402
from stationlake.sources.history import normalize_history, read_history  # noqa: E402
from stationlake.streaming.ingest import run_available, start_ingest  # noqa: E402


TABLE_SCHEMAS = {"status": STATUS_TABLE_SCHEMA, "info": INFO_TABLE_SCHEMA}


def _utc_today() -> dt.date:
    return dt.datetime.now(dt.timezone.utc).date()


def _day(s: str | None, default_offset: int) -> dt.date:
    return dt.date.fromisoformat(s) if s else _utc_today() + dt.timedelta(days=default_offset)


def status_ingest(spark, a) -> dict:
    if a.every:
        q = start_ingest(spark, a.landing, a.table, a.checkpoint, a.every, multi_line=a.multiline,
                         partition_time=a.partition_time, archive_dir=a.archive,
                         bad_records_dir=a.bad_records)
        q.awaitTermination()
        return {"job": "status-ingest", "stopped": True}
    run_available(spark, a.landing, a.table, a.checkpoint, multi_line=a.multiline,
                  partition_time=a.partition_time, archive_dir=a.archive,
                  bad_records_dir=a.bad_records)
    return {"job": "status-ingest", "mode": "availableNow"}


def info_ingest(spark, a) -> dict:
    rows = info_rows(read_feed(spark, a.landing, multi_line=a.multiline))
    ingest = (F.coalesce(from_epoch_seconds("last_updated"), utc_now())
              if a.partition_time == "document" else utc_now())
    write_hourly(rows.withColumn("ingest_time", ingest), a.table, "ingest_time",
                 columns=[f.name for f in INFO_SCHEMA.fields])
    return {"job": "info-ingest", "table": a.table}


def backfill(spark, a) -> dict:
    write_history(normalize_history(read_history(spark, a.path), cutoff=a.cutoff), a.table,
                  max_records_per_file=a.max_records_per_file)
    return {"job": "backfill", "path": a.path, "cutoff": a.cutoff}


def compact(spark, a) -> dict:
    if a.date_from:
        first = dt.date.fromisoformat(a.date_from)
        last = dt.date.fromisoformat(a.date_to) if a.date_to else _utc_today() - dt.timedelta(days=1)
        days = [first + dt.timedelta(days=i) for i in range((last - first).days + 1)]
    else:
        days = [_day(a.day, -1)]
    report = compact_days(spark, a.table, days, schema=TABLE_SCHEMAS[a.kind],
                          target_bytes=a.target_bytes)
    return {"job": "compact", "days": len(days), **report}


def register(spark, a) -> dict:
    create_hour_table(spark, a.name, a.table, schema=TABLE_SCHEMAS[a.kind])
    hours = day_hours(spark, _day(a.day, +1)).select(
        "year", "month", "day", "hour",
        F.concat_ws("/", F.lit(a.table.rstrip("/")), "hive_path").alias("location"))
    return {"job": "register", "partitions": register_hour_partitions(spark, a.name, hours)}


def fan_out_job(spark, a) -> dict:
    as_of = dt.datetime.fromisoformat(a.as_of) if a.as_of else None
    recent = recent_status(spark.table(a.name), as_of, a.days)
    publish_cache(recent, a.cache)
    n = distinct_keys(read_cache(spark, a.cache)).count()
    return {"job": "fan-out", "cache": a.cache, "stations": n}


def migrate(spark, a) -> dict:
    migrate_legacy(spark, a.legacy, a.table, schema=None if a.kind == "status" else INFO_SCHEMA)
    return {"job": "migrate", "from": a.legacy, "to": a.table}


def main(argv=None) -> None:
    p = argparse.ArgumentParser(prog="stationlake.jobs")
    sub = p.add_subparsers(dest="job", required=True)

    s = sub.add_parser("status-ingest")
    s.add_argument("--landing", required=True)
    s.add_argument("--table", required=True)
    s.add_argument("--checkpoint", required=True)
    s.add_argument("--every", default=None, help='e.g. "2 minutes"; omit to process what is there and stop')
    s.add_argument("--multiline", action="store_true")
    s.add_argument("--partition-time", choices=("document", "processing"), default="processing")
    s.add_argument("--archive", default=None, help="move processed documents here")
    s.add_argument("--bad-records", default=None, help="divert unparseable documents here")
    s.set_defaults(fn=status_ingest)

    s = sub.add_parser("info-ingest")
    s.add_argument("--landing", required=True)
    s.add_argument("--table", required=True)
    s.add_argument("--multiline", action="store_true")
    s.add_argument("--partition-time", choices=("document", "processing"), default="processing")
    s.set_defaults(fn=info_ingest)

    s = sub.add_parser("backfill")
    s.add_argument("path")
    s.add_argument("--table", required=True)
    s.add_argument("--cutoff", default=None)
    s.add_argument("--max-records-per-file", type=int, default=None)
    s.set_defaults(fn=backfill)

    s = sub.add_parser("compact")
    s.add_argument("--table", required=True)
    s.add_argument("--day", default=None)
    s.add_argument("--from", dest="date_from", default=None, help="first day of a range (catch-up)")
    s.add_argument("--to", dest="date_to", default=None, help="last day of the range (default: yesterday)")
    s.add_argument("--kind", choices=sorted(TABLE_SCHEMAS), default="status")
    s.add_argument("--target-bytes", type=int, default=TARGET_BYTES, help="bytes of a compacted file")
    s.set_defaults(fn=compact)

    s = sub.add_parser("register")
    s.add_argument("--name", required=True)
    s.add_argument("--table", required=True)
    s.add_argument("--day", default=None)
    s.add_argument("--kind", choices=sorted(TABLE_SCHEMAS), default="status")
    s.set_defaults(fn=register)

    s = sub.add_parser("fan-out")
    s.add_argument("--name", required=True)
    s.add_argument("--cache", required=True)
    s.add_argument("--days", type=int, default=TRAILING_DAYS)
    s.add_argument("--as-of", default=None)
    s.set_defaults(fn=fan_out_job)

    s = sub.add_parser("migrate")
    s.add_argument("legacy")
    s.add_argument("--table", required=True)
    s.add_argument("--kind", choices=sorted(TABLE_SCHEMAS), default="status")
    s.set_defaults(fn=migrate)

    a = p.parse_args(argv)
    spark = build_session(app_name=f"stationlake-{a.job}")
    print(json.dumps(a.fn(spark, a), default=str))


if __name__ == "__main__":
    main()
