"""Benchmark of the headline operators.

Runs at ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on
``local[$BENCH_CPUS]`` and prints one JSON line:
``{"metric": ..., "value": total_sec, "unit": "sec", "queries": {...}, "sf": ...}``.

Each timed step is run ``$BENCH_REPS`` times (default 3) after one warm-up
and the median is reported.  Inputs a step needs (the hourly table, feed
documents, history files, small-file fixtures) are built before the clock
starts; results are consumed with the ``noop`` sink, so nothing is
collected to the driver.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from stationlake.functions.time import from_epoch_seconds  # noqa: E402
from stationlake.operators.compaction import compact_days, list_days  # noqa: E402
from stationlake.operators.query import distinct_keys, recent_status  # noqa: E402
from stationlake.operators.writer import write_history, write_hourly  # noqa: E402
from stationlake.plans.derive import (  # noqa: E402
    station_rows,
    status_documents,
    write_history_csv,
    write_landing,
    write_small_files,
)
from stationlake.plans.registry import HISTORY_CUTOFF  # noqa: E402
from stationlake.fs import HadoopFS  # noqa: E402
from stationlake.session import build_session, scratch_dir  # noqa: E402
from stationlake.sources.feeds import read_feed, status_rows  # noqa: E402
from stationlake.sources.history import normalize_history, read_history  # noqa: E402
from stationlake.sources.tables import read_recent, read_table  # noqa: E402
from stationlake.streaming.ingest import run_available  # noqa: E402


def _consume(df):
    df.write.format("noop").mode("overwrite").save()


def _time(fn, setup=None, reps=3, warm=1):
    times = []
    for i in range(warm + reps):
        arg = setup() if setup else None
        t0 = time.perf_counter()
        fn(arg)
        dt = time.perf_counter() - t0
        if i >= warm:
            times.append(dt)
    return round(statistics.median(times), 3)


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    reps = int(os.environ.get("BENCH_REPS", "3"))
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None
    spark = build_session(f"local[{cpus}]", int(cpus) if cpus.isdigit() else 8,
                          app_name="stationlake-bench")
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    as_of = events.select(F.max("ts")).scalar()
    q = {}
    run_dir = scratch_dir(spark, "bench")  # all of this run's folders; removed at the end
    n_dirs = iter(range(1_000_000))

    def scratch(label):
        return f"{run_dir}/{label}-{next(n_dirs)}"

    # K1: events -> hourly table (also the input of the queries below)
    q["status_write"] = _time(
        lambda root: write_hourly(station_rows(events), root, "ingest_time"),
        setup=lambda: scratch("bench-status"), reps=reps)
    root = scratch("bench-status")
    write_hourly(station_rows(events), root, "ingest_time")

    # Trailing 8 days, partition-pruned vs the same projection unpruned
    as_of_value = events.agg(F.max("ts")).first()[0]
    q["recent_status_pruned"] = _time(
        lambda _: _consume(recent_status(read_recent(spark, root, as_of_value), as_of_value)), reps=reps)
    q["recent_status_runtime_pruned"] = _time(
        lambda _: _consume(recent_status(read_table(spark, root), as_of)), reps=reps)
    q["recent_status_unpruned"] = _time(
        lambda _: _consume(read_table(spark, root).select(
            "station_id", from_epoch_seconds("last_reported").alias("last_reported"),
            "num_bikes_available")), reps=reps)

    # Feed documents -> station rows
    landing = scratch("bench-feed")
    status_documents(events).write.text(landing)
    q["snapshot_explode"] = _time(
        lambda _: _consume(status_rows(read_feed(spark, landing))), reps=reps)

    # History CSV -> normalised rows; K2: routed write
    hist = scratch("bench-history")
    write_history_csv(events, hist)
    q["backfill_normalize"] = _time(
        lambda _: _consume(normalize_history(read_history(spark, hist), cutoff=HISTORY_CUTOFF)),
        reps=reps)
    q["backfill_write"] = _time(
        lambda out: write_history(normalize_history(read_history(spark, hist), cutoff=HISTORY_CUTOFF), out),
        setup=lambda: scratch("bench-backfill"), reps=reps)

    # K3/K4: compact every day of a table with several files per hour
    # (wide rows spread over the shuffle partitions, plus narrow files)
    spread = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def small_files():
        r = scratch("bench-compact")
        write_small_files(events, r, spread=spread)
        return r
    q["compact_partition"] = _time(lambda r: compact_days(spark, r, list_days(spark, r)),
                                   setup=small_files, reps=reps)

    # Stream a landing folder into the hourly table (availableNow, two
    # micro-batches of half the files each)
    def stream_setup():
        land = scratch("bench-landing")
        write_landing(events, land, files=spread)
        return land, scratch("bench-ingested"), scratch("bench-ckpt")
    q["stream_ingest"] = _time(
        lambda a: run_available(spark, *a, max_files_per_trigger=max(1, spread // 2)),
        setup=stream_setup, reps=reps)

    # G2
    q["distinct_keys"] = _time(lambda _: _consume(distinct_keys(read_table(spark, root))), reps=reps)

    HadoopFS(spark, run_dir).delete(run_dir)
    total = round(sum(q.values()), 3)
    print(json.dumps({"metric": "stationlake_headline_total", "value": total, "unit": "sec",
                      "queries": q, "sf": sf, "cpus": cpus, "reps": reps}))
    spark.stop()


if __name__ == "__main__":
    main()
