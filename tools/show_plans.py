"""Print the formatted physical plans of the main queries.

Usage: python tools/show_plans.py [sf_dir]

Each plan is printed after an action ran, so adaptive plans show their final
form (``isFinalPlan=true``).
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from stationlake.functions.time import with_partition_values  # noqa: E402
from stationlake.plans import registry as R  # noqa: E402
from stationlake.plans.derive import station_rows, status_documents  # noqa: E402
from stationlake.schemas import PART_COLS, STATUS_KEYS  # noqa: E402
from stationlake.session import build_session  # noqa: E402


def show(title, df):
    df._jdf.queryExecution().toRdd().count()  # run this plan itself: AQE finalises it
    print(f"\n### {title}\n")
    jvm = df.sparkSession.sparkContext._jvm
    print(jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted"))


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", 8)
    for name in ("recent_status", "csv_cache", "snapshot_explode", "backfill_normalize",
                 "distinct_keys", "per_station_apply"):
        df = R.QUERIES[name](spark, sf)
        if name == "csv_cache":  # the cache write is done; show the query it published
            events = spark.read.parquet(f"{sf}/events.parquet")
            root = R.status_table(spark, sf, "plans")
            from stationlake.operators.query import recent_status
            from stationlake.sources.tables import read_table
            df = recent_status(read_table(spark, root), events.select(F.max("ts")).scalar())
            name = "recent_status with run-time pruning (max(ts) subquery)"
        show(name, df)
    ev = spark.read.parquet(f"{sf}/events.parquet")
    show("feed documents derived from events (bounded collect_list groups)", status_documents(ev))
    show("hour-routed write input (REBALANCE)",
         with_partition_values(station_rows(ev), "ingest_time")
         .select(*STATUS_KEYS, *PART_COLS).hint("rebalance", *PART_COLS))
    spark.stop()


if __name__ == "__main__":
    main()
