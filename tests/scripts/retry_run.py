"""Run writes and a compaction while every task's first attempt fails.

Started by tests/test_retries.py in its own process, because task retries
need a master with a failure allowance (``local[4,3]``).  Prints one JSON line.
"""

import json
import sys
import tempfile

from pyspark import TaskContext
from pyspark.sql import functions as F

from stationlake.operators import compaction as M
from stationlake.operators.writer import write_hourly
from stationlake.plans.derive import station_rows, write_small_files
from stationlake.session import build_session
from stationlake.sources.tables import read_table


def _fail_first_attempt(x):
    if TaskContext.get().attemptNumber() == 0:
        raise RuntimeError("injected task failure")
    return True


def main(sf_dir):
    spark = build_session("local[4,3]", 4)
    fail_first_attempt = F.udf(_fail_first_attempt, "boolean")
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    n = events.count()
    out = {"events": n}

    root = tempfile.mkdtemp() + "/t"
    write_hourly(station_rows(events).where(fail_first_attempt(F.lit(1))), root, "ingest_time")
    out["written"] = read_table(spark, root).count()

    root2 = tempfile.mkdtemp() + "/c"
    write_small_files(events, root2)
    before = sorted(map(tuple, read_table(spark, root2).collect()), key=repr)
    real = M.read_days

    def flaky(*a, **k):  # every task of the compaction's scan fails once
        df = real(*a, **k)
        return None if df is None else df.where(fail_first_attempt(F.lit(1)))

    M.read_days = flaky
    rep = M.compact_days(spark, root2, M.list_days(spark, root2))
    M.read_days = real
    after = sorted(map(tuple, read_table(spark, root2).collect()), key=repr)
    out.update(compacted_hours=rep["hours"], rows_reported=rep["rows"],
               same_rows=before == after, rows_after=len(after))
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1])
