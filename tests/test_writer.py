"""Hour-routed writes: skewed hours are split, file size is capped, rows kept."""

from __future__ import annotations

import glob

from conftest import SF_MID
from pyspark.sql import functions as F

from stationlake.operators.writer import write_hourly
from stationlake.plans.derive import station_rows
from stationlake.sources.tables import read_table


def _skewed(spark):
    """A third of all rows moved into one hour (2024-01-15 12:00)."""
    rows = station_rows(spark.read.parquet(f"{SF_MID}/events.parquet"))
    hot = F.pmod(F.xxhash64("last_reported", "station_id"), F.lit(3)) == 0
    return rows.withColumn(
        "ingest_time",
        F.when(hot, F.lit("2024-01-15 12:30:00").cast("timestamp_ntz")).otherwise(F.col("ingest_time")))


def test_hot_hour_is_split_over_tasks(spark, tmp):
    # AQE splits a partition along map outputs; a real scan has many input
    # splits, the small test file has one, so spread it over 8 first.
    df = _skewed(spark).repartition(8)
    # Small advisory size and many shuffle partitions: cold partitions (a few
    # hours, a few KB) stay whole, the hot one (~150 KB) is over the size.
    conf = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "32k",
            "spark.sql.shuffle.partitions": "200"}
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        write_hourly(df, f"{tmp}/t", "ingest_time")
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    hot_files = glob.glob(f"{tmp}/t/year=2024/month=01/day=15/hour=12/*.parquet")
    # AQE split the hot hour (REBALANCE skew handling) far more than any cold
    # hour (those are split only as far as the tiny test advisory size asks).
    cold = [len(glob.glob(f"{h}/*.parquet")) for h in glob.glob(f"{tmp}/t/year=2024/month=01/day=1[0-4]/hour=*")]
    # cold hours that hash into the hot hour's partition are split with it;
    # the rest stay whole
    assert len(hot_files) > 1
    assert sum(1 for c in cold if c == 1) >= 0.9 * len(cold), sorted(cold)[-5:]
    biggest = max(spark.read.parquet(f).count() for f in hot_files)
    n_hot_rows = read_table(spark, f"{tmp}/t").where("day = '15' and hour = '12'").count()
    assert biggest < 0.6 * n_hot_rows  # no single task wrote most of the hot hour
    t = read_table(spark, f"{tmp}/t")
    assert t.count() == df.count()
    n_hot = df.where(F.col("ingest_time") == F.lit("2024-01-15 12:30:00").cast("timestamp_ntz")).count()
    assert t.where("day = '15' and hour = '12'").count() >= n_hot


def test_max_records_per_file(spark, tmp):
    df = station_rows(spark.read.parquet(f"{SF_MID}/events.parquet")).where(F.to_date("ingest_time") == "2024-01-15")
    write_hourly(df, f"{tmp}/t", "ingest_time", max_records_per_file=5)
    for h in glob.glob(f"{tmp}/t/year=2024/month=01/day=15/hour=*"):
        for f in glob.glob(f"{h}/*.parquet"):
            assert spark.read.parquet(f).count() <= 5
    assert read_table(spark, f"{tmp}/t").count() == df.count()
