"""Trailing-window queries and what the fan-out does with them
(S5, P8, F2, X3, X5-X8, G2, G3, Q1).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stationlake.session import ship_package
from stationlake.functions.time import as_of_column, days_interval, from_epoch_seconds, partition_date

# Fixed value: the trailing window of the fan-out query, in days.
TRAILING_DAYS = 8


def trailing_window_predicate(as_of=None, days: int = TRAILING_DAYS) -> Column:
    """partition date (midnight) strictly after ``as_of - days``.

    With ``as_of`` = 2026-08-09 00:00:00 and 8 days, 2026-08-01 is out
    (equal) and 2026-08-02 in; the hour column is not used and later-dated
    partitions pass.  Only partition columns appear, so the predicate is a
    ``PartitionFilter``: folders outside the window are never listed.
    """
    return partition_date() > as_of_column(as_of) - days_interval(days)


def trailing_window(table: DataFrame, as_of=None, days: int = TRAILING_DAYS) -> DataFrame:
    return table.where(trailing_window_predicate(as_of, days))


def recent_status(table: DataFrame, as_of=None, days: int = TRAILING_DAYS) -> DataFrame:
    """S5 + P8: ``station_id, last_reported (timestamp), num_bikes_available``
    of the trailing window.  Three columns are read (``ReadSchema``)."""
    return trailing_window(table, as_of, days).select(
        "station_id",
        from_epoch_seconds("last_reported").alias("last_reported"),
        "num_bikes_available",
    )


# Q1: the same query as parameterised SQL (named markers, bound by Spark,
# never pasted into the text).
RECENT_STATUS_SQL = """
SELECT
  station_id,
  timestampadd(SECOND, last_reported, TIMESTAMP_NTZ'1970-01-01 00:00:00') AS last_reported,
  num_bikes_available
FROM {table}
WHERE make_date(CAST(year AS INT), CAST(month AS INT), CAST(day AS INT))
      > CAST(:as_of AS TIMESTAMP_NTZ) - make_dt_interval(:days)
"""


def sql_frame(spark: SparkSession, sql: str, params: dict | None = None) -> DataFrame:
    """Q1: parameterised SQL -> DataFrame (``:name`` markers)."""
    return spark.sql(sql, args=params or {})


def recent_status_sql(spark: SparkSession, table: str, as_of, days: int = TRAILING_DAYS) -> DataFrame:
    if not table.replace("_", "").replace(".", "").isalnum():
        raise ValueError(f"bad table name {table!r}")
    stamp = as_of.isoformat(sep=" ") if hasattr(as_of, "isoformat") else str(as_of)
    return sql_frame(spark, RECENT_STATUS_SQL.format(table=table), {"as_of": stamp, "days": int(days)})


# --------------------------------------------------------------------------- G2 / G3

def distinct_keys(df: DataFrame, key: str = "station_id") -> DataFrame:
    """Distinct keys (partial aggregation before the shuffle)."""
    return df.select(key).distinct()


def _with_buckets(df: DataFrame, key: str, rows_per_group: int) -> DataFrame:
    """``df`` with ``_n_buckets``: ``ceil(rows / rows_per_group)`` of its key.

    The counts are part of the plan (partial aggregation, then a join that
    matches NULL keys too), so there is no limit on the number of hot keys.
    """
    counts = (df.groupBy(F.col(key).alias("_key")).agg(F.count(F.lit(1)).alias("_n"))
              .where(F.col("_n") > rows_per_group)
              .select("_key", F.ceil(F.col("_n") / rows_per_group).cast("bigint").alias("_n_buckets")))
    joined = df.join(counts, F.col(key).eqNullSafe(F.col("_key")), "left").drop("_key")
    return joined.withColumn("_n_buckets", F.coalesce("_n_buckets", F.lit(1).cast("bigint")))


def per_station_apply(df: DataFrame, fn: Callable, schema: T.StructType | str,
                      key: str = "station_id", split_buckets: int | str | None = None,
                      combine: Callable[[DataFrame], DataFrame] | None = None,
                      rows_per_group: int = 1_000_000) -> DataFrame:
    """Run a user function on each station's rows.

    ``fn(key_tuple, batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]``
    receives the rows of one group as a stream of Arrow batches, so a large
    station is never one pandas frame in memory.  ``fn`` must carry these
    type hints (``typing.Tuple``/``Iterator``) for Spark to pick the
    iterator form.

    Without ``split_buckets`` a station is one group, and so one task.
    Splitting needs ``combine``, which merges the results of a station's
    groups (e.g. ``groupBy(key).agg``), so that the answer does not depend on
    how much data there is.  ``split_buckets=n`` makes the groups
    ``(station, bucket)`` with a deterministic hash bucket in ``[0, n)`` for
    every station; ``split_buckets="auto"`` gives each station
    ``ceil(rows / rows_per_group)`` buckets.  The bucket column ``_bucket`` is
    part of the grouping key passed to ``fn``.
    """
    ship_package(df.sparkSession)
    if not split_buckets:
        return df.groupBy(key).applyInPandas(fn, schema)
    if combine is None:
        raise ValueError("split_buckets needs combine: a split station has several results")
    # Row content plus the input partition: retry-safe (a recomputed task
    # puts every row in the same bucket again) and it spreads exact duplicate
    # rows (a station that did not report for an hour) over input partitions.
    row_hash = F.xxhash64(*[F.col(c) for c in df.columns], F.spark_partition_id())
    df = df.withColumn("_row_hash", row_hash)
    if split_buckets == "auto":
        df = _with_buckets(df, key, rows_per_group)
    else:
        df = df.withColumn("_n_buckets", F.lit(int(split_buckets)))
    return combine(df.withColumn("_bucket", F.pmod("_row_hash", "_n_buckets")).drop("_n_buckets", "_row_hash")
                   .groupBy(key, "_bucket").applyInPandas(fn, schema))


def fan_out(df: DataFrame, call: Callable[[list], list], key: str = "station_id",
            result_type: str = "string", parallelism: int | None = None) -> DataFrame:
    """G3 as in the reference: one call per distinct key with only the key.

    ``call(keys) -> results`` gets a batch of keys at a time (inside the
    tasks, never on the driver) and returns one result per key.  The keys are
    dealt to ``parallelism`` tasks (default: the cluster's).  Calls happen at
    least once: a retried task and every action on the result repeat them, so
    a call must be safe to repeat (the key identifies it).
    """
    schema = f"{key} string, result {result_type}"
    ship_package(df.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            keys = pdf[key].tolist()
            yield pd.DataFrame({key: keys, "result": call(keys)})

    tasks = parallelism or df.sparkSession.sparkContext.defaultParallelism
    return distinct_keys(df, key).select(F.col(key).cast("string")).repartition(tasks, key).mapInPandas(run, schema)
