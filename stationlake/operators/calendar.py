"""Hour calendars (C1, X9): the 24 hours of a day and their folders."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationlake.functions.paths import LEGACY_PREFIX, hive_hour_path, legacy_hour_path
from stationlake.functions.time import partition_values


def hour_calendar(days: DataFrame, day_col: str = "day_date", offset_days: int = 0,
                  prefix: str = LEGACY_PREFIX) -> DataFrame:
    """For each DATE in ``days[day_col]``, the 24 hours of the day
    ``offset_days`` later (+1: tomorrow, for registration; -1: yesterday, for
    compaction): ``hour_start, year, month, day, hour, path, hive_path``.
    """
    start = F.date_add(F.col(day_col), offset_days).cast("timestamp_ntz")
    hours = F.sequence(start, start + F.make_dt_interval(F.lit(0), F.lit(23)),
                       F.make_dt_interval(F.lit(0), F.lit(1)))
    cal = days.select(F.explode(hours).alias("hour_start"))
    cal = cal.select("hour_start", *partition_values("hour_start"))
    return cal.select("*", legacy_hour_path(prefix=prefix).alias("path"),
                      hive_hour_path().alias("hive_path"))


def day_hours(spark: SparkSession, day: dt.date, offset_days: int = 0, **kw) -> DataFrame:
    """The calendar of one day (24 rows), e.g. tomorrow relative to today."""
    days = spark.range(1).select(F.lit(day.isoformat()).cast("date").alias("day_date"))
    return hour_calendar(days, "day_date", offset_days, **kw)
