"""Time expressions.

All of them are built-in Spark expressions, so they run inside whole-stage
codegen.  They work on TIMESTAMP_NTZ values holding UTC wall clock, which
keeps results independent of the session time zone.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from stationlake.schemas import PART_COLS


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def parse_ts(col) -> Column:
    """Text -> TIMESTAMP_NTZ (ISO forms such as ``2019-07-01 10:05:03``)."""
    return F.to_timestamp_ntz(_c(col))


def epoch_seconds(col) -> Column:
    """TIMESTAMP_NTZ (UTC wall clock) -> unix seconds, BIGINT, floored
    (as ``int64 nanoseconds // 10**9``: also right before 1970).  Exact
    integer arithmetic on microseconds."""
    micros = F.timestamp_diff("MICROSECOND", _ntz_epoch(), _c(col))
    whole = micros - F.pmod(micros, F.lit(1_000_000))
    return (whole / F.lit(1_000_000)).cast("bigint")


def from_epoch_seconds(col) -> Column:
    """Unix seconds -> TIMESTAMP_NTZ in UTC wall clock.

    Same instant as ``from_unixtime`` in the reference's SQL, typed as a
    timestamp (Spark's ``from_unixtime`` returns a string).
    """
    return F.timestamp_add("SECOND", _c(col), _ntz_epoch())


def _ntz_epoch() -> Column:
    # A string literal: a Python datetime literal would go through the local zone.
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def _pad(col: Column, width: int) -> Column:
    return F.lpad(col.cast("string"), width, "0")


def partition_values(ts) -> list[Column]:
    """``year, month, day, hour`` as zero-padded strings."""
    t = _c(ts)
    return [
        _pad(F.year(t), 4).alias("year"),
        _pad(F.month(t), 2).alias("month"),
        _pad(F.dayofmonth(t), 2).alias("day"),
        _pad(F.hour(t), 2).alias("hour"),
    ]


def with_partition_values(df, ts):
    """Add (or replace) the four partition columns derived from ``ts``."""
    return df.withColumns(dict(zip(PART_COLS, _unaliased(ts))))


def _unaliased(ts) -> list[Column]:
    t = _c(ts)
    return [_pad(F.year(t), 4), _pad(F.month(t), 2), _pad(F.dayofmonth(t), 2), _pad(F.hour(t), 2)]


def partition_key(ts) -> Column:
    """``yyyy-MM-dd HH`` of a timestamp (the backfill routing key)."""
    y, m, d, h = _unaliased(ts)
    return F.concat(y, F.lit("-"), m, F.lit("-"), d, F.lit(" "), h)


def partition_date(year="year", month="month", day="day") -> Column:
    """The DATE of a partition from its string columns.

    Written as ``make_date(cast ...)`` so that Catalyst keeps it a pure
    partition-column predicate (it lands in ``PartitionFilters``).
    """
    return F.make_date(_c(year).cast("int"), _c(month).cast("int"), _c(day).cast("int"))


def partition_hour_start(year="year", month="month", day="day", hour="hour") -> Column:
    return F.make_timestamp_ntz(
        _c(year).cast("int"), _c(month).cast("int"), _c(day).cast("int"),
        _c(hour).cast("int"), F.lit(0), F.lit(0),
    )


def utc_now() -> Column:
    """The current instant as UTC wall clock (TIMESTAMP_NTZ).

    ``current_timestamp`` is folded once per query, so every row of a query
    sees the same "now".
    """
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), F.localtimestamp())


def as_of_column(as_of=None) -> Column:
    """Turn an ``as_of`` argument into a TIMESTAMP_NTZ column.

    ``None`` -> now (UTC); ``datetime``/``date``/``str`` -> literal read as UTC
    wall clock (a tz-aware datetime is converted to UTC first); a Column is
    used as given (e.g. a scalar subquery ``df.select(max(ts)).scalar()``).
    """
    if as_of is None:
        return utc_now()
    if isinstance(as_of, Column):
        return as_of.cast("timestamp_ntz")
    if isinstance(as_of, dt.datetime):
        if as_of.tzinfo is not None:
            as_of = as_of.astimezone(dt.timezone.utc).replace(tzinfo=None)
        return F.lit(as_of.isoformat(sep=" ")).cast("timestamp_ntz")
    if isinstance(as_of, dt.date):
        return F.lit(as_of.isoformat()).cast("timestamp_ntz")
    return F.lit(str(as_of)).cast("timestamp_ntz")


def days_interval(days: int) -> Column:
    """A day-time interval of ``days`` days."""
    return F.make_dt_interval(F.lit(int(days)))
