"""The one place where the station schemas are defined."""

from __future__ import annotations

from pyspark.sql import types as T

# The status and info keys kept from a feed, in feed order.
STATUS_KEYS = (
    "station_id",
    "num_bikes_available",
    "num_ebikes_available",
    "num_bikes_disabled",
    "num_docks_available",
    "num_docks_disabled",
    "is_installed",
    "is_renting",
    "is_returning",
    "last_reported",
)
INFO_KEYS = ("station_id", "name", "lat", "lon", "region_id", "capacity", "has_kiosk")

# Partition columns: zero-padded strings of the UTC ingest hour.
PART_COLS = ("year", "month", "day", "hour")

STATUS_SCHEMA = T.StructType(
    [T.StructField("station_id", T.StringType())]
    + [T.StructField(k, T.LongType()) for k in STATUS_KEYS[1:]]
)

INFO_SCHEMA = T.StructType(
    [
        T.StructField("station_id", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("lat", T.DoubleType()),
        T.StructField("lon", T.DoubleType()),
        T.StructField("region_id", T.StringType()),
        T.StructField("capacity", T.LongType()),
        T.StructField("has_kiosk", T.BooleanType()),
        T.StructField("last_updated", T.LongType()),
    ]
)

PART_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in PART_COLS])

# Schema used to read a status table: giving the partition columns here keeps
# them STRING (no type inference) and makes narrow (backfill) files read their
# absent columns as NULL instead of taking one file's schema.
STATUS_TABLE_SCHEMA = T.StructType(STATUS_SCHEMA.fields + PART_SCHEMA.fields)
INFO_TABLE_SCHEMA = T.StructType(INFO_SCHEMA.fields + PART_SCHEMA.fields)

# Result cache published by the trailing query.
CACHE_SCHEMA = T.StructType(
    [
        T.StructField("station_id", T.StringType()),
        T.StructField("last_reported", T.TimestampNTZType()),
        T.StructField("num_bikes_available", T.LongType()),
    ]
)

# History file header names -> station names, and the columns kept.
HISTORY_RENAMES = {
    "id": "station_id",
    "available_bikes": "num_bikes_available",
    "available_docks": "num_docks_available",
    "last_communication_time": "last_reported",
}
HISTORY_KEEP = ("station_id", "num_bikes_available", "num_docks_available", "last_reported")
