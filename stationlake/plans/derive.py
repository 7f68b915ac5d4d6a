"""Station data derived from the driver's tables.

The test data has no bike feed, so station rows, feed documents and history
files are built from ``events`` (and ``supplier`` for station info) with
Spark, at whatever size those tables have:

* ``user_id`` -> ``station_id`` (text), ``floor(value)`` -> bikes,
  ``floor(value / 100)`` -> e-bikes, ``floor(value / 10)`` -> docks,
  ``error`` events -> one disabled bike and not renting, other flags fixed,
  unix seconds of ``ts`` -> ``last_reported``, ``ts`` -> ingest time.  Every
  value is present: NULL semantics are tested on hand-written fixtures;
  here NULLs only come from operators (missing columns in unions);
* a feed document holds the events of one 2-minute snapshot slot and one
  block of ``DOC_BLOCK`` consecutive event ids; event ids are unique, so no
  document (no ``collect_list`` group) holds more than ``DOC_BLOCK``
  stations however skewed the slots are;
* info: ``s_suppkey`` -> ``station_id``, ``s_name`` -> name, ``s_acctbal`` ->
  lat, ``s_nationkey`` -> lon / region / capacity.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stationlake.functions.time import epoch_seconds, partition_values
from stationlake.schemas import HISTORY_KEEP, PART_COLS, STATUS_KEYS

# Fixed values for the derivation.
SNAPSHOT_SECONDS = 120           # the reference's 2-minute status cadence
DOC_BLOCK = 500                  # event ids per feed document
INFO_LAST_UPDATED = 1704067200   # document time of the derived info feed (2024-01-01 00:00:00 UTC)
EXTRA_KEY = "legacy_id"          # a key only ``click`` stations carry


def _status_values() -> list[Column]:
    is_error = F.col("event_type") == "error"
    flag = lambda c: c.cast("bigint")
    vals = {
        "station_id": F.col("user_id").cast("string"),
        "num_bikes_available": F.floor("value").cast("bigint"),
        "num_ebikes_available": F.floor(F.col("value") / 100).cast("bigint"),
        "num_bikes_disabled": flag(is_error),
        "num_docks_available": F.floor(F.col("value") / 10).cast("bigint"),
        "num_docks_disabled": F.lit(0).cast("bigint"),
        "is_installed": F.lit(1).cast("bigint"),
        "is_renting": flag(~is_error),
        "is_returning": F.lit(1).cast("bigint"),
        "last_reported": epoch_seconds("ts"),
    }
    return [vals[k].alias(k) for k in STATUS_KEYS]


def station_rows(events: DataFrame) -> DataFrame:
    """The 10 status columns plus ``ingest_time`` (= ``ts``)."""
    return events.select(*_status_values(), F.col("ts").alias("ingest_time"))


def snapshot_slot(ts: Column | str = "ts") -> Column:
    secs = epoch_seconds(ts)
    return secs - F.pmod(secs, F.lit(SNAPSHOT_SECONDS))


def status_documents(events: DataFrame) -> DataFrame:
    """Feed documents as JSON Lines (column ``value``), one per slot and block.

    Every station carries the 10 status keys, a nested ``extra`` object
    (dropped on read) and, for ``click`` events only, ``legacy_id``.
    """
    opts = {"ignoreNullFields": "false"}
    base = [F.col(k) for k in STATUS_KEYS]
    extra = F.struct(F.col("event_type")).alias("extra")
    station = F.when(
        F.col("event_type") == "click",
        F.to_json(F.struct(*base, F.col("event_id").alias(EXTRA_KEY), extra), opts),
    ).otherwise(F.to_json(F.struct(*base, extra), opts))
    rows = events.select(
        snapshot_slot("ts").alias("slot"),
        F.floor(F.col("event_id") / DOC_BLOCK).alias("block"),
        *_status_values(), "event_type", "event_id",
    )
    docs = (rows.select("slot", "block", station.alias("station"))
            .groupBy("slot", "block").agg(F.collect_list("station").alias("stations")))
    return docs.select(F.concat(
        F.lit('{"last_updated":'), F.col("slot").cast("string"),
        F.lit(',"data":{"stations":['), F.array_join("stations", ","), F.lit("]}}"),
    ).alias("value"))


def info_documents(supplier: DataFrame) -> DataFrame:
    """Info feed documents (JSON Lines), one per block of supplier keys."""
    station = F.to_json(F.struct(
        F.col("s_suppkey").cast("string").alias("station_id"),
        F.col("s_name").alias("name"),
        F.col("s_acctbal").alias("lat"),
        F.col("s_nationkey").cast("double").alias("lon"),
        F.col("s_nationkey").cast("string").alias("region_id"),
        F.col("s_nationkey").cast("bigint").alias("capacity"),
        (F.col("s_acctbal") > 0).alias("has_kiosk"),
    ), {"ignoreNullFields": "false"})
    docs = (supplier.select(F.floor(F.col("s_suppkey") / DOC_BLOCK).alias("block"), station.alias("s"))
            .groupBy("block").agg(F.collect_list("s").alias("stations")))
    return docs.select(F.concat(
        F.lit(f'{{"last_updated":{INFO_LAST_UPDATED},"data":{{"stations":['),
        F.array_join("stations", ","), F.lit("]}}"),
    ).alias("value"))


def history_lines(events: DataFrame) -> DataFrame:
    """History rows as text columns, header names of the raw feed, in an
    order different from the normalised one; the communication time is the
    event's minute."""
    ts_text = F.col("ts").cast("string")
    return events.select(
        F.lpad(F.col("user_id").cast("string"), 3, "0").alias("id"),
        F.substring(ts_text, 1, 19).alias("execution_time"),
        F.floor(F.col("value") / 10).cast("bigint").cast("string").alias("available_docks"),
        F.concat(F.substring(ts_text, 1, 16), F.lit(":00")).alias("last_communication_time"),
        F.floor("value").cast("bigint").cast("string").alias("available_bikes"),
        F.col("event_type").alias("extra"),
    )


def write_history_csv(events: DataFrame, path: str, mixed: bool = False) -> None:
    """History files with a header.  ``mixed``: those of ``click`` events have
    their columns in another order, and lack the extra one."""
    lines = history_lines(events)
    if not mixed:
        lines.write.option("sep", "|").option("header", True).csv(path)
        return
    click = F.coalesce(F.col("extra") == "click", F.lit(False))
    other = ["available_bikes", "id", "last_communication_time", "available_docks", "execution_time"]
    lines.where(~click).write.option("sep", "|").option("header", True).mode("append").csv(path)
    lines.where(click).select(*other).write.option("sep", "|").option("header", True).mode("append").csv(path)


def write_small_files(events: DataFrame, root: str, spread: int | None = None) -> None:
    """A status table with several files per hour, as a 2-minute ingest
    leaves it: wide status files plus narrow (backfill-shaped) files.

    Each task writes one file per hour it holds.  ``spread=None`` keeps the
    input's own partitioning (no shuffle; at scale every input split adds
    its files); ``spread=n`` hashes the wide rows over ``n`` tasks first.
    """
    rows = station_rows(events)
    is_error = F.col("num_bikes_disabled") == 1  # error events: narrow files
    wide = rows.where(~is_error).select(*STATUS_KEYS, *partition_values("ingest_time"))
    if spread:
        wide = wide.repartition(int(spread), "station_id", "last_reported")
    wide.write.mode("append").partitionBy(*PART_COLS).parquet(root)
    (rows.where(is_error)
     .select(*HISTORY_KEEP, *partition_values("ingest_time"))
     .write.mode("append").partitionBy(*PART_COLS).parquet(root))


def write_landing(events: DataFrame, landing: str, files: int | None = None) -> None:
    """Feed documents as JSON Lines files in a landing folder.  ``files=None``
    keeps the aggregation's own partitioning; ``files=n`` spreads them over
    ``n`` files by a hash of the document."""
    docs = status_documents(events)
    if files:
        docs = docs.repartition(int(files), "value")
    docs.write.mode("append").text(landing)
