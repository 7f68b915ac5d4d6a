"""History CSV backfill (FIXTURES §3)."""

from __future__ import annotations

import datetime as dt

import pytest
from conftest import write_text
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from stationlake.functions.time import epoch_seconds, from_epoch_seconds
from stationlake.operators.writer import write_history
from stationlake.sources.history import normalize_history, read_history
from stationlake.sources.tables import read_table

HISTORY = """execution_time|id|available_bikes|available_docks|last_communication_time|extra
2019-07-01 10:05:03|072|3|4|2019-07-01 10:04:00|z
2019-08-01 18:52:02|73|3|4|2019-08-01 18:50:00|z
2019-08-01 18:52:03|73|3|4|2019-08-01 18:51:00|z
2019-07-01 11:05:03|74|2|4||z
|75|1|1|2019-07-01 11:00:00|z
"""
CUTOFF = "2019-08-01 18:52:03"


def test_cutoff_rename_cast(spark, tmp):
    write_text(f"{tmp}/h/a.csv", HISTORY)
    df = normalize_history(read_history(spark, f"{tmp}/h"), cutoff=CUTOFF)
    rows = sorted(df.collect(), key=lambda r: r.execution_time)
    assert [r.station_id for r in rows] == ["072", "74", "73"]
    assert rows[0].last_reported == 1561975440  # 2019-07-01 10:04:00 UTC
    assert rows[1].last_reported is None
    assert rows[0].partition_key == "2019-07-01 10"
    assert rows[2].execution_time == dt.datetime(2019, 8, 1, 18, 52, 2)
    assert df.columns == ["execution_time", "station_id", "num_bikes_available",
                          "num_docks_available", "last_reported", "partition_key"]
    assert dict(df.dtypes)["num_bikes_available"] == "bigint"


def test_columns_matched_by_name_in_any_order(spark, tmp):
    text = ("available_docks|id|last_communication_time|execution_time|available_bikes\n"
            "4|072|2019-07-01 10:04:00|2019-07-01 10:05:03|3\n")
    write_text(f"{tmp}/h/a.csv", text)
    r = normalize_history(read_history(spark, f"{tmp}/h")).collect()[0]
    assert (r.station_id, r.num_bikes_available, r.num_docks_available) == ("072", 3, 4)


def test_bad_count_raises(spark, tmp):
    write_text(f"{tmp}/h/a.csv", HISTORY)
    write_text(f"{tmp}/h/b.csv", HISTORY.splitlines()[0] + "\n2019-07-01 10:05:03|1|x|4|2019-07-01 10:04:00|z\n")
    with pytest.raises((PySparkException, Py4JJavaError)):
        normalize_history(read_history(spark, f"{tmp}/h")).collect()


def _lines(rows, columns):
    return "|".join(columns) + "\n" + "".join("|".join(r.get(c, "") for c in columns) + "\n" for r in rows)


def _history_rows(n, first=0):
    return [{"execution_time": f"2019-07-01 {k % 24:02d}:05:03", "id": f"{k:03d}", "available_bikes": str(k), "available_docks": str(1000 + k),
             "last_communication_time": f"2019-07-01 {k % 24:02d}:04:00", "extra": "e", "more": f"m{k}"} for k in range(first, first + n)]


ORDERS = [["execution_time", "id", "available_bikes", "available_docks", "last_communication_time", "extra"],
          ["id", "available_docks", "available_bikes", "execution_time", "last_communication_time"],
          ["more", "last_communication_time", "execution_time", "available_docks", "extra", "id", "available_bikes"]]


@pytest.mark.parametrize("broadcast", [100, 0])
def test_each_file_is_read_by_its_own_header(spark, tmp, monkeypatch, broadcast):
    from stationlake.sources import history
    monkeypatch.setattr(history, "BROADCAST_FILES", broadcast)
    rows = _history_rows(60)
    for k in range(6):
        write_text(f"{tmp}/h/f{k}.csv", _lines(rows[10 * k:10 * k + 10], ORDERS[k % 3]))
    raw = read_history(spark, f"{tmp}/h")
    assert set(raw.columns) == set(ORDERS[0]) | {"more"}
    by_id = {r.id: r for r in raw.collect()}
    for k, r in enumerate(rows):
        columns = ORDERS[k // 10 % 3]
        assert by_id[r["id"]].asDict() == {c: r[c] if c in columns else None for c in raw.columns}
    got = {r.station_id: r for r in normalize_history(raw).collect()}
    assert len(got) == 60 and all(got[r["id"]].num_docks_available == 1000 + int(r["id"]) for r in rows)


def test_one_header_needs_no_join(spark, tmp):
    from conftest import plan_text
    for k in range(3):
        write_text(f"{tmp}/h/f{k}.csv", _lines(_history_rows(5, 5 * k), ORDERS[1]))
    plan = plan_text(read_history(spark, f"{tmp}/h").select("id"))
    assert "Join" not in plan and "ReadSchema: struct<id:string>" in plan


def test_quoted_header_and_large_file_in_splits(spark, tmp):
    """Only a file's first block has its header."""
    rows = _history_rows(4000)
    write_text(f"{tmp}/h/a.csv", _lines(rows, ORDERS[0]))
    write_text(f"{tmp}/h/b.csv", "|".join(f'"{c}"' for c in ORDERS[1]) + "\n" + _lines(_history_rows(3, 5000), ORDERS[1]).split("\n", 1)[1])
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        got = normalize_history(read_history(spark, f"{tmp}/h"))
        assert got.count() == 4003 and got.agg(F.sum("num_bikes_available")).first()[0] == sum(range(4000)) + 5000 + 5001 + 5002
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_file_without_a_required_column_raises(spark, tmp):
    write_text(f"{tmp}/h/a.csv", HISTORY)
    write_text(f"{tmp}/h/b.csv", _lines(_history_rows(2), [c for c in ORDERS[0] if c != "available_docks"]))
    with pytest.raises(ValueError, match="b.csv"):
        read_history(spark, f"{tmp}/h")
    write_text(f"{tmp}/twice/a.csv", HISTORY + _lines(_history_rows(2), ORDERS[1]))
    with pytest.raises(ValueError, match="not one header"):
        read_history(spark, f"{tmp}/twice")


def test_backfill_write_routes_by_hour_and_reads_narrow_files(spark, tmp):
    write_text(f"{tmp}/h/a.csv", HISTORY)
    write_history(normalize_history(read_history(spark, f"{tmp}/h"), cutoff=CUTOFF), f"{tmp}/t")
    t = read_table(spark, f"{tmp}/t")
    got = sorted((r.year, r.month, r.day, r.hour, r.station_id) for r in t.collect())
    assert got == [("2019", "07", "01", "10", "072"), ("2019", "07", "01", "11", "74"),
                   ("2019", "08", "01", "18", "73")]
    assert t.where("num_ebikes_available is not null").count() == 0


def test_epoch_seconds_floor_before_1970(spark):
    df = spark.createDataFrame([("1969-12-31 23:59:59.5",), ("1970-01-01 00:00:00.5",),
                                ("2019-07-01 10:04:00",)], "t string")
    got = [r.s for r in df.select(epoch_seconds(F.col("t").cast("timestamp_ntz")).alias("s")).collect()]
    assert got == [-1, 0, 1561975440]
    back = df.select(from_epoch_seconds(epoch_seconds(F.col("t").cast("timestamp_ntz"))).alias("b")).collect()
    assert str(back[2].b) == "2019-07-01 10:04:00"
