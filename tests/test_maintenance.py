"""Compaction, retirement, registration, calendar, union (FIXTURES §4)."""

from __future__ import annotations

import datetime as dt
import glob
import json
import os

import pytest
from pyspark.sql import functions as F

from stationlake.fs import HadoopFS
from stationlake.functions.paths import last_segment, trash_path, trash_path_py
from stationlake.functions.time import partition_values
from stationlake.operators.calendar import day_hours
from stationlake.operators.compaction import compact_days, compact_yesterday, recover_compactions, trash_dir, trash_location
from stationlake.operators.maintenance import (
    create_hour_table,
    register_hour_partitions,
    show_partitions,
    union_by_name,
    write_legacy_tree,
)
from stationlake.operators.query import recent_status
from stationlake.plans.derive import station_rows
from stationlake.schemas import HISTORY_KEEP, PART_COLS, STATUS_KEYS
from stationlake.sources.tables import read_legacy_tree, read_table

from conftest import SF_SMALL, plan_text


def _events(spark):
    return spark.read.parquet(f"{SF_SMALL}/events.parquet")


def _fixture(spark, root):
    """Several files per hour: wide files from 3 tasks plus narrow files."""
    rows = station_rows(_events(spark))
    wide = rows.where(F.col("num_bikes_disabled") == 0)
    narrow = rows.where(F.col("num_bikes_disabled") == 1)  # error events
    wide.select(*STATUS_KEYS, *partition_values("ingest_time")).repartition(3) \
        .write.partitionBy(*PART_COLS).parquet(root)
    narrow.select(*HISTORY_KEEP, *partition_values("ingest_time")) \
        .write.mode("append").partitionBy(*PART_COLS).parquet(root)


def _files(root, pattern="year=*/month=*/day=*/hour=*/*.parquet"):
    return glob.glob(os.path.join(root, pattern))


def _rows(spark, root):
    return sorted((tuple(r) for r in read_table(spark, root).collect()), key=repr)


def test_compact_one_day_keeps_rows_and_other_days(spark, tmp):
    root = f"{tmp}/t"
    _fixture(spark, root)
    before = _rows(spark, root)
    day = dt.date(2024, 1, 5)
    other_before = sorted(_files(root, "year=2024/month=01/day=06/hour=*/*.parquet"))
    n_day_files = len(_files(root, "year=2024/month=01/day=05/hour=*/*.parquet"))
    rep = compact_days(spark, root, [day])
    assert rep["hours"] > 0 and rep["files_before"] <= n_day_files
    assert _rows(spark, root) == before
    for h in glob.glob(f"{root}/year=2024/month=01/day=05/hour=*"):
        assert len(glob.glob(f"{h}/*.parquet")) == 1
    assert sorted(_files(root, "year=2024/month=01/day=06/hour=*/*.parquet")) == other_before
    trashed = glob.glob(f"{root}/_trash/year=2024/month=01/day=05/hour=*/*.parquet")
    assert len(trashed) == rep["files_before"]
    # narrow files kept their absent columns as NULL, wide values survived
    t = read_table(spark, root).where("day = '05'")
    assert t.where("num_ebikes_available is null").count() > 0
    assert t.where("num_ebikes_available is not null").count() > 0
    # second run: nothing left to do
    assert compact_days(spark, root, [day])["files_before"] == 0


def test_compact_yesterday_selects_previous_utc_day(spark, tmp):
    root = f"{tmp}/t"
    _fixture(spark, root)
    rep = compact_yesterday(spark, root, as_of=dt.datetime(2024, 1, 8, 0, 30))
    assert rep["hours"] > 0
    for h in glob.glob(f"{root}/year=2024/month=01/day=07/hour=*"):
        assert len(glob.glob(f"{h}/*.parquet")) == 1


def test_recover_interrupted_swap(spark, tmp):
    root = f"{tmp}/t"
    _fixture(spark, root)
    before = _rows(spark, root)
    real = HadoopFS.rename
    calls = {"n": 0}

    def crash_midway(self, src, dst):
        calls["n"] += 1
        if calls["n"] > 40:  # some old files moved to the trash
            raise RuntimeError("driver lost")
        return real(self, src, dst)

    HadoopFS.rename = crash_midway
    try:
        with pytest.raises(RuntimeError):
            compact_days(spark, root, [dt.date(2024, 1, 3), dt.date(2024, 1, 4)])
    finally:
        HadoopFS.rename = real
    assert glob.glob(f"{root}/_compaction/journal/*.json")
    assert recover_compactions(spark, root) == 1
    assert _rows(spark, root) == before
    assert not glob.glob(f"{root}/_compaction/journal/*.json")
    for h in glob.glob(f"{root}/year=2024/month=01/day=0[34]/hour=*"):
        assert len(glob.glob(f"{h}/*.parquet")) == 1


def test_late_file_is_kept(spark, tmp):
    """A file that lands in an hour after the listing is not lost."""
    import shutil
    root = f"{tmp}/t"
    _fixture(spark, root)
    hour = sorted(glob.glob(f"{root}/year=2024/month=01/day=03/hour=*"))[0]
    late = glob.glob(f"{hour}/*.parquet")[0]
    real = HadoopFS.write_text

    def add_late_file(self, path, text):  # runs right before the swap
        if "/_compaction/journal/" in path:
            shutil.copy(late, f"{hour}/late-arrival.parquet")
        return real(self, path, text)

    before = len(_rows(spark, root))
    HadoopFS.write_text = add_late_file
    try:
        compact_days(spark, root, [dt.date(2024, 1, 3)])
    finally:
        HadoopFS.write_text = real
    assert os.path.exists(f"{hour}/late-arrival.parquet")
    late_rows = spark.read.parquet(late).count()
    assert len(_rows(spark, root)) == before + late_rows


def test_trash_paths():
    assert trash_path_py("bucket/station_status/2019/08/01/18/f.parquet") == \
        "bucket/trash/station_status/2019/08/01/18/f.parquet"
    assert trash_path_py("s3://bucket/station_status/x.parquet") == "s3://bucket/trash/station_status/x.parquet"
    assert trash_location("s3a://b/t/year=2024/f.parquet", "s3a://b/t") == "s3a://b/trash/t/year=2024/f.parquet"
    assert trash_location("file:/x/t/year=2024/f.parquet", "file:/x/t") == "file:/x/t/_trash/year=2024/f.parquet"
    assert trash_dir("s3a://b/station_status") == "s3a://b/trash/station_status"
    # a table that is a whole bucket: readers must not see the trash
    assert trash_dir("s3a://b") == trash_dir("s3a://b/") == "s3a://b/_trash"
    assert trash_location("s3a://b/year=2024/f.parquet", "s3a://b/") == "s3a://b/_trash/year=2024/f.parquet"
    assert trash_dir("file:/x/t") == "file:/x/t/_trash"
    assert trash_dir("file:/x/t", "file:/y/bin") == "file:/y/bin"


def test_trash_path_columns(spark):
    df = spark.createDataFrame([("bucket/a/b/c.parquet",), ("gs://bkt/a/c.parquet",)], "p string")
    got = df.select(trash_path("p").alias("t"), last_segment("p").alias("f")).collect()
    assert [(r.t, r.f) for r in got] == [("bucket/trash/a/b/c.parquet", "c.parquet"),
                                         ("gs://bkt/trash/a/c.parquet", "c.parquet")]


def test_calendar_tomorrow_and_month_end(spark):
    cal = day_hours(spark, dt.date(2024, 1, 31), offset_days=1).collect()
    assert len(cal) == 24
    assert cal[0].path == "station_status/2024/02/01/00" and cal[-1].hour == "23"
    assert cal[0].hive_path == "year=2024/month=02/day=01/hour=00"
    y = day_hours(spark, dt.date(2024, 3, 1), offset_days=-1).collect()
    assert {r.day for r in y} == {"29"}


def test_register_legacy_tree_and_query_through_catalog(spark, tmp):
    root = HadoopFS(spark, f"{tmp}/legacy").qualify(f"{tmp}/legacy")
    write_legacy_tree(station_rows(_events(spark)), root, "ingest_time")
    assert glob.glob(f"{tmp}/legacy/2024/01/30/*/*.parquet")
    legacy = read_legacy_tree(spark, root)
    assert legacy.count() == _events(spark).count()

    name = "legacy_status_test"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    create_hour_table(spark, name, f"{tmp}/catalog_root")
    hours = legacy.select(*PART_COLS).distinct().select(
        *PART_COLS, F.concat_ws("/", F.lit(root), *PART_COLS).alias("location"))
    n = register_hour_partitions(spark, name, hours)
    register_hour_partitions(spark, name, hours)  # idempotent
    assert show_partitions(spark, name).count() == n
    q = recent_status(spark.table(name), dt.datetime(2024, 1, 30, 12))
    plan = plan_text(q)
    assert "PartitionFilters" in plan
    expected = station_rows(_events(spark)).where(
        F.to_date("ingest_time") > F.lit("2024-01-22").cast("date")).count()
    assert q.count() == expected


def test_union_by_name(spark):
    a = spark.createDataFrame([(1, "x")], "a long, b string")
    b = spark.createDataFrame([("y",), ("y",)], "b string")
    got = union_by_name([a, b]).collect()
    assert len(got) == 3 and sorted(str(r.a) for r in got) == ["1", "None", "None"]


def test_journal_is_json(spark, tmp):
    fs = HadoopFS(spark, tmp)
    fs.write_text(f"{tmp}/j/x.json", json.dumps({"a": 1}))
    assert json.loads(fs.read_text(f"{tmp}/j/x.json")) == {"a": 1}


def test_recover_partitions_for_key_value_layout(spark, tmp):
    from stationlake.operators.maintenance import recover_partitions
    from stationlake.operators.writer import write_hourly
    root = HadoopFS(spark, f"{tmp}/kv").qualify(f"{tmp}/kv")
    name = "kv_status_test"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    create_hour_table(spark, name, root)
    write_hourly(station_rows(_events(spark)), root, "ingest_time")
    assert spark.table(name).count() == 0  # files written, partitions not yet known
    recover_partitions(spark, name)
    assert spark.table(name).count() == _events(spark).count()
    hours = _events(spark).select(F.date_trunc("hour", "ts")).distinct().count()
    assert show_partitions(spark, name).count() == hours


def test_reference_style_concat_predicate_also_prunes(spark, tmp):
    """The fan-out's original form: text concat of year/month/day parsed as a date."""
    from stationlake.operators.writer import write_hourly
    root = f"{tmp}/t"
    write_hourly(station_rows(_events(spark)), root, "ingest_time")
    read_table(spark, root).createOrReplaceTempView("status_concat_test")
    q = spark.sql("""
        SELECT station_id, num_bikes_available FROM status_concat_test
        WHERE to_date(CAST(year AS STRING) || '-' || CAST(month AS STRING) || '-' || CAST(day AS STRING),
                      'yyyy-MM-dd') > TIMESTAMP_NTZ'2024-01-30 12:00:00' - INTERVAL 8 DAYS""")
    plan = plan_text(q)
    assert "PartitionFilters: [" in plan and "to_date" in plan
    same = recent_status(read_table(spark, root), dt.datetime(2024, 1, 30, 12)).count()
    assert q.count() == same


def test_compact_long_range_in_chunks(spark, tmp):
    root = f"{tmp}/t"
    _fixture(spark, root)
    before = _rows(spark, root)
    days = [dt.date(2024, 1, d) for d in range(1, 31)]
    rep = compact_days(spark, root, days, days_per_job=7)  # 5 runs
    assert rep["hours"] > 0 and rep["files_after"] <= rep["hours"] * 1
    assert _rows(spark, root) == before
    for h in glob.glob(f"{root}/year=2024/month=01/day=*/hour=*"):
        assert len(glob.glob(f"{h}/*.parquet")) == 1


def test_migrate_legacy_tree(spark, tmp):
    from stationlake.operators.maintenance import migrate_legacy
    legacy = HadoopFS(spark, f"{tmp}/legacy").qualify(f"{tmp}/legacy")
    write_legacy_tree(station_rows(_events(spark)), legacy, "ingest_time")
    migrate_legacy(spark, legacy, f"{tmp}/t")
    a = sorted(map(tuple, read_legacy_tree(spark, legacy).collect()), key=repr)
    b = sorted(map(tuple, read_table(spark, f"{tmp}/t").collect()), key=repr)
    assert a == b and len(a) == _events(spark).count()


def test_compact_day_without_files_is_a_no_op(spark, tmp):
    root = f"{tmp}/t"
    _fixture(spark, root)
    empty = dt.date(2023, 6, 1)  # no folders at all
    assert compact_days(spark, root, [empty]) == {"hours": 0, "files_before": 0, "files_after": 0, "rows": 0}
    assert compact_yesterday(spark, f"{tmp}/nothing_here", as_of=dt.datetime(2024, 1, 2))["hours"] == 0


def test_second_registration_issues_no_ddl(spark, tmp, monkeypatch):
    from stationlake.operators import maintenance as M
    name, cal = "catalog_diff_test", day_hours(spark, dt.date(2024, 1, 31))
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    create_hour_table(spark, name, f"{tmp}/root")
    hours = cal.select(*PART_COLS, F.concat_ws("/", F.lit(f"{tmp}/root"), "hive_path").alias("location"))
    assert register_hour_partitions(spark, name, hours.where("hour < '10'")) == 10
    added, real = [], M._add_partitions
    monkeypatch.setattr(M, "_add_partitions", lambda s, t, rows: (added.extend(r.hour for r in rows), real(s, t, rows)))
    assert register_hour_partitions(spark, name, hours) == 14 and sorted(added) == [f"{h:02d}" for h in range(10, 24)]
    assert register_hour_partitions(spark, name, hours) == 0 and len(added) == 14
    assert show_partitions(spark, name).count() == 24


def test_legacy_window_lists_only_its_days(spark, tmp):
    from stationlake.sources.tables import read_legacy_recent
    root = f"{tmp}/legacy"
    write_legacy_tree(station_rows(_events(spark)), root, "ingest_time")
    as_of = dt.datetime(2024, 1, 30, 12)
    recent = read_legacy_recent(spark, root, as_of)
    days = {"/".join(f.split("/")[-5:-2]) for f in recent.inputFiles()}
    assert days == {f"2024/01/{d}" for d in range(22, 31)}
    assert sorted(recent_status(recent, as_of).collect()) == sorted(recent_status(read_legacy_tree(spark, root), as_of).collect())
    assert read_legacy_recent(spark, root, dt.datetime(2030, 1, 1)).count() == 0


def test_files_outside_the_hours_are_no_part_of_a_legacy_tree(spark, tmp):
    import shutil
    root = f"{tmp}/legacy"
    write_legacy_tree(station_rows(_events(spark)), root, "ingest_time")
    n = read_legacy_tree(spark, root).count()
    for odd in ("stray.parquet", "2024/stray.parquet", "2024/01/05/notes/stray.parquet"):
        os.makedirs(os.path.dirname(f"{root}/{odd}"), exist_ok=True)
        shutil.copy(glob.glob(f"{root}/2024/01/*/*/*.parquet")[0], f"{root}/{odd}")
    assert read_legacy_tree(spark, root).count() == n
