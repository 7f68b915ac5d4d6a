"""File-source stream into hourly folders, exactly once."""

from __future__ import annotations

import json

import pytest
from conftest import SF_SMALL, write_text

from stationlake.fs import HadoopFS
from stationlake.functions.time import from_epoch_seconds
from stationlake.plans.derive import status_documents
from stationlake.sources.feeds import read_feed, status_rows
from stationlake.sources.tables import read_table
from stationlake.streaming.ingest import HourlyBatchSink, run_available, status_stream


def _doc(ts, sid, bikes):
    return json.dumps({"last_updated": ts, "data": {"stations": [
        {"station_id": sid, "num_bikes_available": bikes, "num_ebikes_available": 0,
         "num_bikes_disabled": 0, "num_docks_available": 5, "num_docks_disabled": 0,
         "is_installed": 1, "is_renting": 1, "is_returning": 1, "last_reported": ts - 30}]}})


def test_two_runs_add_nothing_and_new_files_are_picked_up(spark, tmp):
    land, root, ckpt = f"{tmp}/landing", f"{tmp}/table", f"{tmp}/ckpt"
    write_text(f"{land}/a.json", _doc(1564685000, "72", 3) + "\n")
    write_text(f"{land}/b.json", _doc(1564688600, "73", 4) + "\n")
    run_available(spark, land, root, ckpt)
    run_available(spark, land, root, ckpt)
    t = read_table(spark, root)
    assert t.count() == 2
    assert sorted((r.hour, r.station_id) for r in t.collect()) == [("18", "72"), ("19", "73")]  # 18:43 and 19:43 UTC
    write_text(f"{land}/c.json", _doc(1564692200, "74", 1) + "\n")
    run_available(spark, land, root, ckpt)
    assert read_table(spark, root).count() == 3


def test_replayed_batch_is_not_written_twice(spark, tmp):
    land, root = f"{tmp}/landing", f"{tmp}/table"
    status_documents(spark.read.parquet(f"{SF_SMALL}/events.parquet")).write.text(land)
    assert status_stream(spark, land).isStreaming
    # the content of one micro-batch, as a static frame
    static = status_rows(read_feed(spark, land)).withColumn("ingest_time", from_epoch_seconds("last_updated"))
    sink = HourlyBatchSink(root, "t1")
    sink(static, 0)
    sink(static, 0)  # replay after the commit record: no-op
    n = read_table(spark, root).count()
    assert n == static.count()
    # crash between staging and commit record: the replay finishes the move only
    sink2 = HourlyBatchSink(root, "t2")
    real = HadoopFS.write_text
    state = {"n": 0}

    def fail_on_done(self, path, text):
        if path.endswith("/t2/1"):
            state["n"] += 1
            raise RuntimeError("driver lost")
        return real(self, path, text)

    HadoopFS.write_text = fail_on_done
    try:
        try:
            sink2(static, 1)
        except RuntimeError:
            pass
    finally:
        HadoopFS.write_text = real
    assert state["n"] == 1
    sink2(static, 1)
    assert read_table(spark, root).count() == 2 * n


def test_processing_time_partitions_use_now(spark, tmp):
    import datetime as dt
    land, root, ckpt = f"{tmp}/landing", f"{tmp}/table", f"{tmp}/ckpt"
    write_text(f"{land}/a.json", _doc(1564685000, "72", 3) + "\n")
    before = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    run_available(spark, land, root, ckpt, partition_time="processing")
    after = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    r = read_table(spark, root).collect()[0]
    stamp = dt.datetime(int(r.year), int(r.month), int(r.day), int(r.hour))
    assert before.replace(minute=0, second=0, microsecond=0) <= stamp <= after


def test_archive_moves_processed_documents(spark, tmp):
    import os
    land, root, ckpt, arch = f"{tmp}/landing", f"{tmp}/table", f"{tmp}/ckpt", f"{tmp}/archive"
    write_text(f"{land}/a.json", _doc(1564685000, "72", 3) + "\n")
    write_text(f"{land}/b.json", _doc(1564688600, "73", 4) + "\n")
    run_available(spark, land, root, ckpt, max_files_per_trigger=1, archive_dir=arch)
    write_text(f"{land}/c.json", _doc(1564692200, "74", 1) + "\n")
    run_available(spark, land, root, ckpt, archive_dir=arch)
    assert read_table(spark, root).count() == 3
    archived = [f for _, _, fs in os.walk(arch) for f in fs if f.endswith(".json")]
    assert len(archived) >= 1  # files of completed batches are moved out of the landing folder


def test_publish_into_registered_empty_hour_and_existing_hour(spark, tmp):
    import os
    from stationlake.operators.writer import publish_staged, write_hourly
    root, staging = f"{tmp}/table", f"{tmp}/staging"
    static = status_rows(read_feed(spark, _write_two_docs(tmp))).withColumn(
        "ingest_time", from_epoch_seconds("last_updated"))
    os.makedirs(f"{root}/year=2019/month=08/day=01/hour=18")  # registered, still empty
    write_hourly(static.where("station_id = '73'"), root, "ingest_time")  # hour 19 has a file
    write_hourly(static, staging, "ingest_time")
    assert publish_staged(spark, staging, root) == 2
    assert not glob_nested(root)
    rows = sorted((r.hour, r.station_id) for r in read_table(spark, root).collect())
    assert rows == [("18", "72"), ("19", "73"), ("19", "73")]


def _write_two_docs(tmp):
    land = f"{tmp}/two"
    write_text(f"{land}/a.json", _doc(1564685000, "72", 3) + "\n" + _doc(1564688600, "73", 4) + "\n")
    return land


def glob_nested(root):
    import glob
    return glob.glob(f"{root}/year=*/month=*/day=*/hour=*/hour=*")


def test_bad_documents_diverted_or_fatal(spark, tmp):
    import glob
    from pyspark.errors import PySparkException
    from py4j.protocol import Py4JJavaError
    land, root, bad = f"{tmp}/landing", f"{tmp}/table", f"{tmp}/bad"
    write_text(f"{land}/a.json", _doc(1564685000, "72", 3) + "\n" + '{"last_updated": 1, "data": {"stat' + "\n")
    run_available(spark, land, root, f"{tmp}/ckpt", bad_records_dir=bad)
    assert read_table(spark, root).count() == 1
    quarantined = spark.read.text(glob.glob(f"{bad}/batch=*")[0]).collect()
    assert len(quarantined) == 1 and quarantined[0].value.startswith('{"last_updated": 1')
    with pytest.raises((PySparkException, Py4JJavaError)):
        run_available(spark, land, f"{tmp}/table2", f"{tmp}/ckpt2")


def test_processing_time_trigger_keeps_running(spark, tmp):
    from stationlake.streaming.ingest import start_ingest
    land, root = f"{tmp}/landing", f"{tmp}/table"
    write_text(f"{land}/a.json", _doc(1564685000, "72", 3) + "\n")
    q = start_ingest(spark, land, root, f"{tmp}/ckpt", processing_time="1 second")
    try:
        q.processAllAvailable()
        assert read_table(spark, root).count() == 1
        write_text(f"{land}/b.json", _doc(1564688600, "73", 4) + "\n")
        q.processAllAvailable()
        assert read_table(spark, root).count() == 2
        assert q.isActive
    finally:
        q.stop()


def test_replay_after_crash_inside_publish(spark, tmp):
    land, root = f"{tmp}/landing", f"{tmp}/table"
    status_documents(spark.read.parquet(f"{SF_SMALL}/events.parquet")).write.text(land)
    static = status_rows(read_feed(spark, land)).withColumn("ingest_time", from_epoch_seconds("last_updated"))
    n = static.count()
    sink = HourlyBatchSink(root, "t3")
    real = HadoopFS.rename_many

    def half_then_crash(self, pairs, threads=16):
        pairs = list(pairs)
        real(self, pairs[: len(pairs) // 2], threads)
        raise RuntimeError("driver lost")

    HadoopFS.rename_many = half_then_crash
    try:
        try:
            sink(static, 7)
        except RuntimeError:
            pass
    finally:
        HadoopFS.rename_many = real
    assert 0 < read_table(spark, root).count() < n  # half of the hours published
    sink(static, 7)                                 # the replay finishes the move
    assert read_table(spark, root).count() == n
    sink(static, 7)                                 # and is a no-op afterwards
    assert read_table(spark, root).count() == n


def test_failed_rename_loses_nothing(spark, tmp):
    land, root = f"{tmp}/landing", f"{tmp}/table"
    status_documents(spark.read.parquet(f"{SF_SMALL}/events.parquet")).write.text(land)
    static = status_rows(read_feed(spark, land)).withColumn("ingest_time", from_epoch_seconds("last_updated"))
    n = static.count()
    sink = HourlyBatchSink(root, "t5")
    real = HadoopFS.rename

    def one_fails(self, src, dst):
        if "hour=07" in src:
            raise OSError("rename failed")
        real(self, src, dst)

    HadoopFS.rename = one_fails
    try:
        with pytest.raises(OSError):
            sink(static, 0)
    finally:
        HadoopFS.rename = real
    sink(static, 0)
    assert read_table(spark, root).count() == n


class _Refuses:
    """A file system whose renames do nothing and say so."""

    def __init__(self, fs):
        self._fs = fs

    def rename(self, *paths):
        return False

    def __getattr__(self, name):
        return getattr(self._fs, name)


def test_rename_that_returns_false_raises(spark, tmp):
    write_text(f"{tmp}/a/x.txt", "1")
    fs = HadoopFS(spark, tmp)
    real, fs._fs = fs._fs, _Refuses(fs._fs)
    with pytest.raises(OSError, match="rename failed"):
        fs.rename(f"{tmp}/a/x.txt", f"{tmp}/a/y.txt")
    with pytest.raises(OSError, match="rename failed"):
        fs.rename_many([(f"{tmp}/a/x.txt", f"{tmp}/a/y.txt")])
    fs._fs = real
    fs.rename(f"{tmp}/a/x.txt", f"{tmp}/a/y.txt")
    fs.rename(f"{tmp}/a/y.txt", f"{tmp}/a/z.txt")
    assert fs.exists(f"{tmp}/a/z.txt")


def test_fresh_checkpoint_and_respelled_path(spark, tmp):
    """A new checkpoint at the same path is a new stream: its batch 0 is
    written although another batch 0 was; the same checkpoint under another
    spelling replays nothing."""
    import os
    root = f"{tmp}/table"
    write_text(f"{tmp}/land1/a.json", _doc(1564685000, "72", 3) + "\n")
    write_text(f"{tmp}/land2/b.json", _doc(1564685000, "73", 4) + "\n")
    run_available(spark, f"{tmp}/land1", root, f"{tmp}/ckpt")
    run_available(spark, f"{tmp}/land1", root, f"file:{tmp}/ckpt/")
    assert read_table(spark, root).count() == 1
    os.rename(f"{tmp}/ckpt", f"{tmp}/old-ckpt")
    run_available(spark, f"{tmp}/land2", root, f"{tmp}/ckpt")
    assert {r.station_id for r in read_table(spark, root).collect()} == {"72", "73"}


def test_sink_outside_a_query_needs_a_tag(spark, tmp):
    land = f"{tmp}/landing"
    write_text(f"{land}/a.json", _doc(1564685000, "72", 3) + "\n")
    static = status_rows(read_feed(spark, land)).withColumn("ingest_time", from_epoch_seconds("last_updated"))
    with pytest.raises(ValueError, match="tag"):
        HourlyBatchSink(f"{tmp}/table")(static, 0)
