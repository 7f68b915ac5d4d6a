"""The versioned result cache."""

from __future__ import annotations

import datetime as dt
import os
import threading

import pytest
from conftest import write_text
from pyspark.sql import functions as F

from stationlake.fs import HadoopFS
from stationlake.operators.cache import current_version, publish_cache, read_cache, recover_cache


def result(spark, version, n=20):
    """``n`` rows that all carry the version."""
    when = dt.datetime(2024, 1, 1)
    return spark.createDataFrame([(str(k), when, version) for k in range(n)],
                                 "station_id string, last_reported timestamp_ntz, num_bikes_available long").repartition(3)


def versions(path):
    return sorted(os.listdir(f"{path}/versions"))


def test_publish_replaces_and_keeps_the_types(spark, tmp):
    publish_cache(result(spark, 1), f"{tmp}/c")
    publish_cache(result(spark, 2, 7), f"{tmp}/c")
    back = read_cache(spark, f"{tmp}/c")
    assert back.dtypes == result(spark, 0).dtypes
    assert [(r.last_reported, r.num_bikes_available) for r in back.collect()] == [(dt.datetime(2024, 1, 1), 2)] * 7


def test_reader_polling_during_publishes_never_fails(spark, tmp):
    publish_cache(result(spark, 0), f"{tmp}/c")
    seen, errors, stop = [], [], threading.Event()

    def poll():
        while not stop.is_set():
            try:
                got = read_cache(spark, f"{tmp}/c").groupBy("num_bikes_available").count().collect()
                assert len(got) == 1 and got[0]["count"] == 20, got  # one whole version
                seen.append(got[0]["num_bikes_available"])
            except Exception as e:  # noqa: BLE001
                errors.append(e)

    reader = threading.Thread(target=poll)
    reader.start()
    for k in range(1, 21):
        publish_cache(result(spark, k), f"{tmp}/c")
    stop.set()
    reader.join()
    assert not errors and seen == sorted(seen) and len(set(seen)) > 2
    assert read_cache(spark, f"{tmp}/c").first().num_bikes_available == 20


def test_a_frame_in_hand_outlives_later_publishes(spark, tmp):
    publish_cache(result(spark, 1), f"{tmp}/c")
    held = read_cache(spark, f"{tmp}/c")
    for k in range(2, 8):
        publish_cache(result(spark, k), f"{tmp}/c")
    assert {r.num_bikes_available for r in held.collect()} == {1}


def test_old_versions_go_after_their_grace(spark, tmp):
    for k in range(5):
        publish_cache(result(spark, k), f"{tmp}/c", keep=2, grace_seconds=0)
    assert len(versions(f"{tmp}/c")) == 2 == len([p for p in os.listdir(f"{tmp}/c/pointers") if not p.startswith(".")])
    assert read_cache(spark, f"{tmp}/c").first().num_bikes_available == 4
    for k in range(5, 9):
        publish_cache(result(spark, k), f"{tmp}/c", keep=2, grace_seconds=3600)
    assert len(versions(f"{tmp}/c")) == 6  # replaced less than an hour ago


@pytest.mark.parametrize("step", ["write", "pointer"])
def test_crash_keeps_the_newest_complete_version(spark, tmp, monkeypatch, step):
    publish_cache(result(spark, 1), f"{tmp}/c")

    def lost(*a, **k):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as m:
        if step == "pointer":
            m.setattr(HadoopFS, "create_new", lost)
            broken = result(spark, 2)
        else:
            broken = result(spark, 2).withColumn("num_bikes_available", F.raise_error(F.lit("bad")).cast("long"))
        with pytest.raises(Exception):
            publish_cache(broken, f"{tmp}/c")
    assert read_cache(spark, f"{tmp}/c").first().num_bikes_available == 1
    assert recover_cache(spark, f"{tmp}/c") == (step == "pointer")  # a complete version gets its pointer
    assert read_cache(spark, f"{tmp}/c").first().num_bikes_available == (2 if step == "pointer" else 1)
    assert not recover_cache(spark, f"{tmp}/c")
    publish_cache(result(spark, 3), f"{tmp}/c", grace_seconds=0)
    assert read_cache(spark, f"{tmp}/c").first().num_bikes_available == 3


def test_publishers_at_once(spark, tmp):
    threads = [threading.Thread(target=publish_cache, args=(result(spark, k), f"{tmp}/c")) for k in range(4)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert len(versions(f"{tmp}/c")) == 4
    assert len({r.num_bikes_available for r in read_cache(spark, f"{tmp}/c").collect()}) == 1


def test_plain_csv_and_no_cache(spark, tmp):
    write_text(f"{tmp}/plain/a.csv", "station_id,last_reported,num_bikes_available\n7,2024-01-01 00:00:00,3\n")
    assert [tuple(r) for r in read_cache(spark, f"{tmp}/plain").collect()] == [("7", dt.datetime(2024, 1, 1), 3)]
    assert current_version(spark, f"{tmp}/none") is None and not recover_cache(spark, f"{tmp}/none")
