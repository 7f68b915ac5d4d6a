"""Size-planned compaction, its lease, and the trash manifest."""

from __future__ import annotations

import datetime as dt
import glob
import os
import threading
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from stationlake.fs import HadoopFS
from stationlake.operators import compaction as C
from stationlake.operators.compaction import DataFile, compact_days, compact_run, plan_bins, purge_trash, restore_run, trash_manifest
from stationlake.operators.lease import LeaseHeld, LeaseLost, TableLease
from stationlake.plans.derive import write_small_files
from stationlake.sources.tables import read_table

from conftest import SF_SMALL

DAYS = [dt.date(2024, 1, 3), dt.date(2024, 1, 4)]
HOURS = "year=2024/month=01/day=0[34]/hour=*"


@pytest.fixture()
def table(spark, tmp):
    root = f"{tmp}/t"
    write_small_files(spark.read.parquet(f"{SF_SMALL}/events.parquet"), root, spread=4)
    return root


def rows(spark, root):
    return sorted((tuple(r) for r in read_table(spark, root).collect()), key=repr)


def live(root):
    return {os.path.relpath(f, root): os.stat(f).st_mtime_ns for f in glob.glob(f"{root}/{HOURS}/*.parquet")}


# -- the plan --------------------------------------------------------------

@given(st.lists(st.integers(1, 300), max_size=40), st.integers(1, 200))
@settings(max_examples=200, deadline=None)
def test_plan_is_within_target_and_idempotent(sizes, target):
    files = [DataFile("h", f"part-{k}", s) for k, s in enumerate(sizes)]
    bins = plan_bins(files, target)
    planned = [f for b in bins for f in b]
    assert len(set(planned)) == len(planned)
    assert all(len(b) > 1 and sum(f.size for f in b) <= target for b in bins)
    # The result, however well it compressed, is left alone.
    after = [f for f in files if f not in planned]
    after += [DataFile("h", f"compact-ab-{k}-w{sum(f.weight for f in b)}.parquet", 1) for k, b in enumerate(bins)]
    assert plan_bins(after, target) == []


def test_small_new_files_join_a_compacted_one():
    files = [DataFile("h", "compact-ab-0-w90.parquet", 12), DataFile("h", "part-1", 5), DataFile("h", "part-2", 5)]
    assert plan_bins(files, 100) == [files]
    assert plan_bins(files, 95) == [files[:2]]


# -- compaction ------------------------------------------------------------

def test_hours_above_the_target_keep_several_files_and_are_left_alone(spark, table):
    before = rows(spark, table)
    sizes = dict(C.sized_files(spark, glob.glob(f"{table}/{HOURS}")))
    target = 2 * max(sizes.values())
    first = compact_days(spark, table, DAYS, target_bytes=target)
    assert first["files_before"] > first["files_after"] and rows(spark, table) == before
    per_hour = [len(glob.glob(f"{h}/*.parquet")) for h in glob.glob(f"{table}/{HOURS}")]
    assert max(per_hour) > 1  # an hour above the target
    files = live(table)
    assert compact_days(spark, table, DAYS, target_bytes=target) == {"hours": 0, "files_before": 0, "files_after": 0, "rows": 0}
    assert live(table) == files
    # A larger target merges them further, down to one file per hour.
    compact_days(spark, table, DAYS)
    assert rows(spark, table) == before
    assert all(len(glob.glob(f"{h}/*.parquet")) == 1 for h in glob.glob(f"{table}/{HOURS}"))


@pytest.mark.parametrize("after", [0, 7, 30])
def test_interrupted_moves_are_finished_by_the_next_run(spark, table, monkeypatch, after):
    before = rows(spark, table)
    real, calls = HadoopFS.rename, []

    def crash(self, src, dst):
        calls.append(src)
        if len(calls) > after:
            raise RuntimeError("driver lost")
        return real(self, src, dst)

    with monkeypatch.context() as m:
        m.setattr(HadoopFS, "rename", crash)
        with pytest.raises(RuntimeError):
            compact_run(spark, table, DAYS)
    compact_run(spark, table, DAYS)
    assert rows(spark, table) == before
    assert not glob.glob(f"{table}/_compaction/journal/*.json") and not glob.glob(f"{table}/_staging/*")
    assert all(len(glob.glob(f"{h}/*.parquet")) == 1 for h in glob.glob(f"{table}/{HOURS}"))


# -- the lease -------------------------------------------------------------

def test_two_runs_at_once_lose_and_double_nothing(spark, table, monkeypatch):
    before = rows(spark, table)
    rewrite, started = C._rewrite, threading.Event()

    def slow(*a):
        started.set()
        time.sleep(2)
        return rewrite(*a)

    monkeypatch.setattr(C, "_rewrite", slow)
    out = []
    first = threading.Thread(target=lambda: out.append(compact_run(spark, table, DAYS)))
    first.start()
    started.wait(60)
    with pytest.raises(LeaseHeld):
        compact_run(spark, table, DAYS)
    with pytest.raises(LeaseHeld):
        C.recover_compactions(spark, table)
    first.join()
    assert out[0]["files_before"] > 0 and rows(spark, table) == before


def test_a_run_that_was_taken_over_changes_nothing(spark, table, monkeypatch):
    """The first run's lease runs out while it rewrites; the second takes over."""
    before = rows(spark, table)
    rewrite, second = C._rewrite, []

    def slow(*a):
        n = rewrite(*a)
        if not second:
            second.append(None)
            time.sleep(0.3)
            second[0] = compact_run(spark, table, DAYS)
        return n

    monkeypatch.setattr(C, "_rewrite", slow)
    with pytest.raises(LeaseLost):
        compact_run(spark, table, DAYS, lease_seconds=0.2)
    assert second[0]["files_before"] > 0 and rows(spark, table) == before
    assert not glob.glob(f"{table}/_staging/*") and not glob.glob(f"{table}/_compaction/journal/*.json")
    assert compact_run(spark, table, DAYS)["files_before"] == 0


def test_take_over_between_journal_and_moves(spark, table, monkeypatch):
    """Both runs make the same moves: the second finishes the first's journal."""
    before = rows(spark, table)
    finish, second = C._finish, []

    def slow(fs, root, journal, moves=None):
        if not second:
            second.append(None)
            time.sleep(0.3)
            second[0] = compact_run(spark, table, DAYS)
        finish(fs, root, journal, moves)

    monkeypatch.setattr(C, "_finish", slow)
    compact_run(spark, table, DAYS, lease_seconds=0.2)
    assert second[0]["files_before"] == 0 and rows(spark, table) == before


def test_lease_numbers_grow_and_release(spark, tmp):
    fs = HadoopFS(spark, tmp)
    for k in range(1, 5):
        with TableLease(fs, tmp) as lease:
            assert lease.number == k
            lease.check()
            with pytest.raises(LeaseHeld):
                TableLease(fs, tmp).acquire()
    old = TableLease(fs, tmp, seconds=0).acquire()
    new = TableLease(fs, tmp).acquire()
    assert new.number == old.number + 1
    with pytest.raises(LeaseLost):
        old.check()
    assert len(glob.glob(f"{tmp}/_compaction/lease/*")) <= 4


def test_only_one_of_many_gets_the_lease(spark, tmp):
    fs, got = HadoopFS(spark, tmp), []

    def attempt():
        try:
            got.append(TableLease(fs, tmp).acquire())
        except LeaseHeld:
            pass

    threads = [threading.Thread(target=attempt) for _ in range(12)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert len(got) == 1


# -- the trash -------------------------------------------------------------

def test_manifest_restore_and_purge(spark, table):
    before, files = rows(spark, table), live(table)
    rep = compact_run(spark, table, DAYS)
    manifest = trash_manifest(spark, table).collect()
    assert len(manifest) == rep["files_before"]
    base = HadoopFS(spark, table).qualify(table)
    for r in manifest:
        assert r.trash_path == f"{base}/_trash/{r.path[len(base) + 1:]}"
        path = r.trash_path.removeprefix("file:")
        assert os.path.getsize(path) == r.bytes and not os.path.exists(r.path.removeprefix("file:"))
    assert restore_run(spark, table, manifest[0].run) == rep["files_before"]
    assert set(live(table)) == set(files) and rows(spark, table) == before
    assert trash_manifest(spark, table).count() == 0
    with pytest.raises(ValueError):
        restore_run(spark, table, manifest[0].run)

    rep = compact_run(spark, table, DAYS)
    run = trash_manifest(spark, table).first().run
    assert purge_trash(spark, table, before_run=run) > 0  # what the restored run had made
    assert trash_manifest(spark, table).count() == rep["files_before"]
    assert purge_trash(spark, table) == rep["files_before"]
    assert glob.glob(f"{table}/_trash/**/*.parquet", recursive=True) == [] and rows(spark, table) == before


def test_restore_is_refused_after_a_later_compaction(spark, table):
    sizes = dict(C.sized_files(spark, glob.glob(f"{table}/{HOURS}")))
    compact_run(spark, table, DAYS, target_bytes=2 * max(sizes.values()))
    first = trash_manifest(spark, table).first().run
    before = rows(spark, table)
    compact_run(spark, table, DAYS)
    second = trash_manifest(spark, table).where(f"run != '{first}'").first().run
    with pytest.raises(ValueError, match="no longer"):
        restore_run(spark, table, first)
    restore_run(spark, table, second)
    restore_run(spark, table, first)
    assert rows(spark, table) == before and trash_manifest(spark, table).count() == 0
