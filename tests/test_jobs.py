"""The spark-submit jobs, run in-process."""

from __future__ import annotations

import glob
import json

from conftest import SF_SMALL

from stationlake import jobs
from stationlake.fs import HadoopFS
from stationlake.plans.derive import info_documents, status_documents, write_history_csv
from stationlake.sources.tables import read_table
from stationlake.schemas import INFO_TABLE_SCHEMA


def _run(capsys, *argv):
    jobs.main(list(argv))
    return json.loads(capsys.readouterr().out.strip().splitlines()[-1])


def test_jobs(spark, tmp, capsys):
    events = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    T = HadoopFS(spark, f"{tmp}/status").qualify(f"{tmp}/status")

    write_history_csv(events, f"{tmp}/history")
    out = _run(capsys, "backfill", f"{tmp}/history", "--table", T, "--cutoff", "2024-01-20 00:00:00")
    assert out["job"] == "backfill"

    status_documents(events).write.text(f"{tmp}/landing")
    _run(capsys, "status-ingest", "--landing", f"{tmp}/landing", "--table", T, "--checkpoint", f"{tmp}/chk",
         "--partition-time", "document")
    n = read_table(spark, T).count()
    assert n > events.count()

    out = _run(capsys, "compact", "--table", T, "--day", "2024-01-05")
    assert out["hours"] > 0
    for h in glob.glob(f"{tmp}/status/year=2024/month=01/day=05/hour=*"):
        assert len(glob.glob(f"{h}/*.parquet")) == 1
    assert read_table(spark, T).count() == n

    out = _run(capsys, "compact", "--table", T, "--from", "2024-01-06", "--to", "2024-01-08")
    assert out["days"] == 3 and out["hours"] > 0
    for h in glob.glob(f"{tmp}/status/year=2024/month=01/day=0[678]/hour=*"):
        assert len(glob.glob(f"{h}/*.parquet")) == 1
    assert read_table(spark, T).count() == n

    out = _run(capsys, "register", "--name", "jobs_status", "--table", T, "--day", "2024-01-31")
    assert out["partitions"] == 24
    spark.sql("ALTER TABLE jobs_status RECOVER PARTITIONS")
    out = _run(capsys, "fan-out", "--name", "jobs_status", "--cache", f"{tmp}/cache",
               "--as-of", "2024-01-30 23:00:00")
    assert out["stations"] > 0

    info_documents(spark.read.parquet(f"{SF_SMALL}/supplier.parquet")).write.text(f"{tmp}/info_landing")
    _run(capsys, "info-ingest", "--landing", f"{tmp}/info_landing", "--table", f"{tmp}/info",
         "--partition-time", "document")
    info = read_table(spark, f"{tmp}/info", INFO_TABLE_SCHEMA)
    n_info = info.count()
    assert n_info == spark.read.parquet(f"{SF_SMALL}/supplier.parquet").count()
    assert {(r.year, r.month, r.day, r.hour) for r in info.select("year", "month", "day", "hour").distinct().collect()} \
        == {("2024", "01", "01", "00")}

    # the info table can be compacted and registered as well
    info_documents(spark.read.parquet(f"{SF_SMALL}/supplier.parquet")).write.mode("append").text(f"{tmp}/info_landing2")
    _run(capsys, "info-ingest", "--landing", f"{tmp}/info_landing2", "--table", f"{tmp}/info",
         "--partition-time", "document")
    assert len(glob.glob(f"{tmp}/info/year=2024/month=01/day=01/hour=00/*.parquet")) > 1
    out = _run(capsys, "compact", "--table", f"{tmp}/info", "--day", "2024-01-01", "--kind", "info")
    assert out["hours"] == 1
    assert len(glob.glob(f"{tmp}/info/year=2024/month=01/day=01/hour=00/*.parquet")) == 1
    assert read_table(spark, f"{tmp}/info", INFO_TABLE_SCHEMA).count() == 2 * n_info
    out = _run(capsys, "register", "--name", "jobs_info", "--table", f"{tmp}/info", "--day", "2024-01-01",
               "--kind", "info")
    assert spark.table("jobs_info").count() == 2 * n_info


def test_migrate_job(spark, tmp, capsys):
    from stationlake.operators.maintenance import write_legacy_tree
    from stationlake.plans.derive import station_rows
    events = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    legacy = HadoopFS(spark, f"{tmp}/legacy").qualify(f"{tmp}/legacy")
    write_legacy_tree(station_rows(events), legacy, "ingest_time")
    out = _run(capsys, "migrate", legacy, "--table", f"{tmp}/migrated")
    assert out["job"] == "migrate"
    t = read_table(spark, f"{tmp}/migrated")
    assert t.count() == events.count()
    assert t.where("num_ebikes_available is null").count() == 0  # all 10 columns carried over
