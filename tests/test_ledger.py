"""Calls with effects, once per key, by a ledger."""

from __future__ import annotations

import os
import subprocess
import sys
from functools import partial

import pytest
from pyspark.sql import functions as F

from stationlake.operators.ledger import call_each, finished_calls


def effect(folder, key, fail=()):
    """Leaves a line per call; may fail."""
    if key in fail:
        raise RuntimeError(f"call {key} failed")
    with open(f"{folder}/{key}", "a") as f:
        f.write("called\n")
    return f"done {key}"


def calls(folder):
    return {k: open(f"{folder}/{k}").read().count("called") for k in os.listdir(folder)}


@pytest.fixture()
def outbox(tmp):
    os.makedirs(f"{tmp}/out")
    return f"{tmp}/out"


def stations(spark, n):
    return spark.range(n).select(F.col("id").cast("string").alias("station_id"))


def test_each_key_is_called_once_over_runs_and_actions(spark, tmp, outbox):
    df = stations(spark, 30)
    first = call_each(df.union(df).union(spark.createDataFrame([(None,)], "station_id string")), partial(effect, outbox), f"{tmp}/ledger", "r1")
    assert {(r.station_id, r.result) for r in first.collect()} == {(str(k), f"done {k}") for k in range(30)}
    assert first.count() == 30  # a second action
    more = call_each(stations(spark, 45), partial(effect, outbox), f"{tmp}/ledger", "r1", parallelism=3)
    assert more.count() == 45 and calls(outbox) == {str(k): 1 for k in range(45)}
    assert call_each(stations(spark, 2), partial(effect, outbox), f"{tmp}/ledger", "r2").count() == 2  # another run calls again
    assert calls(outbox)["0"] == 2 and finished_calls(spark, f"{tmp}/ledger", "r1").count() == 45


def test_a_failed_job_leaves_what_is_finished(spark, tmp, outbox):
    with pytest.raises(Exception, match="call 17 failed"):
        call_each(stations(spark, 40), partial(effect, outbox, fail=("17",)), f"{tmp}/ledger", "r", concurrency=2, parallelism=2)
    done = {r.key for r in finished_calls(spark, f"{tmp}/ledger", "r").collect()}
    assert done and "17" not in done
    got = call_each(stations(spark, 40), partial(effect, outbox), f"{tmp}/ledger", "r", concurrency=2, parallelism=2)
    assert got.count() == 40
    again = {k for k, n in calls(outbox).items() if n > 1}
    assert not again & done  # no finished call was repeated


def test_no_keys(spark, tmp, outbox):
    assert call_each(stations(spark, 0), partial(effect, outbox), f"{tmp}/ledger", "r").collect() == []


RETRY = """
import sys
from functools import partial
from pyspark import TaskContext
from stationlake.session import build_session
from stationlake.operators.ledger import call_each
from test_ledger import calls, effect, stations

def flaky(folder, key):
    if int(key) == 33 and TaskContext.get().attemptNumber() == 0:
        raise RuntimeError("injected failure")
    return effect(folder, key)

spark = build_session("local[2,3]", 2)
got = call_each(stations(spark, 40), partial(flaky, sys.argv[1]), sys.argv[2], "r", concurrency=1, parallelism=2)
assert got.count() == 40
assert calls(sys.argv[1]) == {str(k): 1 for k in range(40)}, calls(sys.argv[1])
print("once")
"""


def test_a_retried_task_repeats_no_finished_call(tmp, outbox):
    here = os.path.dirname(os.path.abspath(__file__))
    env = dict(os.environ, PYTHONPATH=os.pathsep.join([os.path.dirname(here), here]))
    script = f"{tmp}/retry.py"
    with open(script, "w") as f:
        f.write(RETRY)
    res = subprocess.run([sys.executable, script, outbox, f"{tmp}/ledger"], capture_output=True, text=True, timeout=300, env=env)
    assert res.stdout.strip().endswith("once"), res.stderr[-2000:]
