from __future__ import annotations

import os
import sys

import pytest

_HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, os.path.dirname(_HERE))
# Python workers import functions defined in test modules by name.
os.environ["PYTHONPATH"] = os.pathsep.join(
    [_HERE, os.path.dirname(_HERE)] + [p for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p])

from stationlake.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    # spark.checkpoint.dir comes from the environment's Spark settings; when
    # it is unset, stationlake.session.checkpoint_root makes a local one.
    s = build_session("local[*]", 8, app_name="stationlake-tests")
    yield s
    s.stop()


@pytest.fixture()
def tmp(tmp_path):
    return str(tmp_path)


def write_text(path: str, text: str) -> str:
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)
    return path


def plan_text(df) -> str:
    """The formatted physical plan (what ``df.explain("formatted")`` prints)."""
    jvm = df.sparkSession.sparkContext._jvm
    return jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
