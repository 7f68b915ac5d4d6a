"""Fixtures and paths of the subpackage's tests (import what a test uses)."""

from __future__ import annotations

import pytest
from pyspark.sql import types as T

from stationlake.llm.common import Workspace

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType())])


@pytest.fixture()
def make_docs(spark):
    """Documents from (doc_id, text) pairs; further columns are filled in."""
    def make(rows, parts=3):
        full = [(i, t, "en", "src0", len(t) if t is not None else None) for i, t in rows]
        return spark.createDataFrame(full, DOCS).repartition(parts) if full else spark.createDataFrame([], DOCS)
    return make


@pytest.fixture()
def ws(spark):
    return Workspace(spark, "test")
