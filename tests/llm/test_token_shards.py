from __future__ import annotations

import zlib
from array import array

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from llm_fixtures import SF_SMALL, make_docs, ws  # noqa: F401
from tokenizers import Tokenizer

from stationlake.llm import token_shards as ts
from stationlake.llm.queries import QUERIES
from stationlake.llm.tokens import default_tokenizer


def expected(docs):
    tok, start, out = Tokenizer.from_file(default_tokenizer()), 0, []
    for key, text in sorted(docs, key=lambda d: (d[0] is not None, d[0])):
        ids = tok.encode(text or "", add_special_tokens=False).ids + [2]
        out.append((key, start, len(ids), zlib.crc32(array("I", ids).tobytes())))
        start += len(ids)
    return out


def test_query_meets_the_contract(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    got = QUERIES["op10_token_shards"](spark, SF_SMALL).select("doc_id", "start", "n_tokens", "ids_crc32").collect()
    assert sorted(map(tuple, got)) == expected(docs)


@settings(max_examples=50, deadline=None)
@given(st.integers(0, 3000), st.integers(0, 2**32))
def test_function_is_minimal_and_perfect(n, seed):
    h1, h2 = np.random.default_rng(seed).integers(0, 2**64, (2, n), dtype=np.uint64)
    sizes, bits, slot = ts.build_function(h1, h2)
    assert sorted(slot) == list(range(n))
    assert (ts.find_slots(h1, h2, sizes, bits) == slot).all()


def build(ws, docs, shard_text_bytes):
    ts.write_shards(docs, ws.root, default_tokenizer(), 2, shard_text_bytes)
    records = ws.table(ts.scan_records(ws.spark, ws.root), "records")
    return ts.write_index(records, ts.shard_bases(records), ws.root)


def test_many_shards_repeated_and_null_keys_and_absent_keys(ws, make_docs):
    # one doc_id holds a third of the rows and spans shards
    rows = [(i, f"word{i} " * (i % 7)) for i in range(60)] + [(30, "same text")] * 20 + [(30, f"t{i}") for i in range(20)]
    rows += [(None, "no key"), (None, None), (61, ""), (62, None)]
    docs = make_docs(rows).withColumn("shard", F.lit(7)).withColumn("record", F.lit("x"))
    n = build(ws, docs, 200)
    assert ws.spark.read.format("binaryFile").load(f"{ws.root}/ids").count() > 5
    got = (ts.lookup(ts.keys_of(docs), ws.root, n)
           .join(ts.payloads(ws.spark, ws.root), ["shard", "offset"])
           .select("doc_id", "occurrence", "start", "n_ids", F.crc32("ids").alias("crc")).collect())
    assert len(got) == len(rows) and len({(r.doc_id, r.occurrence) for r in got}) == len(rows)
    end = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == end
        end += r.n_ids
    ids = [r.doc_id if r.doc_id is not None else -1 for r in sorted(got, key=lambda r: r.start)]
    assert ids == sorted(ids)
    want = [(k, n, c) for k, _, n, c in expected(rows)]
    key = lambda x: (x[0] is not None, *[v or 0 for v in x])
    assert sorted([(r.doc_id, r.n_ids, r.crc) for r in got], key=key) == sorted(want, key=key)
    absent = ws.spark.createDataFrame([(999, 0), (30, 41)], "doc_id long, occurrence long")
    assert ts.lookup(absent, ws.root, n).count() == 0


def test_empty_table(ws, make_docs):
    docs = make_docs([])
    n = build(ws, docs, 200)
    assert ts.lookup(ts.keys_of(docs), ws.root, n).collect() == []


@pytest.mark.parametrize("end_id", [200, 40_000, -1, 70_000, 128])
def test_end_ids_that_cannot_be_separators_are_refused(ws, make_docs, end_id):
    with pytest.raises(ValueError, match="separator"):
        ts.write_shards(make_docs([(1, "a b")]), ws.root, default_tokenizer(), end_id=end_id)
