from __future__ import annotations

import zlib
from array import array
from functools import lru_cache

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_fixtures import SF_MID, SF_SMALL, make_docs, ws  # noqa: F401
from tokenizers import Tokenizer

from stationlake.llm import packing
from stationlake.llm.queries import QUERIES
from stationlake.llm.tokens import default_tokenizer


def fewest(items, capacity):
    """The optimum, by trying for each piece every open sequence."""
    items = tuple(sorted(items, reverse=True))

    @lru_cache(None)
    def go(i, rooms):
        if i == len(items):
            return len(rooms)
        options = [go(i + 1, tuple(sorted((*rooms, capacity - items[i]))))]
        for k, r in enumerate(rooms):
            if r >= items[i]:
                options.append(go(i + 1, tuple(sorted((*rooms[:k], r - items[i], *rooms[k + 1:])))))
        return min(options)
    return go(0, ())


def tally(items):
    return {n: items.count(n) for n in set(items)}


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 20), max_size=9))
def test_search_packs_everything_and_is_optimal_on_small_inputs(items):
    runs = packing.complete_bins(tally(items), 20)
    used = [n for r in runs for n, k in r.filling for _ in range(k * r.times)]
    assert sorted(used) == sorted(items)
    assert all(sum(n * k for n, k in r.filling) <= 20 for r in runs)
    assert sum(r.times for r in runs) == fewest(items, 20)
    assert packing.lower_bound(tally(items), 20) <= fewest(items, 20)


def test_search_beats_plain_best_fit():
    items = [6, 6, 5, 5, 5, 4, 4, 4, 3, 3, 3, 2] # 50 = 5 sequences of 10
    counts = tally(items)
    assert sum(r.times for r in packing.best_fit({7: 1, 6: 1, 5: 1, 4: 2, 3: 1, 2: 1, 1: 0 + 1}, 10)) >= 4
    assert sum(r.times for r in packing.complete_bins(counts, 10)) == fewest(items, 10)


def test_frequent_lengths_and_many_tiny_pieces():
    runs = packing.complete_bins({2048: 10**9, 1: 5000, 1500: 10**6, 548: 10**6 + 1}, 2048)
    volume = 2048 * 10**9 + 5000 + 1500 * 10**6 + 548 * (10**6 + 1)
    assert sum(r.times for r in runs) == -(-volume // 2048)
    assert len(runs) < 20


def check_result(rows, docs, capacity=2048):
    """The contract, by brute force from the texts."""
    tok = Tokenizer.from_file(default_tokenizer())
    want = []
    for key, text in docs:
        ids = tok.encode(text or "", add_special_tokens=False).ids + [0]
        for p in range(0, len(ids), capacity):
            part = ids[p:p + capacity]
            want.append((key, p // capacity, p, len(part), zlib.crc32(array("I", part).tobytes())))
    order = lambda x: tuple((v is not None, v or 0) for v in x)
    assert sorted((tuple(r[:5]) for r in rows), key=order) == sorted(want, key=order)
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    counts = tally([w[3] for w in want])
    return len(sequences), packing.lower_bound(counts, capacity) if counts else 0


@pytest.mark.parametrize("sf", [SF_SMALL, SF_MID])
def test_query_meets_the_contract_and_the_lower_bound(spark, sf):
    rows = QUERIES["op1_best_fit_packing"](spark, sf).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset").collect()
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    used, bound = check_result(rows, docs)
    assert used <= bound + 1


def test_odd_rows(ws, make_docs):
    rows = [(1, None), (2, ""), (None, "a b c"), (3, "x " * 9000), (3, "x " * 9000), (3, "other"), (4, "x"), (4, "x"),
            (5, "word. " * 2048)]
    p = packing.pack(ws, make_docs(rows).selectExpr("*", "1 as row", "2 as piece", "'q' as ids", "3 as length"), default_tokenizer())
    from pyspark.sql import functions as F
    got = p.sequences().select("doc_id", "piece", "start", "length", F.crc32("ids"), "sequence_id", "offset").collect()
    check_result(got, rows)


def test_empty_table(ws, make_docs):
    p = packing.pack(ws, make_docs([]), default_tokenizer())
    assert p.sequences().collect() == []
