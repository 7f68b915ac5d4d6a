from __future__ import annotations

import hashlib
import re

from hypothesis import given, settings
from hypothesis import strategies as st
from llm_fixtures import SF_MID, make_docs, ws  # noqa: F401
from pyspark.sql import functions as F

from stationlake.llm import decontaminate as dc
from stationlake.llm.queries import QUERIES

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def brute(doc, items, window):
    """(hit positions, ids of items with occurring windows)."""
    hit, names = set(), set()
    for name, item in items:
        size = min(window, len(item))
        for k in range(len(item) - size + 1 if item else 0):
            for p in range(len(doc) - size + 1):
                if doc[p:p + size] == item[k:k + size]:
                    hit |= set(range(p, p + size))
                    names.add(name)
    return hit, names


letters = st.lists(st.sampled_from("abc"), max_size=14)


@settings(max_examples=400, deadline=None)
@given(letters, st.lists(letters, max_size=5), st.integers(1, 4))
def test_scan_equals_brute_force(doc, items, window):
    named = [(str(k), item) for k, item in enumerate(items)]
    longest, names, hits = dc.SuffixAutomaton([(n, [w.encode() for w in i]) for n, i in named], window).scan([w.encode() for w in doc])
    hit, want = brute(doc, named, window)
    assert names == want
    assert sorted(p for a, b in hits for p in range(a, b)) == sorted(hit)
    whole = [len(doc[p:q]) for p in range(len(doc)) for q in range(p, len(doc) + 1)
             if any(doc[p:q] == i[k:k + q - p] for i in items for k in range(len(i) + 1))]
    assert longest == max(whole, default=0)


def expected(docs, bench):
    items = [(str(i), words(t)) for i, t in bench]
    first = {}
    for name, item in items:
        for k in range(max(0, len(item) - 12)):
            first.setdefault(tuple(item[k:k + 13]), set()).add(name)
    short = [(n, i) for n, i in items if 0 < len(i) < 13]
    for key, text in docs:
        doc = words(text)
        hit, names = brute(doc, short, 13)
        for p in range(len(doc) - 12):
            if who := first.get(tuple(doc[p:p + 13])):
                hit |= set(range(p, p + 13))
                names |= who
        yield (key, len(doc), len(hit), len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest(),
               bool(hit) and 20 * len(hit) >= len(doc))


def test_query_meets_the_contract(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_MID}/documents.parquet").collect()]
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_MID}/benchmark.parquet").collect()]
    got = QUERIES["op3_decontamination"](spark, SF_MID).collect()
    assert sorted(map(tuple, got)) == sorted(expected(docs, bench))
    assert any(r.contaminated for r in got) and not all(r.contaminated for r in got)


ITEMS = [(1, "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"), (2, "Short item"), (3, None), (4, ""),
         (None, "nameless pair"), (2, "Short item"), (5, "...")]


def odd(spark, make_docs, **options):
    rows = [(1, None), (2, ""), (None, "a Short, ITEM!"), (3, ITEMS[0][1] + " tail"), (3, ITEMS[0][1] + " tail"), (4, "x nameless pair y"),
            (5, "é " * 200_000 + "short item"), (6, "clean text")]
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    docs = make_docs(rows).withColumn("benchmark_match", F.lit("old")).withColumn("items", F.lit(1))
    return dc.match_benchmark(docs, bench, **options)


def test_odd_rows_and_several_automata(spark, make_docs):
    for block_words in (100_000, 3):
        got = odd(spark, make_docs, block_words=block_words)
        assert "items" in got.columns and got.columns.count("benchmark_match") == 1
        r = {k: [] for k in (1, 2, 3, 4, 5, 6, None)}
        for x in got.select("doc_id", "benchmark_match.*", dc.n_hit().alias("n_hit")).collect():
            r[x.doc_id].append(x)
        assert [(x.n_words, x.n_hit) for x in r[1] + r[2]] == [(0, 0), (0, 0)]
        assert r[None][0]["items"] == ["2"] and r[None][0].n_hit == 2
        assert [(x["items"], x.n_hit, x.longest) for x in r[3]] == [(["1"], 14, 14)] * 2
        assert (r[4][0]["items"], r[4][0].n_hit) == ([], 2)
        assert (r[5][0].n_words, r[5][0].n_hit, r[5][0]["items"]) == (200_002, 2, ["2"])
        assert r[6][0].n_hit == 0


def test_removal(spark, make_docs):
    kept = {r.doc_id: r.text for r in dc.remove_spans(odd(spark, make_docs)).collect()}
    assert set(kept) == {1, 2, 5, 6} and kept[1] is None and kept[5].endswith("é ") and kept[6] == "clean text"
    assert {r.text for r in dc.remove_spans(odd(spark, make_docs), coverage=None).where("doc_id = 4").collect()} == {"x  y"}
    assert {r.text for r in dc.remove_spans(odd(spark, make_docs), min_words=3, coverage=None).where("doc_id = 4").collect()} == {"x nameless pair y"}


def test_empty_tables(spark, make_docs):
    none = spark.createDataFrame([], "item_id long, text string")
    assert dc.match_benchmark(make_docs([]), none).collect() == []
    assert [dict(r.asDict()["benchmark_match"].asDict()) for r in dc.match_benchmark(make_docs([(1, "a b")]), none).collect()] == [
        {"n_words": 2, "longest": 0, "items": [], "hits": []}]
