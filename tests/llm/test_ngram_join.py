from __future__ import annotations

import random

from hypothesis import given, settings
from hypothesis import strategies as st
from llm_fixtures import SF_MID, make_docs, ws  # noqa: F401
from pyspark.sql import functions as F

from stationlake.llm import ngram_join as nj
from stationlake.llm.components import connected_components
from stationlake.llm.queries import QUERIES


def grams(text):
    w = (text or "").lower().split()
    return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def brute(docs):
    """{row: (class id, kept, links, copies)} by comparing all texts with common n-grams."""
    sets = [grams(t) for _, t in docs]
    order = [(k if k is not None else 2**63 - 1, i) for i, (k, _) in enumerate(docs)]
    parent = list(range(len(docs)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    def join(a, b):
        a, b = root(a), root(b)
        low, high = sorted((a, b), key=order.__getitem__)
        parent[high] = low

    classes, holders, links = {}, {}, {}
    for i, s in enumerate(sets):
        if s:
            classes.setdefault(s, []).append(i)
    for s, members in classes.items():
        for m in members[1:]:
            join(members[0], m)
        others = {o for g in s for o in holders.get(g, ())}
        for o in others:
            common = len(s & o)
            if 5 * common >= 4 * (len(s) + len(o) - common):
                links[s], links[o] = links.get(s, 0) + 1, links.get(o, 0) + 1
                join(members[0], classes[o][0])
        for g in s:
            holders.setdefault(g, []).append(s)
    return {i: (docs[root(i)][0] if sets[i] else docs[i][0], root(i) == i or not sets[i], links.get(sets[i], 0), len(classes.get(sets[i], [i])))
            for i in range(len(docs))}


def same(got, docs):
    want = brute(docs)
    key = lambda x: tuple((v is not None, v or 0) for v in x)
    assert sorted(((r.doc_id, r.class_id, r.n_links, r.n_copies) for r in got), key=key) == sorted(
        ((docs[i][0], c, n, m) for i, (c, _, n, m) in want.items()), key=key)
    assert sum(r.kept for r in got) == sum(k for _, k, _, _ in want.values())


def test_query_equals_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_MID}/documents.parquet").orderBy("doc_id").collect()]
    same(QUERIES["op9_ngram_join"](spark, SF_MID).collect(), docs)


def test_large_groups_in_blocks_and_odd_rows(ws, make_docs):
    rng = random.Random(3)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(60):  # near copies: one word of 120 differs
        w = list(base)
        w[rng.randrange(120)] = f"x{i}"
        rows.append((100 + i, " ".join(w)))
    rows += [(i, "exact copy of one short text that repeats") for i in range(40, 90)]
    rows += [(1, None), (2, ""), (3, " \n "), (None, "lonely text"), (None, "lonely text"), (4, "a b"), (5, "A  B"), (6, "z " * 50_000), (7, "q" * 100_000)]
    docs = make_docs(rows).withColumn("row", F.lit(1)).withColumn("kept", F.lit("old")).withColumn("bucket", F.lit(0))
    got = nj.similar_documents(ws, docs, block=8)
    assert "bucket" in got.columns and got.columns.count("row") == 1
    same(got.collect(), rows)


def test_empty_table(ws, make_docs):
    assert nj.similar_documents(ws, make_docs([])).collect() == []


def test_bands_reach_the_recall():
    bands, rows = nj.bands_for(0.8, 0.9999)
    assert bands * rows <= nj.MAX_HASHES and 1 - (1 - 0.8 ** rows) ** bands >= 0.9999


@settings(max_examples=2, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 40), st.integers(0, 40)), min_size=10, max_size=40))
def test_components(spark, edges):
    from stationlake.llm.common import Workspace

    got = {r.node: r.root for r in connected_components(Workspace(spark, "cc"), spark.createDataFrame(edges, "src long, dst long")).collect()}
    low = {v: v for e in edges for v in e}
    for _ in low:
        for a, b in edges:
            low[a] = low[b] = min(low[a], low[b])
    assert got == {v: r for v, r in low.items() if v != r}


def test_columns_named_like_internal_ones(ws, make_docs):
    text = "one two three four five six seven eight"
    docs = make_docs([(1, text), (2, text), (3, None)])
    names = ["head", "HEAD_", "_head", "key1", "key2", "n", "rep", "root", "degree", "id", "bucket", "band", "block", "other", "members", "node", "first"]
    for name in names:
        docs = docs.withColumn(name, F.lit(name))
    rows = {r.doc_id: r for r in nj.similar_documents(ws, docs).collect()}
    assert [(rows[k].class_id, rows[k].kept) for k in (1, 2, 3)] == [(1, True), (1, False), (3, True)]
    assert all(r[name] == name for r in rows.values() for name in names)
