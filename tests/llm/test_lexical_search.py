from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from llm_fixtures import make_docs, ws  # noqa: F401

from stationlake.llm import lexical_search as L
from stationlake.llm.common import Workspace

WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def terms(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(docs, items, k=20):
    counted = [(i, Counter(terms(t))) for i, t in docs]
    full = [(i, c, sum(c.values())) for i, c in counted if c]
    n_docs, n_terms = len(full), sum(n for _, _, n in full)
    df = Counter(t for _, c, _ in full for t in c)
    out = []
    for item, text in items:
        scored = []
        for i, c, n in full:
            m = 75 + (25 * n * n_docs) // n_terms
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 12 * m))
                    for t in terms(text) if t in c)
            if s > 0:
                scored.append((-s, i is None, i or 0, i))
        out += [(item, rank, i, -s) for rank, (s, _, _, i) in enumerate(sorted(scored)[:k], 1)]
    return out


ODD = [(1, None), (2, ""), (3, "...\n--"), (4, "Ärger ÄRGER ärger x9_y"), (5, "a" * 300_000 + " river"), (6, "the " * 100_000 + "stone"),
       (7, "river stone"), (7, "river stone"), (None, "river stone"), (0, "river stone")]


def test_equals_brute_force(spark, ws, make_docs, monkeypatch):  # noqa: F811
    monkeypatch.setattr(L, "BATCH_ITEMS", 3)
    rng = np.random.default_rng(4)
    vocabulary = [f"w{k}" for k in range(60)]
    docs = ODD + [(10 + k, " ".join(rng.choice(vocabulary, rng.integers(1, 40)))) for k in range(200)]
    docs += [(500 + k, "river the w1 w2 w3") for k in range(60)]  # ties
    items = [(1, "river Stone the"), (2, " ".join(vocabulary[:12])), (3, "w1 w1 w1 w2"), (4, None), (5, ""), (6, "nowhere"), (None, "ärger"),
             (8, "w3 " * 5_000)]
    index = L.build_index(ws, make_docs(docs).withColumnRenamed("lang", "term"))
    table = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "'a' as item", "1 as row", "2 as rank")
    got = L.search(ws, index, table)
    assert dict(got.dtypes) == {"item_id": "bigint", "rank": "int", "doc_id": "bigint", "score": "bigint"}
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted((tuple(r) for r in got.collect()), key=key) == sorted(brute(docs, items), key=key)


def test_sketches_bound_the_scores(monkeypatch):
    """Also where many terms fold into one coordinate; the answer stays exact."""
    rng = np.random.default_rng(2)
    texts = [" ".join(f"t{x}" for x in rng.integers(0, 300, rng.integers(1, 90))) for _ in range(400)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(400), pa.int64()), pa.array(texts, pa.string())], ["doc_id", "text"])
    items = [(k, " ".join(f"t{x}" for x in rng.integers(0, 300, 6))) for k in range(20)]
    for width in (1 << 16, 16):
        monkeypatch.setattr(L, "COORDINATES", width)
        docs, df = L._index_rows(iter([batch]))
        counts = dict(zip(df.column("term").to_pylist(), df.column("df").to_pylist()))
        index = L.Index(None, 400, sum(docs.column("n_terms").to_pylist()))
        monkeypatch.setattr(L.Index, "document_frequencies", lambda self, asked: {t: counts[t] for t in asked if t in counts})
        search = L._Search(L._batch(index, items, 20))
        bound, exact = search.bounds(docs), search.exact(docs, np.arange(400))
        assert (bound >= exact).all() and (bound > exact).any() == (width == 16)
        search.look_up(docs)
        want = brute(list(enumerate(texts)), items)
        assert [(i, r + 1, int(search.doc[i, r]), int(search.score[i, r])) for i in range(20) for r in range(20) if search.score[i, r]] == want


def test_empty_tables(spark, make_docs):  # noqa: F811
    items = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    for docs, asked in (([], items), ([(1, None), (2, "")], items), ([(1, "a b")], items.where("false"))):
        own = Workspace(spark, "test")
        assert L.search(own, L.build_index(own, make_docs(docs)), asked).collect() == []
