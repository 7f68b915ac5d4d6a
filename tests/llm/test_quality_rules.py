from __future__ import annotations

import random
import re
from collections import Counter

import pyarrow as pa
import pytest
from llm_fixtures import SF_MID, make_docs, ws  # noqa: F401
from pyspark.sql import functions as F

from stationlake.llm import quality_rules as Q
from stationlake.llm.queries import QUERIES


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    covered = {i + j for i, w in enumerate(windows) if often[w] > 1 for j in range(3)}
    return {"n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
            "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered), "n_lines": len(lines)}


ODD = [None, "", " \t\n\x0b\x0c\r ", "a", "a a a a", "a b c a b c", "x y\nx y\n\n  \nx y", "#*$%&|<> é# ñ w", "\x1cw \x85v", "one\rtwo\nthree"]


def test_measures_equal_brute_force():
    rng = random.Random(5)
    texts = ODD + ["".join(rng.choices(["a", "b", " ", "  ", "\n", "é", "#", "c d e "], k=rng.randrange(60))) for _ in range(300)]
    texts.append("word and word " * 50_000)
    for arr in (pa.array(texts, pa.string()), pa.array([None, *texts], pa.string()).slice(1)):
        got = Q.measure_texts(arr)
        for k, t in enumerate(texts):
            assert {m: int(got[m][k]) for m in Q.MEASURES} == brute(t), t
    assert all(len(v) == 0 for v in Q.measure_texts(pa.array([], pa.string())).values())


def test_pairs_stay_exact_where_keys_would_overflow():
    import numpy as np
    rng = np.random.default_rng(1)
    high, low = rng.integers(0, 50, 500) * 2**55, rng.integers(0, 9, 500)
    key, _ = Q._ranks(high, 2**62, low, 9)
    assert len(np.unique(key)) == len(set(zip(high, low)))


def words(n, seed=0):
    rng = random.Random(seed)
    return " ".join("".join(rng.choices("abcdefgh", k=5)) for _ in range(n))


def corpus():
    """A bad host, good ones, one of a single bad document, and no host."""
    rows = [(i, words(80, i), "good") for i in range(60)]
    rows += [(1000 + i, words(80 if i % 7 else 9, i), f"usual{i % 20}") for i in range(400)]
    rows += [(100 + i, words(10, i), "bad") for i in range(45)] + [(150 + i, words(80, 200 + i), "bad") for i in range(5)]
    rows += [(200, words(3), "tiny"), (300, words(80, 7), None), (301, words(4), None), (None, None, "good"), (302, "", "good")]
    return rows + [rows[0], rows[0]]


@pytest.mark.parametrize("broadcast_hosts", [100, 0])
def test_bad_hosts_lose_all_documents(spark, ws, broadcast_hosts):  # noqa: F811
    docs = spark.createDataFrame([(*r, 9, "x", 1, "k") for r in corpus()],
                                 "doc_id long, text string, source string, rejected_host int, salt string, host_of int, KEPT string")
    got = Q.judge(ws, docs, F.col("source"), broadcast_hosts=broadcast_hosts)
    rows = got.collect()
    assert len(rows) == len(corpus())
    assert {"rejected_host", "salt", "host_of", "text"} <= set(got.columns) and got.columns.count("kept") == 1
    for r in rows:
        own = brute(r.text)
        failed = own["n_words"] < 50 or 2 * own["n_repeat_words"] > own["n_words"]
        assert r.base_failed == failed and r.host == r.source and r.salt == "x"
        assert r.host_rejected == (r.source == "bad"), r
        assert r.kept == (not failed and r.source != "bad")


def test_rates_shrink_towards_all_hosts(spark, ws):  # noqa: F811
    docs = spark.createDataFrame(corpus(), "doc_id long, text string, source string")
    rates, priors = Q.host_rates(Q.measure(docs.withColumn("host", F.col("source"))))
    by = {r.host: r for r in rates.collect()}
    p = priors["few_words"]
    for r in by.values():
        assert r.rate_few_words == pytest.approx((r.failed_few_words + p.a) / (r.n_docs + p.a + p.b))
    assert by["tiny"].failed_few_words == by["tiny"].n_docs == 1 and by["tiny"].rate_few_words < 0.99
    assert not by["tiny"].rejected or by["tiny"].rate_few_words > Q.HOST_LIMIT


def test_prior_by_moments():
    import numpy as np
    rng = np.random.default_rng(3)
    n, p = rng.integers(20, 400, 4000), rng.beta(2, 6, 4000)
    k = rng.binomial(n, p)
    got = Q.fit_prior(len(n), int(n.sum()), int(k.sum()), float((n * n).sum()), float((k * k / n).sum()))
    assert got.a == pytest.approx(2, rel=0.15) and got.b == pytest.approx(6, rel=0.15)
    alike = rng.binomial(n, 0.25)  # hosts that do not differ: a strong prior
    got = Q.fit_prior(len(n), int(n.sum()), int(alike.sum()), float((n * n).sum()), float((alike * alike / n).sum()))
    assert got.a + got.b > 500
    for sums in ((0, 0, 0, 0.0, 0.0), (1, 9, 3, 81.0, 1.0), (3, 9, 0, 27.0, 0.0), (3, 9, 9, 27.0, 9.0)):
        own = Q.fit_prior(*sums)
        assert own.a + own.b == pytest.approx(1 / Q.DEFAULT_CORRELATION - 1)


def test_empty_table_and_whole_query(spark, ws, make_docs):  # noqa: F811
    assert Q.judge(ws, make_docs([]), F.col("source")).collect() == []
    got = QUERIES["op11_quality_rules"](spark, SF_MID)
    assert dict(got.dtypes) == {"doc_id": "bigint", "base_failed": "boolean", "kept": "boolean"} | {m: "bigint" for m in Q.MEASURES[:5]}
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_MID}/documents.parquet").collect()}
    rows = got.collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        assert {m: r[m] for m in Q.MEASURES[:5]} == {m: brute(texts[r.doc_id])[m] for m in Q.MEASURES[:5]}
        assert not (r.base_failed and r.kept)
    assert sum(r.kept for r in rows) > 0.5 * len(rows)
