from __future__ import annotations

import collections
import math
import re
import zlib

import numpy as np
from llm_fixtures import SF_SMALL, make_docs, ws  # noqa: F401
from pyspark.sql import functions as F

from stationlake.llm import suffix_tree as pst
from stationlake.llm.common import Workspace, fold
from stationlake.llm.queries import QUERIES

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def check_base(rows, docs):
    words = [(k, re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER))) for k, t in docs]
    held = lambda k: k is None or zlib.crc32(str(k).encode()) % 10 == 0
    count = collections.Counter()
    for k, w in words:
        if not held(k):
            count.update([*w, None])
    total, distinct = sum(count.values()), len(count)
    want = sorted((str(k), held(k), len(w) + 1, sum(count[x] > 0 for x in [*w, None]), total,
                   round(sum(math.log10((count[x] + 0.1) / (total + 0.1 * (distinct + 1))) for x in [*w, None]), 5)) for k, w in words)
    got = sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5)) for r in rows)
    assert got == want


def test_query_meets_the_contract_and_beats_single_tokens(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    rows = QUERIES["op5_suffix_tree"](spark, SF_SMALL).collect()
    check_base(rows, docs)
    held = [r for r in rows if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)
    assert all(r.score < 0 and math.isfinite(r.score) for r in rows)


def test_odd_rows(ws, make_docs):
    rows = [(1, None), (2, ""), (None, "a b"), (3, "A b c"), (3, "A b c"), (4, "a b " * 100_000), (5, "\x1c x\x85y"), (6, "new words here")]
    docs = make_docs(rows).withColumn("held", F.lit("old")).withColumn("part", F.lit(1))
    got = pst.score_documents(ws, docs, fold(folds=10) == 0).collect()
    check_base(got, rows)
    assert len({r.score for r in got if r.doc_id == 3}) == 1 and all(math.isfinite(r.score) for r in got)


def test_large_ids_beside_a_null_one(spark, ws):
    """Ids beyond 2 ** 53 in one part with a null id."""
    rows = [(k, f"a b {k}") for k in (2**53 + 1, 2**62 + 1, 2**63 - 1, -2**63, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    check_base(pst.score_documents(ws, docs, fold(folds=10) == 0).collect(), rows)


def test_long_texts_are_summed_exactly(ws, make_docs):
    """One text of six million tokens: rounding errors stay below 1e-6."""
    got = {r.doc_id: r for r in pst.score_documents(ws, make_docs([(1, "a b " * 3_000_000), (3, "a c")]), F.lit(False)).collect()}
    n, total = {"a": 3_000_001, "b": 3_000_000, "end": 2}, 6_000_004
    p = {k: math.log10((c + 0.1) / (total + 0.1 * 5)) for k, c in n.items()}
    want = math.fsum([3_000_000 * p["a"], 3_000_000 * p["b"], p["end"]])
    assert got[1].train_tokens == total and abs(got[1].base_score - want) < 1e-6


def test_empty_table_and_nothing_to_learn_from(ws, make_docs):
    assert pst.score_documents(ws, make_docs([]), F.lit(False)).collect() == []


def test_every_state_is_a_distribution_and_learns_order():
    root = np.array([0, 0.1, 0.2, 0.3, 0.3, 0.1])
    # after symbol 3 mostly 4, after 4 as in general
    pairs = {3 + 1: [(1, 20), (3, 30), (4, 900), (5, 50)], 4 + 1: [(1, 100), (2, 200), (3, 300), (4, 300), (5, 100)]}
    pairs[((4 + 1) << 20) | (3 + 1)] = [(5, 400), (4, 5)]
    totals = {c: sum(n for _, n in p) for c, p in pairs.items()}
    tree = pst.grow(root, totals, pairs)
    assert set(tree.states.tolist()) == {4, (5 << 20) | 4}  # the undiverging context is no state
    for before, earlier in ((3, 0), (3, 4), (4, 3), (5, 5)):
        p = tree.probability(np.arange(1, 6), np.full(5, before), np.full(5, earlier))
        assert abs(p.sum() - 1) < 1e-9 and (p > 0).all()
    assert tree.probability(np.array([4]), np.array([3]), np.array([0]))[0] > 0.8
    assert tree.probability(np.array([5]), np.array([3]), np.array([4]))[0] > 0.9


def test_rare_contexts_are_states_however_large_the_table(ws, make_docs):
    """A text that occurs twice among 800,000 other tokens is foreseen, whatever its share."""
    rare = " ".join(f"x{k}" for k in range(50))
    got = {r.doc_id: r for r in pst.score_documents(
        ws, make_docs([(1, "a b " * 400_000), (2, rare), (3, rare), (4, " ".join(rare.split()[::-1]))]), F.col("doc_id") == 4).collect()}
    assert got[2].score == got[3].score > -51 * 0.35 and got[4].score < -51 * 4


def brute_force(rows, held):
    """The scores by counters and the tree in memory."""
    texts = [(k, k in held, re.findall(r"[^\x20\x09-\x0D]+", t.translate(LOWER))) for k, t in rows]
    train = [w for _, h, w in texts if not h]
    seen = collections.Counter(x for w in train for x in w)
    number = {x: k for k, x in enumerate(dict.fromkeys(x for _, _, w in texts for x in w), pst.FIRST_WORD)}
    once, twice = (sum(n == m for n in seen.values()) for m in (1, 2))
    words = pst.Words(sum(seen.values()) + len(train), len(seen) + 1, len(train), min(0.95, max(0.05, once / (once + 2 * twice) if once else 0.5)))
    root = np.r_[1, words.probability(np.array([len(train), *(seen[x] for x in number)]))]
    pairs = collections.defaultdict(collections.Counter)

    def symbols(w):
        return np.array([pst.START, pst.START, *(number[x] for x in w), pst.END])

    for s in map(symbols, train):
        for a, b, x in zip(s, s[1:], s[2:]):
            pairs[int(b) + 1][int(x)] += 1
            pairs[(int(a) + 1) << 20 | int(b) + 1][int(x)] += 1
    tree = pst.grow(root, {c: sum(own.values()) for c, own in pairs.items()}, {c: sorted(own.items()) for c, own in pairs.items()})
    assert 0 < len(tree.states) < len(pairs)
    return {k: np.log10(tree.probability(s[2:], s[1:-1], s[:-2])).sum() for k, _, w in texts for s in [symbols(w)]}


def test_scores_are_those_of_the_whole_tree(spark, make_docs, monkeypatch):
    """Over several parts and buckets; also where frequent contexts are dealt over several buckets."""
    rng, rows = np.random.default_rng(7), []
    for k in range(400):
        w, at = [], 0
        for _ in range(int(rng.integers(0, 60))):
            at = (at * 7 + 3) % 90 if rng.random() < 0.4 else int(rng.zipf(1.3)) % 3000
            w.append(f"W{at}")
        rows.append((k, " ".join(w)))
    held = set(range(0, 400, 9))
    want = brute_force(rows, held)
    for hot in (pst.HOT, 40):
        monkeypatch.setattr(pst, "HOT", hot)
        got = pst.score_documents(Workspace(spark, "test"), make_docs(rows, parts=7), F.col("doc_id").isin(*held)).collect()
        assert len(got) == 400 and max(abs(r.score - want[r.doc_id]) for r in got) < 1e-9
        assert all(r.held_out == (r.doc_id in held) for r in got)


def test_without_training_documents_scores_are_zero(ws, make_docs):
    assert {(r.score, r.base_score) for r in pst.score_documents(ws, make_docs([(1, "a b"), (2, None)]), F.lit(True)).collect()} == {(0.0, 0.0)}


def test_every_part_of_a_large_batch_keeps_its_words(ws, make_docs):
    """Texts of more than a part in one batch: those after the first part, too."""
    rows = [(k, f"A{k} b c " * 600_000) for k in range(4)] + [(9, "D e f")]
    assert sum(len(t) for _, t in rows) > 2 * pst.PART_BYTES
    check_base(pst.score_documents(ws, make_docs(rows, parts=1), fold(folds=10) == 0).collect(), rows)


def test_words_and_parts_are_not_shuffled_in_one_job(ws, make_docs, monkeypatch):
    """Together their shuffle files were the most that is on disk at once."""
    plans, table = {}, Workspace.table

    def seen(self, df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return table(self, df, name)

    monkeypatch.setattr(Workspace, "table", seen)
    assert pst.score_documents(ws, make_docs([(i, f"a b c{i}") for i in range(20)]), fold(folds=10) == 0).count() == 20
    assert "FlatMapCoGroupsInArrow" in plans["numbered"] and "Join" not in plans["numbered"]


def test_one_row_a_part_and_bucket_and_no_context_seen_once(ws, make_docs, monkeypatch):
    """Words go in blocks, not one by one; what follows a context seen once is not asked for."""
    got, table = {}, Workspace.table

    def seen(self, df, name):
        out = table(self, df, name)
        if name == "of_part":
            got[name] = out.where("part >= 0").count()
        if name in ("one", "two"):
            got[name] = out.where("part >= 0").agg(F.sum("m")).first()[0]
        return out

    monkeypatch.setattr(Workspace, "table", seen)
    rows = [(1, "a b c"), (2, "A b d"), (3, "x y")]
    check_base(pst.score_documents(ws, make_docs(rows, parts=1), fold(folds=10) == 0).collect(), rows)
    # Start a, start x, a b, b c, b d; the same after start start, start a and a b.
    assert got == {"of_part": 1, "one": 5, "two": 5}


def test_numbers_are_packed_and_sorted_whatever_their_size():
    for x in ([], [0, 0], [5], [255, 256, 0], [2**40, 3, 2**64 - 1, 3, 0]):
        x = np.array(x, np.uint64)
        assert pst._spread(pst._squeezed(x), len(x)).tolist() == x.tolist()
        order, key = pst._sorted(x)
        assert order.tolist() == np.argsort(x, kind="stable").tolist() and key.tolist() == sorted(x.tolist())
        order, first, rank = pst._ranked(x)
        assert x[order][first].tolist() == sorted(set(x.tolist())) and x[order][first][rank].tolist() == x.tolist()


def test_blocks_of_unlike_widths_and_sizes_become_columns():
    """One block a part and bucket, compressed only if it is large."""
    rng = np.random.default_rng(3)
    parts = [[rng.integers(0, top, n).astype(np.uint64) for top in tops] for n, tops in ((3, (1, 2**63)), (0, (5, 5)), (20_000, (300, 7)), (2, (2**40, 1)), (9, (300, 7)))]
    blocks = [pst._blocks(columns, [0, len(columns[0])])[0] for columns in parts]
    assert len(blocks[4]) < 9 * 3 + 4 and len(blocks[2]) < 20_000 * 3
    got = pst._columns(blocks, [len(columns[0]) for columns in parts], 2)
    assert all(x.tolist() == np.concatenate([columns[c] for columns in parts]).tolist() for c, x in enumerate(got))
    a, b = np.arange(50_000, dtype=np.uint64), np.arange(50_000, dtype=np.uint64) % np.uint64(3)
    at = [0, 10, 40_000, 50_000]
    both = pst._columns(pst._blocks([a, b], at), [10, 39_990, 10_000], 2)
    assert both[0].tolist() == a.tolist() and both[1].tolist() == b.tolist()
