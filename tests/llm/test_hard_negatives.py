from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from stationlake.llm import hard_negatives as H
from stationlake.llm.common import Workspace

SCHEMA = "id long, label long, vector array<long>, is_anchor boolean, row int, pivot string"


def brute(rows, n_pos=5, n_neg=10, low=30, high=90):
    """rows: (id, label, vector, is_anchor), each a row of its own."""
    live = [r for r in rows if r[1] is not None and r[2] is not None]
    width = max((len(r[2]) for r in live), default=0)
    v = [np.array(list(r[2]) + [0] * (width - len(r[2])), object) for r in live]
    order = lambda x: (-x[0], x[1] is None, x[1] or 0, x[2])
    out = []
    for a, r in enumerate(live):
        if not r[3]:
            continue
        scored = [(int((v[a] * v[b]).sum()) if width else 0, s[0], b) for b, s in enumerate(live) if b != a]
        for p, pid, _ in sorted((x for x in scored if live[x[2]][1] == r[1]), key=order)[:n_pos]:
            inside = sorted((x for x in scored if live[x[2]][1] != r[1] and low * p <= 100 * x[0] <= high * p), key=order)
            out += [(r[0], pid, k, nid, p, s) for k, (s, nid, _) in enumerate(inside[:n_neg], 1)]
    return out


def run(spark, rows):
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA).repartition(3)
    return H.mine_hard_negatives(Workspace(spark, "test"), df, F.col("is_anchor"))


def sort(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: tuple((x is None, x or 0) for x in r))


def test_equals_brute_force(spark, monkeypatch):
    """Clusters, copies, ties, several blocks and batches of anchors."""
    monkeypatch.setattr(H, "BLOCK_VALUES", 6 * 80)
    monkeypatch.setattr(H, "ANCHOR_VALUES", 6 * 8)
    monkeypatch.setattr(H, "LEAF", 8)
    rng = np.random.default_rng(7)
    centres = rng.integers(-200, 200, (6, 6))
    rows = [(k, int(rng.integers(0, 3)), (centres[rng.integers(0, 6)] + rng.integers(-40, 40, 6)).tolist(), k % 25 == 0) for k in range(500)]
    rows += [(1000 + k, k % 3, [90, 80, 70, 0, 0, 1], k == 0) for k in range(200)]  # copies
    rows += [(2000, None, [1] * 6, True), (2001, 1, None, True), (2002, 1, [5, 5], True), (2003, 2, [], True), (2004, 0, [0] * 6, True)]
    got = run(spark, rows)
    assert dict(got.dtypes) == {"anchor_id": "bigint", "positive_id": "bigint", "rank": "int", "negative_id": "bigint",
                                "positive_score": "bigint", "negative_score": "bigint"}
    assert sort(got.collect()) == sort(brute(rows))


def test_null_and_repeated_ids(spark):
    rows = [(1, 0, [10, 0], True), (1, 0, [10, 0], True), (None, 0, [9, 1], False), (2, 0, [8, 2], False),
            (None, 1, [5, 5], False), (3, 1, [5, 5], False), (3, 1, [5, 5], False)]
    assert sort(run(spark, rows).collect()) == sort(brute(rows))


def test_small_and_empty(spark):
    assert run(spark, []).collect() == []
    assert run(spark, [(1, 0, [1, 2], True)]).collect() == []
    assert run(spark, [(1, 0, [1, 2], False), (2, 0, [1, 2], False)]).collect() == []
    assert run(spark, [(1, 0, [1, 2], None), (2, None, None, True)]).collect() == []


def test_tree_covers_and_bounds():
    rng = np.random.default_rng(1)
    points = np.concatenate((rng.integers(-100, 100, (700, 5)), np.tile([3, 4, 5, 6, 7], (300, 1))))
    m2 = float((points * points).sum(1).max())
    tree = H.build_tree(points, np.arange(1000), np.arange(1000)[::-1].copy(), np.zeros(1000, np.int64), m2)
    x = H.augmented(tree.points, m2)
    assert np.allclose((x * x).sum(1), m2)
    for k in range(len(tree.parent)):
        own = slice(tree.first[k], tree.until[k])
        assert tree.first[k] <= tree.centre[k] < tree.until[k]
        assert np.sqrt(((x[own] - x[tree.centre[k]]) ** 2).sum(1)).max() <= tree.radius[k] + 1e-9
        children = np.flatnonzero(tree.parent == k)
        assert bool(len(children)) == (not tree.leaf[k]) and len(children) <= H.CHILDREN
        if len(children):  # a net: centres apart by at least every covering radius, and the node's centre is one
            c = x[tree.centre[children]]
            d = np.sqrt(((c[:, None] - c[None]) ** 2).sum(2)) + np.where(np.eye(len(c)), np.inf, 0)
            assert d.min() >= tree.radius[children].max() - 1e-9 and tree.centre[k] in tree.centre[children]
            assert sum(tree.until[children] - tree.first[children]) == tree.until[k] - tree.first[k]
    assert sorted(tree.row) == list(range(1000))


def test_far_leaves_are_not_scored(monkeypatch):
    """In clustered data a search verifies few of the leaves."""
    rng = np.random.default_rng(0)
    centres = rng.integers(-2000, 2000, (40, 8))
    points = np.concatenate([c + rng.integers(-9, 10, (50, 8)) for c in centres])
    m2 = float((points * points).sum(1).max())
    tree = H.build_tree(points, np.arange(2000), np.arange(2000), np.repeat(np.arange(40), 50), m2)
    wide = np.full(1, 2**62)
    best = H._Best(H.Wanted(points[:1], np.array([0]), np.array([0]), np.array([0]), -wide, wide, True, 5, m2))
    seen, verify = [], best.verify
    monkeypatch.setattr(best, "verify", lambda t, node, w: (seen.append(node), verify(t, node, w)))
    best.search(tree)
    s = points @ points[0]
    s[0] = -2**60
    s[50:] = -2**60
    assert best.id[0].tolist() == sorted(range(2000), key=lambda i: (-s[i], i))[:5]
    assert 0 < len(seen) <= tree.leaf.sum() / 4


def test_finite_and_quantized(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.5, -0.001]), (2, [1.0, None]), (3, [nan]), (4, [inf]), (5, [-inf]), (6, None), (7, [])]
    df = spark.createDataFrame(rows, "id long, v array<float>")
    kept = {r.id: r.q for r in df.where(H.finite("v")).select("id", H.quantized("v").alias("q")).collect()}
    assert kept == {1: [128, -1], 7: []}


@pytest.mark.parametrize("big", [2**20, 2**28])
def test_products_are_exact(big):
    rng = np.random.default_rng(3)
    a, b = rng.integers(-big, big, (4, 33)), rng.integers(-big, big, (5, 33))
    assert (H.products(a, b) == [[sum(int(x) * int(y) for x, y in zip(r, s)) for s in b] for r in a]).all()
