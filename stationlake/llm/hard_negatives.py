"""Hard-negative mining by maximum inner products in cover trees.

Candidates are dealt into blocks of nearby vectors (by the nearest of a few
pivots; a pivot's block of many rows, such as copies of one vector, is split
further).  Every block gets a cover tree over its norm-augmented vectors: a
vector x becomes (x, sqrt(M^2 - |x|^2)) with M the largest norm, so that
its distance to an anchor (q, 0) gives the inner product,
2 q.x = M^2 + |q|^2 - distance^2.  The children of a node form a net of its
points: their centres are at least a radius apart and cover the points
within it.  A node keeps the exact covering radius of its points; with the
anchor's distance to its centre this bounds all their inner products.

A search goes down level by level: a node bounds its children, too.  Every
anchor first goes to the leaf of its highest bound, which gives it a
threshold; then the leaves are taken in descending order of bound and
verified exactly, in integers, for those anchors whose threshold they can
reach.  A leaf that lies outside an anchor's window of scores, above or
below, is skipped.  Anchors pass through in batches of bounded size, each
against all blocks; the blocks' best are merged.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stationlake.llm.common import Workspace, numbered, parts_for
from stationlake.session import ship_package

#: Vector components in a block (2,048 rows of 64 components) and in a batch of anchors.
BLOCK_VALUES, ANCHOR_VALUES = 131_072, 262_144
#: Pivots that blocks form around, of the rows of least hash; rows of a leaf; children of a node.
PIVOTS, LEAF, CHILDREN = 32, 64, 16
_EXACT = 2**53  # sums of products below this are exact in doubles
_NONE = -(2**62)  # a score below all others
_NO_ID = 2**63 - 1  # a null id in a ranking: after all others


def finite(vector: str | Column) -> Column:
    """Not null and without a null, NaN or infinite component."""
    v = F.col(vector) if isinstance(vector, str) else vector
    return v.isNotNull() & F.coalesce(F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))


def quantized(vector: str | Column, scale: int = 256) -> Column:
    """floor(scale * x) of every component, x as double."""
    v = F.col(vector) if isinstance(vector, str) else vector
    return F.transform(v, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long"))


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a @ b.T in exact 64-bit integers (by doubles where these are exact)."""
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), np.int64)
    largest = float(np.abs(a).max()) * float(np.abs(b).max()) * a.shape[1]
    if largest < _EXACT:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a @ b.T


# -- the tree --------------------------------------------------------------

@dataclass
class CoverTree:
    """Points in the order of the leaves; nodes in the order of the levels.
    ``first`` and ``until`` are a node's points; a leaf has no children."""

    points: np.ndarray
    row: np.ndarray
    id: np.ndarray
    label: np.ndarray
    centre: np.ndarray   # the point of each node
    radius: np.ndarray   # covering radius of its points, augmented
    parent: np.ndarray
    leaf: np.ndarray
    first: np.ndarray
    until: np.ndarray


def augmented(points: np.ndarray, m2: float) -> np.ndarray:
    x = points.astype(np.float64)
    return np.column_stack((x, np.sqrt(np.maximum(m2 - (x * x).sum(1), 0))))


def _net(x: np.ndarray, centre: int, radius: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A net of the points ``x`` that starts with ``centre``: each next centre
    is the point farthest from those before, until all are within half the
    radius or there are CHILDREN.  (centres, nearest centre, distance to it)"""
    centres, nearest = [centre], np.zeros(len(x), np.int64)
    away = np.sqrt(((x - x[centre]) ** 2).sum(1))
    while len(centres) < CHILDREN and away.max() > radius / 2:
        far = int(away.argmax())
        d = np.sqrt(((x - x[far]) ** 2).sum(1))
        closer = d < away
        nearest[closer], away[closer] = len(centres), d[closer]
        centres.append(far)
    return np.array(centres), nearest, away


def build_tree(points: np.ndarray, row: np.ndarray, ids: np.ndarray, label: np.ndarray, m2: float) -> CoverTree:
    x = augmented(points, m2)
    everything = np.argsort(ids, kind="stable")
    radius = np.sqrt(((x - x[everything[0]]) ** 2).sum(1)).max()
    nodes: list[tuple[int, float, int, bool]] = []
    members: list[np.ndarray] = []
    level = [(int(everything[0]), float(radius), -1, everything)]
    while level:
        below = []
        for centre, r, parent, own in level:
            leaf = len(own) <= LEAF or r == 0
            nodes.append((centre, r, parent, leaf))
            members.append(own)
            if leaf:
                continue
            at = int(np.flatnonzero(own == centre)[0])
            centres, nearest, away = _net(x[own], at, r)
            below += [(int(own[c]), float(away[nearest == k].max()), len(nodes) - 1, own[nearest == k]) for k, c in enumerate(centres)]
        level = below
    parent = np.array([n[2] for n in nodes])
    size = np.array([len(m) for m in members])
    # Children follow their parent's first point one after another.
    first, taken = np.zeros(len(nodes), np.int64), np.zeros(len(nodes), np.int64)
    for k in range(1, len(nodes)):
        first[k] = first[parent[k]] + taken[parent[k]]
        taken[parent[k]] += size[k]
    leaf = np.array([n[3] for n in nodes])
    order = np.empty(len(points), np.int64)
    for k in np.flatnonzero(leaf):
        order[first[k]:first[k] + size[k]] = members[k]
    place = np.empty(len(points), np.int64)
    place[order] = np.arange(len(points))
    return CoverTree(points[order], row[order], ids[order], label[order], place[[n[0] for n in nodes]],
                     np.array([n[1] for n in nodes]), parent, leaf, first, first + size)


_TREE = {"points": np.int64, "row": np.int64, "id": np.int64, "label": np.int64, "centre": np.int64, "radius": np.float64,
         "parent": np.int64, "leaf": np.bool_, "first": np.int64, "until": np.int64}


def _as_row(tree: CoverTree) -> pa.Table:
    own = {k: pa.array([getattr(tree, k).astype(t).tobytes()], pa.binary()) for k, t in _TREE.items()}
    return pa.table({"n": pa.array([len(tree.row)], pa.int64()), **own})


def _trees(batch: pa.RecordBatch) -> Iterator[CoverTree]:
    for r in batch.to_pylist():
        own = {k: np.frombuffer(r[k], t) for k, t in _TREE.items()}
        yield CoverTree(**(own | {"points": own["points"].reshape(r["n"], -1)}))


# -- search ----------------------------------------------------------------

@dataclass
class Wanted:
    """What is sought: for each window its anchor (a row of ``vectors``), the
    lowest and highest score, and whether the label must be the anchor's."""

    vectors: np.ndarray
    row: np.ndarray
    label: np.ndarray
    anchor: np.ndarray
    low: np.ndarray    # 100 * score must be at least this
    high: np.ndarray   # and at most this
    same_label: bool
    k: int
    m2: float


class _Best:
    """The k best (score, id, row) of every window: highest score, least id."""

    def __init__(self, wanted: Wanted):
        self.w = wanted
        shape = (len(wanted.anchor), wanted.k)
        self.score, self.id, self.row = np.full(shape, _NONE), np.full(shape, _NO_ID), np.full(shape, -1)

    def verify(self, tree: CoverTree, node: int, windows: np.ndarray) -> None:
        """Score a leaf's points exactly for these windows."""
        w, own = self.w, slice(tree.first[node], tree.until[node])
        anchors, which = np.unique(w.anchor[windows], return_inverse=True)
        score = products(w.vectors[anchors], tree.points[own])
        agree = (w.label[anchors][:, None] == tree.label[own]) == w.same_label
        agree &= w.row[anchors][:, None] != tree.row[own]
        s = score[which]
        good = agree[which] & (100 * s >= w.low[windows][:, None]) & (100 * s <= w.high[windows][:, None])
        good &= s >= self.score[windows, -1:]
        some = good.any(1)
        windows, s, good = windows[some], s[some], good[some]
        if not len(windows):
            return
        shape = s.shape
        score = np.hstack((self.score[windows], np.where(good, s, _NONE)))
        ids = np.hstack((self.id[windows], np.where(good, tree.id[own], _NO_ID)))
        row = np.hstack((self.row[windows], np.broadcast_to(tree.row[own], shape)))
        order = np.lexsort((row, ids, -score), axis=1)[:, :w.k]
        for held, new in ((self.score, score), (self.id, ids), (self.row, row)):
            held[windows] = np.take_along_axis(new, order, 1)

    def search(self, tree: CoverTree) -> None:
        """Every point of the tree that can be among the best is verified."""
        w = self.w
        centre = products(w.vectors, tree.points[tree.centre]).astype(np.float64)
        length2 = w.m2 + (w.vectors.astype(np.float64) ** 2).sum(1)[:, None]
        away = np.sqrt(np.maximum(length2 - 2 * centre, 0))
        slack = 1 + 1e-9 * length2  # more than the doubles' rounding
        upper = np.minimum((length2 - np.maximum(away - tree.radius, 0) ** 2) / 2 + slack, 2.0**62)
        lower = (length2 - (away + tree.radius) ** 2) / 2 - slack
        for k in range(1, len(tree.parent)):  # parents come first: a node bounds its children
            upper[:, k] = np.minimum(upper[:, k], upper[:, tree.parent[k]])
            lower[:, k] = np.maximum(lower[:, k], lower[:, tree.parent[k]])
        leaves = np.flatnonzero(tree.leaf)
        upper, lower = upper[:, leaves][w.anchor], lower[:, leaves][w.anchor]
        inside = (100 * upper >= w.low[:, None]) & (100 * lower <= w.high[:, None])
        bound = np.where(inside, np.minimum(upper, w.high[:, None] / 100), -np.inf)
        if not inside.any():
            return
        start = bound.argmax(1)
        for j in np.unique(start):
            now = np.flatnonzero((start == j) & inside[:, j] & (bound[:, j] >= self.score[:, -1]))
            if len(now):
                self.verify(tree, leaves[j], now)
        left = inside.copy()
        left[np.arange(len(start)), start] = False
        for j in np.argsort(-bound.max(0), kind="stable"):
            # A bound equal to the k-th best score may still win by its id.
            now = np.flatnonzero(left[:, j] & (bound[:, j] >= self.score[:, -1]))
            if len(now):
                self.verify(tree, leaves[j], now)


_FOUND = "window long, score long, id long, row long"


def _search(wanted):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = _Best(wanted.value)
        for batch in batches:
            for tree in _trees(batch):
                best.search(tree)
        window, place = np.nonzero(best.score > _NONE)
        yield pa.RecordBatch.from_arrays([pa.array(window), *(pa.array(x[window, place]) for x in (best.score, best.id, best.row))],
                                         ["window", "score", "id", "row"])
    return run


# -- Spark -----------------------------------------------------------------

@dataclass
class Forest:
    """The cover trees of all blocks, one row each, and the rows they hold."""

    trees: DataFrame
    rows: DataFrame
    dim: int
    m2: float


def _assigned(pivots):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = pivots.value.astype(np.float64)
        for batch in batches:
            x = _matrix(batch.column("vector"), p.shape[1]).astype(np.float64)
            near = ((p * p).sum(1) - 2 * (x @ p.T)).argmin(1) if len(x) else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(near.astype(np.int32))], [*batch.schema.names, "pivot"])
    return run


def _matrix(vectors: pa.Array, dim: int) -> np.ndarray:
    """Rows of equal length; shorter vectors end in zeros."""
    out = np.zeros((len(vectors), dim), np.int64)
    size = np.diff(vectors.offsets.to_numpy())
    at = np.repeat(np.arange(len(vectors)), size)
    out[at, np.arange(len(at)) - np.repeat(np.cumsum(size) - size, size)] = vectors.flatten().to_numpy()
    return out


def _build(dim: int, m2: float):
    def run(block: pa.Table) -> pa.Table:
        block = block.combine_chunks()
        points = _matrix(block.column("vector").chunk(0), dim)
        ids = block.column("id").fill_null(_NO_ID).to_numpy()
        return _as_row(build_tree(points, block.column("row").to_numpy(), ids, block.column("label").to_numpy(), m2))
    return run


def build_forest(ws: Workspace, rows: DataFrame) -> Forest | None:
    """Cover trees over ``rows`` (row, id, label, vector); None without rows."""
    square = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    n, dim, m2 = rows.agg(F.count("*"), F.max(F.size("vector")), F.max(square)).first()
    if not n:
        return None
    dim = max(1, dim)
    near = rows.orderBy(F.xxhash64("row"), "row").limit(PIVOTS).select("vector").collect()
    pivots = np.zeros((len(near), dim), np.int64)
    for k, r in enumerate(near):
        pivots[k, :len(r["vector"])] = r["vector"]
    spark = ws.spark
    assigned = ws.table(rows.mapInArrow(_assigned(spark.sparkContext.broadcast(pivots)),
                                        "row long, id long, label long, vector array<long>, pivot int"), "assigned")
    counts = {r["pivot"]: r["count"] for r in assigned.groupBy("pivot").count().collect()}  # one row per pivot
    per_block = max(LEAF, BLOCK_VALUES // dim)
    parts = F.array(*(F.lit(parts_for(counts.get(k, 1), per_block)) for k in range(len(near))))
    blocks = (assigned.withColumn("part", F.pmod(F.xxhash64("row"), F.element_at(parts, F.col("pivot") + 1)))
              .groupBy("pivot", "part").applyInArrow(_build(dim, float(m2 or 0)), ", ".join(["n long", *(f"{k} binary" for k in _TREE)])))
    return Forest(ws.table(blocks, "trees"), assigned, dim, float(m2 or 0))


def _ranked(found: DataFrame, k: int) -> DataFrame:
    best = Window.partitionBy("window").orderBy(F.desc("score"), F.asc("id"), F.asc("row"))
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def mine_hard_negatives(ws: Workspace, rows: DataFrame, is_anchor: Column, n_positives: int = 5, n_negatives: int = 10,
                        low_percent: int = 30, high_percent: int = 90) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)
    from ``rows`` (id long, label, vector array<long>).

    An anchor's positives are the ``n_positives`` other rows of its label with
    the highest scores (integer inner products; ties by least id, null last);
    for each, the ``n_negatives`` best rows of another label whose score is
    from ``low_percent`` to ``high_percent`` hundredths of the positive's are
    returned.  Rows with a null label or vector take no part; a repeated id
    is another row; vectors shorter than the longest end in zeros.  Scores are
    exact as long as a hundred times them fits 64 bits.  A window without rows
    returns none.
    """
    spark = ws.spark
    ship_package(spark)
    result = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    kept = rows.select(F.col("id").cast("long").alias("id"), F.col("label").cast("long").alias("label"), "vector",
                       F.coalesce(is_anchor, F.lit(False)).alias("is_anchor")).where("label is not null and vector is not null")
    rows = numbered(ws, kept, "rows")
    forest = build_forest(ws, rows.select("row", "id", "label", "vector"))
    if forest is None:
        return spark.createDataFrame([], result)
    anchors = ws.table(rows.where("is_anchor").select("row", "id", "label", "vector"), "anchors")
    n_batches = parts_for(anchors.count() * forest.dim, ANCHOR_VALUES)
    out = None
    for b in range(n_batches):
        batch = anchors.where(F.pmod(F.xxhash64("row"), F.lit(n_batches)) == b).toArrow().combine_chunks()  # bounded by ANCHOR_VALUES
        if not batch.num_rows:
            continue
        vectors = _matrix(batch.column("vector").chunk(0), forest.dim)
        row, label = batch.column("row").to_numpy(), batch.column("label").to_numpy()
        everywhere = np.full(len(row), 2**62)

        def found(wanted: Wanted, name: str) -> DataFrame:
            all_best = forest.trees.mapInArrow(_search(spark.sparkContext.broadcast(wanted)), _FOUND)
            return ws.table(_ranked(all_best, wanted.k), f"{name}-{b}")

        positives = found(Wanted(vectors, row, label, np.arange(len(row)), -everywhere, everywhere, True, n_positives, forest.m2),
                          "positives")
        p = positives.select("window", "rank", "score", "id", "row").toArrow()  # n_positives per anchor
        anchor, score = p.column("window").to_numpy(), p.column("score").to_numpy()
        negatives = found(Wanted(vectors, row, label, anchor, low_percent * score, high_percent * score, False, n_negatives, forest.m2),
                          "negatives")
        windows = spark.createDataFrame(pa.table({
            "window": pa.array(np.arange(len(anchor))), "anchor_id": batch.column("id").take(pa.array(anchor)),
            "positive_id": p.column("id"), "positive_score": p.column("score")}))
        part = negatives.join(F.broadcast(windows), "window").select(
            "anchor_id", F.when(F.col("positive_id") < _NO_ID, F.col("positive_id")).alias("positive_id"), F.col("rank").cast("int").alias("rank"),
            F.when(F.col("id") < _NO_ID, F.col("id")).alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
        out = part if out is None else out.unionByName(part)
    return out if out is not None else spark.createDataFrame([], result)
