"""Similarity self-join of documents on word n-gram sets by MinHash banding.

1. Documents with equal n-gram sets form a class; one row stands for it.
2. Each representative's MinHash signature is cut into bands, whose numbers
   are chosen for a target recall at the threshold.  Band hashes are
   shuffled; representatives that share one meet in a bucket.
3. A large bucket is dealt into blocks and every pair of blocks is a group
   of bounded size of its own.  A pair of documents is looked at in the
   first of its shared bands only, and only where set sizes allow the
   threshold; documents that are left in no pair go.
4. The others bring their texts, and the pairs are verified on the full
   n-gram sets.  A group hands on each document's number of links and a
   spanning forest of them, never the pairs, so thousands of copies cost no
   rows; the forests' connected components are the similarity classes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationlake.llm.common import Workspace, numbered, unused
from stationlake.llm.components import connected_components
from stationlake.llm.shingles import mix, shingle_sets
from stationlake.llm.tokens import slices

WORDS, THRESHOLD, RECALL = 5, 0.8, 0.9999
MAX_HASHES = 128
#: Members of one block of a bucket; a group has at most two blocks, give or take hashing.
BLOCK = 256


def bands_for(threshold: float, recall: float, max_hashes: int = MAX_HASHES) -> tuple[int, int]:
    """(bands, rows per band): the most rows, for the fewest false candidates,
    with which a pair at the threshold shares a band with probability
    ``recall``, within ``max_hashes`` hashes."""
    best = (max_hashes, 1)
    for rows in range(1, max_hashes + 1):
        share = threshold ** rows
        bands = math.ceil(math.log(1 - recall) / math.log1p(-share)) if share < 1 else 1
        if bands * rows <= max_hashes:
            best = (bands, rows)
    return best


def _multipliers(n: int) -> np.ndarray:
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def band_hashes(sets: list[np.ndarray], bands: int, rows: int) -> np.ndarray:
    """The hash of each band of each (not empty) set's MinHash signature."""
    out = np.zeros((len(sets), bands), np.int64)
    full = [k for k, s in enumerate(sets) if len(s)]
    if not full:
        return out
    flat = np.concatenate([sets[k] for k in full])
    starts = np.concatenate(([0], np.cumsum([len(sets[k]) for k in full])))[:-1]
    factors = _multipliers(bands * rows)
    for b in range(bands):
        h = np.full(len(full), b + 1, np.uint64)
        for r in range(rows):
            h = mix(h ^ np.minimum.reduceat(flat * factors[b * rows + r], starts)) + np.uint64(r)
        out[full, b] = h.view(np.int64)
    return out


def _signatures(words: int, bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text")
            for lo, hi in slices(texts, 4_000_000):
                sets = shingle_sets(texts.slice(lo, hi - lo), words)
                size = [len(s) for s in sets]
                keys = [[int(mix(s ^ np.uint64(seed)).sum(dtype=np.uint64).view(np.int64)) for s in sets] for seed in (0, 0x5851F42D4C957F2D)]
                hashes = band_hashes(sets, bands, rows)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("row").slice(lo, hi - lo), pa.array(size, pa.int64()), *(pa.array(k, pa.int64()) for k in keys),
                     pa.FixedSizeListArray.from_arrays(pa.array(hashes.ravel()), bands).cast(pa.list_(pa.int64()))],
                    ["row", "n", "key1", "key2", "bands"])
    return run


def _groups(batches: Iterator[pa.RecordBatch], key: list[str]) -> Iterator[pa.RecordBatch]:
    """The runs of rows with equal ``key`` of a sorted partition, each whole."""
    kept: list[pa.RecordBatch] = []

    def whole(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        return parts[0] if len(parts) == 1 else pa.Table.from_batches(parts).combine_chunks().to_batches()[0]

    def key_of(batch: pa.RecordBatch, row: int) -> tuple:
        return tuple(batch.column(c)[row].as_py() for c in key)

    for batch in batches:
        if not batch.num_rows:
            continue
        cols = [batch.column(c).to_numpy() for c in key]
        change = np.zeros(batch.num_rows, bool)
        for c in cols:
            change[1:] |= c[1:] != c[:-1]
        cuts = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
        if kept and key_of(kept[-1], 0) != key_of(batch, 0):
            yield whole(kept)
            kept = []
        for a, b in zip(cuts[:-1], cuts[1:]):
            if a:
                yield whole(kept)
                kept = []
            kept.append(batch.slice(a, b - a))
    if kept:
        yield whole(kept)


def _pairs(group: pa.RecordBatch, threshold: float) -> np.ndarray:
    """Which pairs (first < second position) this group has to look at."""
    n, block, row = (group.column(c).to_numpy() for c in ("n", "block", "row"))
    band, first, second = (group.column(c)[0].as_py() for c in ("band", "block_a", "block_b"))
    own = group.column("bands")
    hashes = own.flatten().to_numpy().reshape(len(n), -1)[:, :band]
    small, large = np.minimum(n[:, None], n[None, :]), np.maximum(n[:, None], n[None, :])
    pair = (row[:, None] < row[None, :]) & (small >= threshold * large - 1e-9)
    if first != second:
        pair &= block[:, None] != block[None, :]
        # the rows of a pair may stand in either order of blocks
    for b in range(band):
        pair &= hashes[:, b][:, None] != hashes[:, b][None, :]
    return pair


_KEY = ["bucket", "block_a", "block_b"]
_MEMBER = "bucket long, block_a int, block_b int, block int, band int, row long, n long, bands array<long>"


def _with_pairs(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches, _KEY):
            pair = _pairs(group, threshold)
            needed = pair.any(axis=0) | pair.any(axis=1)
            if needed.any():
                yield group.filter(pa.array(needed))
    return run


def _common(sets: list[np.ndarray], pair: np.ndarray) -> np.ndarray:
    """The number of common elements of each wanted pair of sets."""
    common = np.zeros(pair.shape, np.int64)
    wanted = np.argwhere(pair)
    if len(wanted) <= 4 * len(sets):
        for i, j in wanted:
            common[i, j] = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
        return common
    element, at, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    shared = count > 1
    column = np.cumsum(shared) - 1
    keep = shared[at]
    owner, at = owner[keep], column[at[keep]]
    order = np.argsort(at, kind="stable")
    owner, at = owner[order], at[order]
    for lo in range(0, int(shared.sum()), 4096):
        a, b = np.searchsorted(at, (lo, lo + 4096))
        part = np.zeros((len(sets), 4096), np.float32)
        part[owner[a:b], at[a:b] - lo] = 1
        common += np.rint(part @ part.T).astype(np.int64)
    return common


def _links(words: int, threshold: float):
    schema = pa.schema([("src", pa.int64()), ("dst", pa.int64()), ("links", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches, _KEY):
            pair = _pairs(group, threshold)
            if not pair.any():
                continue
            row = group.column("row").to_numpy()
            sets = shingle_sets(group.column("text"), words)
            size = np.array([len(s) for s in sets])
            common = _common(sets, pair)
            link = pair & (common >= threshold * (size[:, None] + size[None, :] - common) - 1e-9)
            degree = link.sum(axis=0) + link.sum(axis=1)
            parent = np.arange(len(row))

            def root(x: int) -> int:
                while parent[x] != x:
                    parent[x] = parent[parent[x]]
                    x = parent[x]
                return x

            forest = []
            for i, j in np.argwhere(link):
                a, b = root(i), root(j)
                if a != b:
                    parent[b] = a
                    forest.append((row[i], row[j]))
            linked = np.flatnonzero(degree)
            src = [*row[linked], *(a for a, _ in forest)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(src, pa.int64()), pa.array([None] * len(linked) + [b for _, b in forest], pa.int64()),
                 pa.array([*degree[linked], *([None] * len(forest))], pa.int64())], schema=schema)
    return run


def similar_documents(ws: Workspace, docs: DataFrame, words: int = WORDS, threshold: float = THRESHOLD,
                      recall: float = RECALL, block: int = BLOCK) -> DataFrame:
    """``docs`` (all columns) with: row (unique), class_id (the least doc_id of
    its class), kept (true for one row per class, that of the least doc_id),
    n_links (similar documents with another n-gram set, one per set) and
    n_copies (rows with the same n-gram set, itself included).

    Null and empty texts have no n-grams: each is a class of its own, without
    links.  Repeated rows are copies.  Null ids come after all others.
    Columns of these names are replaced.
    """
    spark = ws.spark
    bands, rows = bands_for(threshold, recall)
    new = ["row", "class_id", "kept", "n_links", "n_copies"]
    docs = numbered(ws, docs.drop(*new))
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(2**63 - 1))
    signatures = ws.table(docs.select("row", "text").mapInArrow(
        _signatures(words, bands, rows), "row long, n long, key1 long, key2 long, bands array<long>"), "signatures")

    full = signatures.where("n > 0")
    classes = ws.table(full.groupBy("key1", "key2", "n").agg(F.min("row").alias("rep"), F.count("*").alias("n_copies")), "classes")
    # Buckets: band hashes that several representatives share.
    stands = signatures.join(classes.select(F.col("rep").alias("row")), "row")
    entries = stands.select("row", F.posexplode("bands").alias("band", "bucket"))
    frequent = ws.table(entries.groupBy("bucket").agg(F.count("*").alias("members")).where("members > 1"), "frequent")
    members = ws.table(
        entries.join(frequent, "bucket")
        .withColumn("blocks", F.ceil(F.col("members") / block).cast("int"))
        .withColumn("block", F.pmod(F.xxhash64("row"), F.col("blocks")).cast("int"))
        .select("bucket", "band", "row", "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")), "members")
    grouped = (members.join(signatures.select("row", "n", "bands"), "row")
               .select("bucket", F.least("block", "other").alias("block_a"), F.greatest("block", "other").alias("block_b"),
                       "block", "band", "row", "n", "bands")
               .repartition(*_KEY).sortWithinPartitions(*_KEY))
    needed = ws.table(grouped.mapInArrow(_with_pairs(threshold), _MEMBER), "needed")
    links = ws.table(
        needed.join(docs.select("row", "text"), "row").repartition(*_KEY).sortWithinPartitions(*_KEY)
        .mapInArrow(_links(words, threshold), "src long, dst long, links long"), "links")

    roots = connected_components(ws, links.where("dst is not null").select("src", "dst"))
    degrees = links.where("links is not null").groupBy(F.col("src").alias("rep")).agg(F.sum("links").alias("n_links"))
    ids = docs.select("row", key.alias("id"))
    # Per class of equal sets: its component, links and least id.
    least = (ids.join(full.select("row", "key1", "key2", "n"), "row").groupBy("key1", "key2", "n")
             .agg(F.min(F.struct("id", "row")).alias("first")))
    of_class = (classes.join(least, ["key1", "key2", "n"])
                .join(roots.select(F.col("node").alias("rep"), "root"), "rep", "left")
                .join(degrees, "rep", "left")
                .withColumn("root", F.coalesce("root", "rep")))
    of_class = ws.table(of_class, "of_class")
    heads = of_class.groupBy("root").agg(F.min("first").alias("head"))
    of_class = ws.table(of_class.join(heads, "root").select(
        "key1", "key2", "n", "n_copies", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), "head"), "class_heads")
    head = unused("head", docs.columns)
    of_row = (full.select("row", "key1", "key2", "n").join(of_class, ["key1", "key2", "n"])
              .select("row", F.col("head").alias(head), "n_links", "n_copies"))
    ws.remove("classes", "frequent", "members", "needed", "links", "of_class")
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    class_id = F.when(F.col(head).isNull(), F.col("doc_id").cast("long")).otherwise(
        F.when(F.col(head)["id"] < 2**63 - 1, F.col(head)["id"]))
    return docs.join(of_row, "row", "left").select(
        *docs.columns, class_id.alias("class_id"), F.coalesce(F.col(head)["row"] == F.col("row"), F.lit(True)).alias("kept"),
        F.coalesce("n_links", none).alias("n_links"), F.coalesce("n_copies", one).alias("n_copies"))
