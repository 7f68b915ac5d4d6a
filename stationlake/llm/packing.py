"""Best-fit packing of documents into fixed-length sequences by bin completion.

Documents become token pieces of at most ``capacity`` ids.  Only the number
of pieces of each length matters for a packing, and there are at most
``capacity`` lengths: Spark counts them, ``complete_bins`` solves the
counts, and the solution is a short list of fillings, each with the number
of sequences that use it.  Every piece then finds its place from its rank
among the pieces of its length, which needs only light rows: the ids
themselves are not moved.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationlake.llm.common import Workspace
from stationlake.llm.tokens import encoder, slices

#: Nodes that the search may open in all, fillings tried at a node, and
#: steps of one enumeration.  They bound the time, never what is packed.
MAX_NODES = 100
MAX_FILLINGS = 12
MAX_STEPS = 4000
#: Pieces of one length that are ranked together, on average.
RANK_ROWS = 1000

PIECE = "doc_id long, piece int, start long, length long, ids binary"


#: (length, copies) of each distinct length in a sequence.
Filling = tuple[tuple[int, int], ...]


@dataclass(frozen=True)
class Run:
    """``times`` sequences with one filling, its pieces in this order."""

    filling: Filling
    times: int


# -- the search ------------------------------------------------------------

def lower_bound(counts: dict[int, int], capacity: int) -> int:
    """Sequences that any packing needs: by volume, and for each threshold t
    by the pieces over capacity - t, which share a sequence with no piece of
    t or more, and by what the pieces between leave for the rest (L2)."""
    tally = np.zeros(capacity + 2, np.int64)
    for n, k in counts.items():
        tally[n] += k
    number = np.concatenate(([0], np.cumsum(tally)))  # number[n]: pieces shorter than n
    volume = np.concatenate(([0], np.cumsum(tally * np.arange(capacity + 2))))
    half = capacity // 2 + 1
    best = -(-int(volume[-1]) // capacity)
    for t in range(0, capacity // 2 + 1):
        alone = int(number[-1] - number[capacity - t + 1])
        large = int(number[capacity - t + 1] - number[half])
        room = large * capacity - int(volume[capacity - t + 1] - volume[half])
        small = int(volume[half] - volume[t])
        best = max(best, alone + large + max(0, -(-(small - room) // capacity)))
    return best


def _take(counts: dict[int, int], filling: Filling, times: int) -> dict[int, int]:
    left = dict(counts)
    for n, k in filling:
        left[n] -= k * times
        if not left[n]:
            del left[n]
    return left


def _times(counts: dict[int, int], filling: Filling) -> int:
    return min(counts[n] // k for n, k in filling)


def _size(filling: Filling) -> int:
    return sum(n * k for n, k in filling)


def best_fit(counts: dict[int, int], capacity: int) -> list[Run]:
    """Best fit on the counts: the largest piece opens a sequence, which takes
    each time the largest piece that still fits.  A filling is repeated as
    often as the counts allow."""
    runs, left, lengths = [], dict(counts), sorted(counts)
    while lengths:
        filling, room, i = [], capacity, len(lengths) - 1
        while i >= 0:
            n = lengths[i]
            k = min(left[n], room // n)
            filling.append((n, k))
            room -= n * k
            i = min(i, bisect_right(lengths, room)) - 1
        times = _times(left, filling)
        runs.append(Run(tuple(filling), times))
        left = _take(left, filling, times)
        for n, _ in filling:
            if n not in left:
                del lengths[bisect_left(lengths, n)]
    return runs


def _dominates(a: Filling, b: Filling) -> bool:
    """Whether the pieces of ``b`` can be dealt into those of ``a`` (a
    first-fit test on sorted pieces: it never claims too much)."""
    room = [n for n, k in sorted(a, reverse=True) for _ in range(k)]
    for n in (n for n, k in sorted(b, reverse=True) for _ in range(k)):
        for i, r in enumerate(room):
            if n <= r:
                room[i] = r - n
                break
        else:
            return False
    return True


def _fillings(counts: dict[int, int], capacity: int, max_waste: int) -> list[Filling]:
    """Undominated fillings around the largest piece that waste at most
    ``max_waste``: the fullest first, then those of fewer pieces."""
    largest = max(counts)
    left = _take(counts, ((largest, 1),), 1)
    lengths = sorted(left, reverse=True)
    steps, found = 0, set()
    if capacity - largest in left:  # a perfect partner dominates every other filling
        found.add(((capacity - largest, 1),))
        lengths = []

    def extend(start: int, room: int, chosen: Filling) -> None:
        nonlocal steps
        for i in range(start, len(lengths)):
            n = lengths[i]
            for k in range(min(left[n], room // n), 0, -1):
                steps += 1
                if steps > MAX_STEPS:
                    return
                extend(i + 1, room - n * k, (*chosen, (n, k)))
        used = dict(chosen)
        if room <= max_waste and not any(n <= room and left[n] > used.get(n, 0) for n in reversed(lengths)):
            found.add(chosen)

    extend(0, capacity - largest, ())
    kept: list[Filling] = []
    for f in sorted(found, key=lambda f: (-_size(f), sum(k for _, k in f))):
        if len(kept) < MAX_FILLINGS and not any(_dominates(x, f) for x in kept):
            kept.append(f)
    merged = []
    for f in kept:
        own = dict(f)
        own[largest] = own.get(largest, 0) + 1
        merged.append(tuple(sorted(own.items(), reverse=True)))
    return merged


def complete_bins(counts: dict[int, int], capacity: int) -> list[Run]:
    """A packing of ``counts[length]`` pieces of each length.

    Bin completion: around the largest remaining piece the undominated
    fillings are tried in turn, each repeated as often as the counts allow; a
    branch ends when its waste exceeds what the best packing so far leaves
    over the volume.  Every node completes its branch by best fit, which
    gives the incumbents.  The search stops at the lower bound or after
    ``MAX_NODES`` nodes, with the best packing found.
    """
    counts = {n: k for n, k in counts.items() if k}
    if not counts:
        return []
    volume, bound = sum(n * k for n, k in counts.items()), lower_bound(counts, capacity)
    best, best_bins, nodes = best_fit(counts, capacity), 0, 0
    best_bins = sum(r.times for r in best)
    stack: list[tuple[dict[int, int], list[Run], int, int]] = [(counts, [], 0, 0)]
    while stack and nodes < MAX_NODES and best_bins > bound:
        left, runs, bins, waste = stack.pop()
        spare = (best_bins - 1) * capacity - volume - waste
        if spare < 0:
            continue
        nodes += 1
        rest = best_fit(left, capacity)
        total = bins + sum(r.times for r in rest)
        if total < best_bins:
            best, best_bins = runs + rest, total
            spare = (best_bins - 1) * capacity - volume - waste
        if not left or spare < 0:
            continue
        for f in reversed(_fillings(left, capacity, spare)):
            times, lost = _times(left, f), capacity - _size(f)
            if lost:
                times = min(times, max(1, spare // lost))
            stack.append((_take(left, f, times), [*runs, Run(f, times)], bins + times, waste + times * lost))
    return best


# -- pieces ----------------------------------------------------------------

def _pieces(path: str, end_id: int, capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for batch in batches:
            texts, keys = batch.column("text"), batch.column("doc_id").to_pylist()
            for lo, hi in slices(texts):
                ids, at = enc.encode(texts.slice(lo, hi - lo))
                end = np.array([end_id], "<u4").tobytes()
                out = []
                for key, a, b in zip(keys[lo:hi], at[:-1], at[1:]):
                    data = ids[a:b].tobytes() + end
                    for p in range(-(-len(data) // (4 * capacity))):
                        part = data[p * 4 * capacity:(p + 1) * 4 * capacity]
                        out.append((key, p, p * capacity, len(part) >> 2, part))
                cols = zip(*out)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()))],
                    ["doc_id", "piece", "start", "length", "ids"])
    return run


def token_pieces(docs: DataFrame, tokenizer_path: str, end_id: int, capacity: int) -> DataFrame:
    """The token ids of ``docs`` (doc_id, text), cut to at most ``capacity``."""
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
            .mapInArrow(_pieces(tokenizer_path, end_id, capacity), PIECE))


# -- places ----------------------------------------------------------------

def _intervals(runs: list[Run]) -> list[tuple[int, int, int, int, int, int]]:
    """Which ranks of a length go where: (length, first rank, end rank, first
    sequence, copies per sequence, offset of the first copy)."""
    used: dict[int, int] = {}
    out, sequence = [], 0
    for r in runs:
        offset = 0
        for n, copies in r.filling:
            first = used.get(n, 0)
            used[n] = first + copies * r.times
            out.append((n, first, used[n], sequence, copies, offset))
            offset += n * copies
        sequence += r.times
    return out


@dataclass(frozen=True)
class Packing:
    """``pieces``: row, doc_id, piece, start, length, ids.  ``places``: row,
    sequence_id, offset.  Join them on row, after reducing ids to what is
    needed; ``sequences`` is the join with the ids themselves."""

    pieces: DataFrame
    places: DataFrame

    def sequences(self) -> DataFrame:
        return self.pieces.join(self.places, "row").drop("row")


def pack(ws: Workspace, docs: DataFrame, tokenizer_path: str, end_id: int = 0, capacity: int = 2048) -> Packing:
    """Pack ``docs`` (doc_id, text) into sequences of at most ``capacity`` ids.

    Null and empty texts are one piece with the end id alone; repeated rows
    are packed once each; a null doc_id is kept; other columns are not read.
    An empty table has no pieces.
    """
    spark = ws.spark
    pieces = ws.table(
        token_pieces(docs, tokenizer_path, end_id, capacity).withColumn("row", F.monotonically_increasing_id()), "pieces")
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}  # at most ``capacity`` rows
    # Ranks within a length: each length is dealt into groups of about
    # RANK_ROWS pieces, and the sizes of the groups before give a group's first rank.
    groups = F.broadcast(spark.createDataFrame(
        [(n, -(-k // RANK_ROWS)) for n, k in counts.items()], "length long, groups long"))
    light = pieces.select("row", "length").join(groups, "length").select(
        "row", "length", F.pmod(F.xxhash64("row"), "groups").alias("group"))
    firsts = light.groupBy("length", "group").count().selectExpr(
        "length", "group", "sum(count) over (partition by length order by group) - count as before")
    ranks = (light.selectExpr("row", "length", "group", "row_number() over (partition by length, group order by row) - 1 as at")
             .join(firsts, ["length", "group"]).selectExpr("row", "length", "before + at as rank"))
    # One interval per length of a run; a run uses up a length, so there are
    # at most a few for each of the ``capacity`` lengths.
    intervals = F.broadcast(spark.createDataFrame(
        _intervals(complete_bins(counts, capacity)),
        "length long, first long, until long, sequence long, copies long, offset0 long"))
    places = ranks.join(intervals, "length").where("rank >= first and rank < until").selectExpr(
        "row", "sequence + (rank - first) div copies as sequence_id", "offset0 + (rank - first) % copies * length as offset")
    return Packing(pieces, places)
