"""Ranked lexical search with hashed max-sketches.

The index holds, per document, a sketch: every term is hashed to one of
``COORDINATES`` coordinates and each coordinate keeps the largest frequency
of the terms that fold into it.  A term's impact grows with its frequency
in the document, so the sketch gives the coordinatewise maxima of the
impacts; only coordinates that are not empty are stored.  The index also
holds the partial document frequencies of terms and the text beside the
sketch, for exact scores.

A batch of queries is looked up in all sketches at once: the impact at a
term's coordinate, times the term's weight, is at least the term's true
contribution, and the sum over a query's terms is an upper bound of the
document's score.  Each task takes its documents in descending order of
bound and scores them exactly from their texts until no bound reaches a
query's k-th best score; the tasks' best are merged.  Nothing but these k
rows a task and query is shuffled.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stationlake.llm.common import Workspace, numbered, parts_for, text_bytes
from stationlake.llm.tokens import slices
from stationlake.session import ship_package

COORDINATES = 1 << 16
#: Queries looked up at once: at most about so many bytes of their texts, and so many of them.
BATCH_BYTES, BATCH_ITEMS = 200_000, 500
#: Documents whose bounds are computed at once, and that are scored exactly before the thresholds are looked at again.
LOOKED_UP, SCORED = 512, 64

# Term characters are ASCII letters and digits and everything
# outside ASCII; A-Z are lower-cased, nothing else is.  The weights' and
# impacts' scales, and the share of the length in a document's norm.
_TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
WEIGHT_SCALE, IMPACT_SCALE, LENGTH_PERCENT = 1000, 1_000_000_000, 25
_NO_ID = 2**63 - 1  # a null doc_id in a ranking: after all others

_INDEX = "doc_id long, text string, n_terms long, coords binary, maxima binary, term string, df long"


def terms_of(text: str | None) -> list[bytes]:
    return text.encode().translate(_TERM_BYTES).split() if text else []


def _flat(values: pa.Array, kind: pa.DataType) -> tuple[bytes, np.ndarray]:
    """(bytes of all values, where each value starts; one longer than ``values``)."""
    values = pc.fill_null(values.cast(kind), "" if kind == pa.large_string() else b"")
    _, offsets, data = values.buffers()
    at = np.frombuffer(offsets, np.int64, len(values) + 1, values.offset * 8) if len(values) else np.zeros(1, np.int64)
    return (memoryview(data)[at[0]:at[-1]].tobytes() if data is not None else b""), at - at[0]


def term_codes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """(code of every term, where each text's terms start, the coded terms)."""
    raw, at = _flat(texts, pa.large_string())
    plain = pa.LargeStringArray.from_buffers(len(texts), pa.py_buffer(np.ascontiguousarray(at)), pa.py_buffer(raw.translate(_TERM_BYTES)))
    lists = pc.ascii_split_whitespace(plain)
    coded = lists.flatten().dictionary_encode()
    codes, terms = coded.indices.to_numpy(zero_copy_only=False), coded.dictionary.cast(pa.large_binary()).to_pylist()
    real = np.ones(len(codes), bool)
    if b"" in terms:  # the splitter gives empty words at the ends of a text
        real = codes != terms.index(b"")
    bounds = lists.offsets.to_numpy() - lists.offsets[0].as_py()
    return codes[real].astype(np.int64), np.concatenate(([0], np.cumsum(real)))[bounds], terms


def frequencies(texts: pa.Array) -> tuple[np.ndarray, ...]:
    """(document, term, frequency) of all documents' terms, terms of each document, coded terms."""
    codes, at, terms = term_codes(texts)
    n = np.diff(at)
    pair, tf = np.unique(np.repeat(np.arange(len(n)), n) * (len(terms) + 1) + codes, return_counts=True)
    doc, code = np.divmod(pair, len(terms) + 1)
    return doc, code, tf, n, terms


def coordinates(terms: list[bytes]) -> np.ndarray:
    return np.fromiter((xxhash.xxh3_64_intdigest(t) % COORDINATES for t in terms), np.int64, len(terms))


def sketches(doc: np.ndarray, code: np.ndarray, tf: np.ndarray, terms: list[bytes]) -> tuple[np.ndarray, ...]:
    """(document, coordinate, largest frequency), ordered by document."""
    key = doc * COORDINATES + coordinates(terms)[code]
    order = np.argsort(key, kind="stable")
    key = key[order]
    first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.zeros(0, np.int64)
    most = np.maximum.reduceat(tf[order], first) if len(key) else tf
    return *np.divmod(key[first], COORDINATES), most


def _cut(values: np.ndarray, doc: np.ndarray, n: int) -> list[bytes]:
    at = np.searchsorted(doc, np.arange(n + 1))
    return [values[a:b].tobytes() for a, b in zip(at[:-1], at[1:])]


def _index_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("n_terms", pa.int64()), ("coords", pa.binary()),
                        ("maxima", pa.binary()), ("term", pa.string()), ("df", pa.int64())])
    for batch in batches:
        for lo, hi in slices(batch.column("text")):
            part, n = batch.slice(lo, hi - lo), hi - lo
            doc, code, tf, size, terms = frequencies(part.column("text"))
            of, coord, most = sketches(doc, code, tf, terms)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("text"), pa.array(size), pa.array(_cut(coord.astype("<u2"), of, n), pa.binary()),
                 pa.array(_cut(most.astype("<u4"), of, n), pa.binary()), pa.nulls(n, pa.string()), pa.nulls(n, pa.int64())], schema=schema)
            df = np.bincount(code, minlength=len(terms))
            used = np.flatnonzero(df)
            none = [pa.nulls(len(used), f.type) for f in schema][:5]
            yield pa.RecordBatch.from_arrays(
                [*none, pa.array([terms[k] for k in used], pa.binary()).cast(pa.string()), pa.array(df[used])], schema=schema)


@dataclass(frozen=True)
class Index:
    """A table with a row per document (its sketch) and rows of partial
    document frequencies, and the totals that scores need."""

    table: DataFrame
    n_docs: int    # documents with a term
    n_terms: int   # terms of all documents, with repeats

    @property
    def documents(self) -> DataFrame:
        return self.table.where("term is null").select("doc_id", "text", "n_terms", "coords", "maxima")

    def document_frequencies(self, terms: list[str]) -> dict[str, int]:
        """Of a bounded list of terms; a term that no document holds is left out."""
        spark = self.table.sparkSession
        asked = spark.createDataFrame([(t,) for t in terms], "term string")
        counts = self.table.select("term", "df").join(F.broadcast(asked), "term").groupBy("term").agg(F.sum("df").alias("df"))
        return {r["term"]: r["df"] for r in counts.collect()}


def build_index(ws: Workspace, docs: DataFrame) -> Index:
    """The index of ``docs`` (doc_id, text), in one pass.

    A null or empty text has no terms and is never found; a repeated row is a
    document of its own; other columns are left out.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    table = ws.table(rows.mapInArrow(_index_rows, _INDEX), "index")
    total = table.where("n_terms > 0").agg(F.count("*"), F.sum("n_terms")).first()
    return Index(table, total[0], total[1] or 0)


# -- search ----------------------------------------------------------------

@dataclass(frozen=True)
class Queries:
    """A batch of queries: per item its terms (columns of ``terms``) and what
    an impact of each is multiplied with."""

    rows: list[int]
    terms: dict[bytes, int]
    columns: list[np.ndarray]
    weights: list[np.ndarray]
    k: int
    n_docs: int
    n_terms: int


def weight(df: int, n_docs: int) -> int:
    return math.floor(WEIGHT_SCALE * math.log((2 * n_docs + 2) / (2 * df + 1)))


def _batch(index: Index, items: list[tuple[int, str | None]], k: int) -> Queries:
    counts = [Counter(terms_of(text)) for _, text in items]
    terms = {t: j for j, t in enumerate(sorted(set().union(*counts)))}
    df = index.document_frequencies([t.decode() for t in terms])
    own = {t: weight(df.get(t.decode(), 0), index.n_docs) for t in terms}
    return Queries([row for row, _ in items], terms, [np.array([terms[t] for t in c], np.int64) for c in counts],
                   [np.array([own[t] * times for t, times in c.items()], np.int64) for c in counts], k, index.n_docs, index.n_terms)


def _sums(column: np.ndarray, doc: np.ndarray, tf: np.ndarray, length: np.ndarray, n_columns: int,
          queries: Queries, columns: list[np.ndarray]) -> np.ndarray:
    """Sum of weighted impacts per query and document, in 64-bit integers."""
    norm = 100 - LENGTH_PERCENT + (LENGTH_PERCENT * length * queries.n_docs) // max(1, queries.n_terms)
    impact = np.zeros((n_columns, len(length)), np.int64)
    impact[column, doc] = (IMPACT_SCALE * tf) // (1000 * tf + 12 * norm[doc])
    return np.array([w @ impact[c] for c, w in zip(columns, queries.weights)], np.int64).reshape(len(columns), len(length))


class _Search:
    """One task's search: the best documents so far and what can still beat them."""

    def __init__(self, queries: Queries):
        self.q = queries
        shape = (len(queries.rows), queries.k)
        self.score, self.doc = np.zeros(shape, np.int64), np.full(shape, _NO_ID)
        coords = coordinates(list(queries.terms))  # column of ``terms`` -> coordinate
        self.used, dense = np.unique(coords, return_inverse=True)
        self.place = np.full(COORDINATES, -1, np.int64)
        self.place[self.used] = np.arange(len(self.used))
        self.columns = [dense.reshape(-1)[c] for c in queries.columns]

    def bounds(self, batch: pa.RecordBatch) -> np.ndarray:
        coords, at = _flat(batch.column("coords"), pa.large_binary())
        maxima, _ = _flat(batch.column("maxima"), pa.large_binary())
        place = self.place[np.frombuffer(coords, "<u2")]
        asked = np.flatnonzero(place >= 0)
        doc = np.repeat(np.arange(len(batch)), np.diff(at) // 2)
        return _sums(place[asked], doc[asked], np.frombuffer(maxima, "<u4").astype(np.int64)[asked],
                     batch.column("n_terms").to_numpy(), len(self.used), self.q, self.columns)

    def exact(self, batch: pa.RecordBatch, of: np.ndarray) -> np.ndarray:
        doc, code, tf, n, terms = frequencies(batch.column("text").take(pa.array(of)))
        column = np.fromiter((self.q.terms.get(t, -1) for t in terms), np.int64, len(terms))[code]
        asked = column >= 0
        return _sums(column[asked], doc[asked], tf[asked], n, len(self.q.terms), self.q, self.q.columns)

    def add(self, ids: np.ndarray, scores: np.ndarray) -> None:
        """Keep the k best per query: highest score, then least doc_id."""
        score = np.hstack((self.score, scores))
        doc = np.hstack((self.doc, np.where(scores > 0, ids, _NO_ID)))
        order = np.lexsort((doc, -score), axis=1)[:, :self.q.k]
        self.score, self.doc = np.take_along_axis(score, order, 1), np.take_along_axis(doc, order, 1)

    def look_up(self, batch: pa.RecordBatch) -> None:
        bound = self.bounds(batch)
        ids = pc.fill_null(batch.column("doc_id"), _NO_ID).to_numpy()
        left = np.arange(len(batch))
        while len(left):
            # A bound equal to the k-th best score may still win by its doc_id.
            over = (bound[:, left] - np.maximum(self.score[:, -1:], 1)).max(0, initial=-1)
            left, over = left[over >= 0], over[over >= 0]
            order = np.argsort(-over, kind="stable")
            now, left = left[order[:SCORED]], left[order[SCORED:]]
            if len(now):
                self.add(ids[now], self.exact(batch, now))


def _search(queries):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q: Queries = queries.value
        search = _Search(q)
        for batch in batches:
            for lo in range(0, len(batch), LOOKED_UP):
                search.look_up(batch.slice(lo, LOOKED_UP))
        item, place = np.nonzero(search.score)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.array(q.rows, np.int64)[item]), pa.array(search.doc[item, place]), pa.array(search.score[item, place])],
            ["item", "doc_id", "score"])
    return run


def search(ws: Workspace, index: Index, items: DataFrame, item_id: str = "item_id", text: str = "text", k: int = 20) -> DataFrame:
    """(``item_id``, rank, doc_id, score): the ``k`` documents of the highest
    score above 0 for each row of ``items``, equal scores by ascending doc_id
    (null last).

    A null text, or one without terms, finds nothing; repeated items are
    answered each.  Items go through in batches of bounded size, each one
    pass over the sketches; only a batch's terms come to the driver.
    """
    ship_package(ws.spark)
    items = numbered(ws, items.select(F.col(item_id).alias("item_id"), F.col(text).alias("text")), "items")
    n_batches = max(parts_for(text_bytes(items), BATCH_BYTES), parts_for(items.count(), BATCH_ITEMS))
    batch_no = F.pmod(F.xxhash64("row"), F.lit(n_batches))
    found = None
    for b in range(n_batches):
        rows = [(r["row"], r["text"]) for r in items.where(batch_no == b).collect()]
        queries = ws.spark.sparkContext.broadcast(_batch(index, rows, k))
        part = ws.table(index.documents.mapInArrow(_search(queries), "item long, doc_id long, score long"), f"found-{b}")
        found = part if found is None else found.unionByName(part)
    best = Window.partitionBy("item").orderBy(F.desc("score"), F.asc("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    ids = items.select(F.col("row").alias("item"), "item_id")
    return ids.join(ranked, "item").select(F.col("item_id").alias(item_id), "rank", F.when(
        F.col("doc_id") < _NO_ID, F.col("doc_id")).alias("doc_id"), "score")
