"""Toxicity by compression distance: two zstandard dictionaries, one of toxic
and one of ordinary text, and the lengths that windows of a text compress
to under each.

A window is one word, written several times between spaces so that it
exceeds zstandard's least block; every word of a text is a window.  Words
end at Unicode white space and joining punctuation.  A longer run is cut into
overlapping windows of ``WORD_BYTES`` that cover all of it, scripts without
spaces into overlapping windows of a few characters.  The
dictionaries are trained by choosing the windows that mark their class:
for the toxic one those that occur in far more toxic documents than chance
would have, for the ordinary one the frequent windows of ordinary
documents.  Whether a window is toxic is read from its pair of compressed
lengths (and its own), by log-likelihood ratios that training windows
calibrate (windows of runs by the training texts written without spaces); a text's score is a logistic regression on its highest ratios.

Only texts enter a score.
"""

from __future__ import annotations

import pickle
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationlake.llm.common import fold
from stationlake.llm.tokens import slices
from stationlake.session import ship_package

#: Training documents per class: the labelled rows with the smallest hashes,
#: as far as a class's texts have no more than SAMPLE_BYTES.
SAMPLE = {1: 1500, 0: 3000}
SAMPLE_BYTES = 32_000_000
#: Bytes of the dictionaries.
TOXIC_BYTES, ORDINARY_BYTES = 4096, 65536
LEVEL, REPEATS = 9, 4
#: What a window needs to enter the toxic dictionary: documents, and standard
#: deviations over the expected share of toxic ones.
LEAST_DOCS, LEAST_DEVIATIONS = 4, 5.0
#: Words that a worker remembers, and text bytes that are split into windows at
#: once: they bound a worker's memory and change no score.
CACHE_WORDS, SLICE_BYTES = 200_000, 2_000_000
#: A longer word is cut into windows of at most so many bytes, each half over the one before.
WORD_BYTES = 32

_TRIM = ".,!?;:*#&$%|\"'()[]{}-_"
_LENGTHS, _SIZES = 48, 17  # caps of a cell's compressed lengths; word lengths 0-14, 15-24, and windows of runs
_RUN_SIZE = 24  # longer windows are those of runs
# What joins words, and scripts written without spaces (characters of a window of each).
_JOIN = re.compile("[\\s\u200b\u2060\ufeff/\\\\_.|,;:+=~<>\u00b7\u2010-\u2015\u2026\u3001\u3002\u30fb\uff01\uff0c\uff0e\uff0f\uff1a\uff1b\uff1f-]+")
_PLAIN = re.compile(rb"[^\x00-\x20\x7f-\xff/\\_.|,;:+=~<>-]{1,%d}" % _RUN_SIZE)
_HAN, _THAI = "\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\U00020000-\U0003ffff", "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff"
_SCRIPTS = re.compile(f"([{_HAN}]+)|([{_THAI}]+)|[^{_HAN}{_THAI}]+")
_HAN_CHARS, _THAI_CHARS = 2, 4
FEATURES = 8


def _covered(run: str) -> list[str]:
    """Overlapping windows of at most WORD_BYTES that cover a long run."""
    if len(run.encode()) <= _RUN_SIZE:
        return [run]
    width = WORD_BYTES // max(len(c.encode()) for c in set(run))
    return [run[k:k + width] for k in range(0, max(1, len(run) - width // 2), width // 2)]


def _split(word: str) -> list[bytes]:
    """The windows of what stands between white space."""
    out: list[str] = []
    for piece in _JOIN.split(word):
        for m in _SCRIPTS.finditer(piece.strip(_TRIM)):
            run = m.group()
            if m.lastindex:
                n = (_HAN_CHARS, _THAI_CHARS)[m.lastindex - 1]
                out.extend(run[k:k + n] for k in range(max(1, len(run) - n + 1)))
            else:
                out.extend(_covered(run))
    return [w.encode() for w in out]


def _words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """(document, window) of the distinct windows of each text, and the windows."""
    texts = pc.utf8_lower(pc.fill_null(texts.cast(pa.large_string()), ""))
    lists = pc.ascii_split_whitespace(texts)
    coded = pc.utf8_trim(lists.flatten(), characters=_TRIM).dictionary_encode()
    words = coded.dictionary.cast(pa.large_binary()).to_pylist()
    sizes = np.diff(lists.offsets.to_numpy())
    pair = np.unique(np.repeat(np.arange(len(texts), dtype=np.int64), sizes) * (len(words) + 1)
                     + coded.indices.to_numpy(zero_copy_only=False))
    doc, word = np.divmod(pair, len(words) + 1)
    number: dict[bytes, int] = {}
    own = [np.array([number.setdefault(x, len(number)) for x in ((w,) if _PLAIN.fullmatch(w) else _split(w.decode()))], np.int32)
           for w in words]
    n_own = np.fromiter(map(len, own), np.int64, len(own))
    first, flat = np.cumsum(n_own) - n_own, np.concatenate([np.zeros(0, np.int32), *own]).astype(np.int64)
    many = n_own[word]
    place = np.repeat(first[word] - (np.cumsum(many) - many), many) + np.arange(many.sum())
    pair = np.unique(np.repeat(doc, many) * (len(number) + 1) + flat[place])
    doc, word = np.divmod(pair, len(number) + 1)
    return doc, word, list(number)


def _sample_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """``_words`` of many texts, slice by slice."""
    docs, words, number = [np.zeros(0, np.int32)], [np.zeros(0, np.int32)], {}
    for lo, hi in slices(texts, SLICE_BYTES):
        doc, word, windows = _words(texts.slice(lo, hi - lo))
        own = np.fromiter((number.setdefault(w, len(number)) for w in windows), np.int32, len(windows))
        docs.append((doc + lo).astype(np.int32))
        words.append(own[word])
    return np.concatenate(docs), np.concatenate(words), list(number)


def _runs(texts: list[str | None], y: np.ndarray, windows: _Windows, n_cells: int) -> list[np.ndarray]:
    """How often each cell is seen in toxic and in ordinary texts written without spaces."""
    seen = [np.zeros(n_cells, np.int64), np.zeros(n_cells, np.int64)]
    for text, label in zip(texts, y):
        parts = sorted({w.encode() for w in _covered("".join(c for c in (text or "").lower() if c.isalnum())) if w})
        cell = windows.cells(parts)
        seen[0 if label else 1] += np.bincount(cell[cell % _SIZES == _SIZES - 1], minlength=n_cells)
    return seen


def _unit(word: bytes) -> bytes:
    return (b" " + word) * REPEATS + b" "


def _compressor(content: bytes):
    import zstandard as zs

    shape = zs.ZstdCompressionParameters.from_level(
        LEVEL, format=zs.FORMAT_ZSTD1_MAGICLESS, write_content_size=0, write_checksum=0, write_dict_id=0)
    own = {"dict_data": zs.ZstdCompressionDict(content, dict_type=zs.DICT_TYPE_RAWCONTENT)} if len(content) >= 8 else {}
    return zs.ZstdCompressor(compression_params=shape, **own).compress


@dataclass(frozen=True)
class Model:
    """What scoring needs; about 70 KB."""

    toxic: bytes
    ordinary: bytes
    ratio: np.ndarray = field(repr=False)
    weights: np.ndarray = field(repr=False)
    key: int = 0

    def __hash__(self) -> int:
        return self.key

    def __eq__(self, other: object) -> bool:
        return isinstance(other, Model) and self.key == other.key


class _Windows:
    """The cells of windows under a pair of dictionaries, remembered per worker."""

    def __init__(self, toxic: bytes, ordinary: bytes):
        self._toxic, self._ordinary, self._cache = _compressor(toxic), _compressor(ordinary), {}

    def cells(self, windows: list[bytes]) -> np.ndarray:
        if len(self._cache) > CACHE_WORDS:
            self._cache.clear()
        cache = self._cache
        for w in windows:
            if w not in cache:
                u = _unit(w)
                a, b = min(len(self._ordinary(u)), _LENGTHS - 1), min(len(self._toxic(u)), _LENGTHS - 1)
                cache[w] = (a * _LENGTHS + b) * _SIZES + (min(len(w), _SIZES - 2) if len(w) <= _RUN_SIZE else _SIZES - 1)
        return np.fromiter(map(cache.__getitem__, windows), np.int64, len(windows))


def _features(doc: np.ndarray, value: np.ndarray, n: int) -> np.ndarray:
    """Of each text: its highest ratios, sums of the high ones, and its size."""
    order = np.lexsort((-value, doc))
    doc, value = doc[order], value[order]
    first = np.searchsorted(doc, np.arange(n + 1))
    place = np.arange(len(doc)) - first[doc]
    size = np.diff(first)

    def total(of: np.ndarray) -> np.ndarray:
        return np.bincount(doc[of], value[of], n)

    many = np.sqrt(np.maximum(size, 1))
    return np.column_stack([
        np.ones(n), total(place == 0), total((place > 0) & (place < 3)), total(place < 10), total(value > 1),
        np.bincount(doc[value > 2], minlength=n), np.log1p(size), np.bincount(doc[value > 1], minlength=n) / many])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights of a ridge logistic regression by Newton steps (first column: 1)."""
    mean, sd = x.mean(0), x.std(0) + 1e-9
    mean[0], sd[0] = 0, 1
    z, w = (x - mean) / sd, np.zeros(x.shape[1])
    ridge = np.r_[1e-9, np.full(x.shape[1] - 1, 0.1)]
    for _ in range(30):
        p = _sigmoid(z @ w)
        grad, hess = z.T @ (y - p) - ridge * w, (z * (p * (1 - p) + 1e-6)[:, None]).T @ z + np.diag(ridge)
        w = w + np.linalg.solve(hess, grad)
    scaled = w / sd
    scaled[0] -= (w[1:] * mean[1:] / sd[1:]).sum()
    return scaled


def fit(texts: list[str | None], labels: list[int]) -> Model:
    """Train on a bounded sample of labelled texts."""
    y = np.array(labels, np.int64)
    doc, word, windows = _sample_words(pa.array(texts, pa.string()))
    toxic = np.bincount(word[y[doc] == 1], minlength=len(windows))
    ordinary = np.bincount(word[y[doc] == 0], minlength=len(windows))
    share = y.mean() if len(y) else 0.0
    if not 0 < share < 1:  # one class only: the prior is all there is to say
        weights = np.zeros(FEATURES)
        weights[0] = 5 if share else -5
        return Model(b"", b"", np.zeros(_LENGTHS * _LENGTHS * _SIZES), weights, len(texts))
    both = toxic + ordinary
    above = (toxic - both * share) / np.sqrt(np.maximum(both, 1) * share * (1 - share))
    chosen = np.flatnonzero((toxic >= LEAST_DOCS) & (above >= LEAST_DEVIATIONS))
    chosen = chosen[np.argsort(above[chosen], kind="stable")]
    usual = np.flatnonzero((ordinary >= 2) & (above <= 0))
    usual = usual[np.argsort(ordinary[usual], kind="stable")]
    # zstandard reaches the end of a dictionary most cheaply: the strongest windows stand last.
    content = [b"".join(b" " + windows[i] for i in c)[-size:] for c, size in ((chosen, TOXIC_BYTES), (usual, ORDINARY_BYTES))]
    coder = _Windows(*content)
    cell = coder.cells(windows)[word]
    n_cells = _LENGTHS * _LENGTHS * _SIZES

    def ratios(seen: list[np.ndarray]) -> np.ndarray:
        total = seen[0] + seen[1] + 5
        prior = min(max(seen[0].sum() / max(1, seen[0].sum() + seen[1].sum()), 1e-9), 1 - 1e-9)
        return (np.log((seen[0] + 5 * prior) / total / prior) - np.log((seen[1] + 5 * (1 - prior)) / total / (1 - prior)))

    run = np.arange(n_cells) % _SIZES == _SIZES - 1
    ratio = np.where(run, ratios(_runs(texts, y, coder, n_cells)),
                     ratios([np.bincount(cell[y[doc] == k], minlength=n_cells) * ~run for k in (1, 0)]))
    weights = _logistic(_features(doc, ratio[cell], len(y)), y)
    return Model(*content, ratio, weights, zlib.crc32(b"".join([*content, ratio.tobytes(), weights.tobytes()])))


@lru_cache(maxsize=1)
def _windows(model: Model) -> _Windows:
    return _Windows(model.toxic, model.ordinary)


def score_texts(model: Model, texts: pa.Array) -> np.ndarray:
    """The probability that each text is toxic."""
    out = []
    for lo, hi in slices(texts, SLICE_BYTES):
        doc, word, windows = _words(texts.slice(lo, hi - lo))
        value = model.ratio[_windows(model).cells(windows)][word] if len(word) else np.zeros(0)
        # Row by row: how a matrix product rounds a row hangs on its place in the slice.
        out.append(_sigmoid((_features(doc, value, hi - lo) * model.weights).sum(1)))
    return np.concatenate(out) if out else np.zeros(0)


# -- Spark -----------------------------------------------------------------

def _fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Fits on all rows (label, text) of one task."""
    texts, labels, size = [], [], {0: 0, 1: 0}
    for batch in batches:
        for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist()):
            size[label] += len((text or "").encode())
            if size[label] <= SAMPLE_BYTES:
                texts.append(text)
                labels.append(label)
    yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(fit(texts, labels))], pa.binary())], ["model"])


def train(docs: DataFrame, labels: DataFrame, held_out: int = 1, sample: dict[int, int] = SAMPLE) -> Model:
    """Fit on labelled documents outside fold ``held_out``, in one task.

    At most ``sample[label]`` of each class, those whose ids hash smallest,
    and at most SAMPLE_BYTES of their texts; a doc_id with several labels is
    toxic if one says so, of one with several texts the least is taken; rows
    without label or id are not used.  Only the model comes to the driver.
    """
    spark = docs.sparkSession
    ship_package(spark)
    usable = (labels.where("toxic is not null and doc_id is not null").where(fold() != held_out)
              .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("label")))
    picked = None
    for label, most in sample.items():
        part = usable.where(F.col("label") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
        picked = part if picked is None else picked.union(part)
    # The sample is bounded by ``sample``: its ids are broadcast, its texts go to one task.
    rows = (docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text"))
            .repartition(1).sortWithinPartitions("doc_id").select("label", "text"))
    found = rows.mapInArrow(_fitted, "model binary").collect()
    return pickle.loads(found[0]["model"]) if found else fit([], [])


def _scores(model, text: str, score: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [c for c in batch.schema.names if c != score]
            value = pa.array(score_texts(model.value, batch.column(text)), pa.float64())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), value], [*keep, score])
    return run


def score_toxicity(docs: DataFrame, model: Model, text: str = "text", score: str = "toxicity") -> DataFrame:
    """``docs`` with the probability ``score``.

    Null and empty texts get the score of a text without words; repeated
    texts get equal scores; a column that is already called ``score`` is
    replaced, all others pass through.
    """
    spark = docs.sparkSession
    ship_package(spark)
    docs = docs.drop(score)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(_scores(spark.sparkContext.broadcast(model), text, score), f"{schema}, `{score}` double")
