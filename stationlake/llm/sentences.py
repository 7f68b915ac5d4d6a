"""Substring dedup by sliding sentence spans.

A text is cut into sentences (at line ends and after words that end in a
full stop, an exclamation or a question mark); a sentence of more than
``LONG`` words is cut further after commas and after words whose hash says
so, which depends on the words alone, and what is still over twice as long
every ``LONG`` words.  A span is a run of ``SPAN_SENTENCES`` consecutive
sentences, and one starts at every sentence: a longer repeated run is
covered, from its first to its last sentence, by the repeated spans inside
it.  A whole text of several, but fewer, sentences is one span.  Spans are
hashed and brought together by hash over all documents, at most one of a
hash from each slice of texts; every sentence that a repeated span covers
goes, except in the span's first occurrence.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stationlake.llm.common import Workspace, numbered
from stationlake.llm.shingles import mix
from stationlake.llm.tokens import slices

SPAN_SENTENCES = 3
_SPAN_WORDS = 1 << 16  # more than the words of a span
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
LONG, CUT_EVERY = 12, 4

_LINE = "\x1e"  # stands for a line end among the words
_WORD = re.compile(r"[^ \t\n\r\x0b\x0c\x1e]+")
_END = re.compile(rb"[.!?][\"')\]*#&$%]*$")
_CLAUSE = re.compile(rb"[,;:][\"')\]]*$")
_TRIM = b".,!?;:*#&$%|\"'()[]{}"
_FACTOR = 0x9E3779B97F4A7C15
_INVERSE = pow(_FACTOR, -1, 2**64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def _last_of(group: np.ndarray) -> np.ndarray:
    return np.concatenate((group[1:] != group[:-1], [True])) if len(group) else np.zeros(0, bool)


def sentences(texts: pa.Array, long: int = LONG, cut_every: int = CUT_EVERY) -> tuple[np.ndarray, ...]:
    """(text, first word, number of words, hash) of every sentence of a batch."""
    marked = pc.replace_substring(pc.fill_null(texts.cast(pa.large_string()), ""), "\n", f" {_LINE} ")
    lists = pc.ascii_split_whitespace(marked)
    coded = lists.flatten().dictionary_encode()
    words = pc.utf8_lower(coded.dictionary).cast(pa.large_binary()).to_pylist()
    line = np.array([w == _LINE.encode() for w in words], bool)
    real = np.array([bool(w) for w in words], bool) & ~line
    own = np.array([xxhash.xxh3_64_intdigest(w.strip(_TRIM)) for w in words], np.uint64)
    ends = np.array([_END.search(w) is not None for w in words], bool)
    cuts = np.array([_CLAUSE.search(w) is not None for w in words], bool) | (own % np.uint64(cut_every) == 0)

    codes = coded.indices.to_numpy(zero_copy_only=False)
    text = np.repeat(np.arange(len(texts)), np.diff(lists.offsets.to_numpy()))
    before_line = np.concatenate((line[codes[1:]], [False])) if len(codes) else np.zeros(0, bool)
    keep = real[codes] if len(codes) else np.zeros(0, bool)
    # a line end after the last word of a line, whatever empty words stand between
    codes, text, before_line = codes[keep], text[keep], before_line[keep]
    if not len(codes):
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.uint64))
    text_end = _last_of(text)
    place = np.arange(len(codes)) - np.searchsorted(text, text)  # word number in its text

    def parts(end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(part of each word, first word and size of each part)."""
        of = np.concatenate(([0], np.cumsum(end)[:-1]))
        first = np.flatnonzero(np.concatenate(([True], end[:-1])))
        return of, first, np.diff(np.concatenate((first, [len(codes)])))

    end = ends[codes] | before_line | text_end
    of, _, size = parts(end)
    end |= cuts[codes] & (size[of] > long)
    of, first, size = parts(end)
    inside = np.arange(len(codes)) - first[of]
    end |= (size[of] > 2 * long) & (inside % long == long - 1)
    of, first, size = parts(end)
    inside = (np.arange(len(codes)) - first[of]).astype(np.uint64)
    value = np.add.reduceat(mix(own[codes] + (inside + np.uint64(1)) * np.uint64(_FACTOR)), first)
    return text[first], place[first], size, mix(value + size.astype(np.uint64))


def spans(text: np.ndarray, value: np.ndarray, least: int = SPAN_SENTENCES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first sentence, end sentence, hash) of every run of ``least`` sentences
    of a text, and of whole texts of two sentences or more but fewer."""
    n = len(text)
    start = np.arange(n)
    first, last = np.searchsorted(text, text), np.searchsorted(text, text, side="right")
    whole = (start == first) & (last - first >= 2) & (last - first < least)
    start = np.flatnonzero((start + least <= last) | whole)
    until = np.minimum(start + least, last[start])
    prefix = np.concatenate((np.zeros(1, np.uint64), np.cumsum(value * _powers(_FACTOR, n))))
    h = mix((prefix[until] - prefix[start]) * _powers(_INVERSE, n)[start] + (until - start).astype(np.uint64))
    return start, until, h


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The spans; ``again`` marks those that stand earlier in the same slice,
    so that a span goes on once a slice however often it is repeated."""
    for batch in batches:
        rows, texts = batch.column("row").to_numpy(), batch.column("text")
        for lo, hi in slices(texts, 4_000_000):
            text, first, words, value = sentences(texts.slice(lo, hi - lo))
            start, until, h = spans(text, value)
            size = first[until - 1] + words[until - 1] - first[start]
            again = np.ones(len(h), bool)
            again[np.unique(h, return_index=True)[1]] = False
            h = np.where(again, mix(h + np.arange(len(h), dtype=np.uint64)), h)  # dealt anywhere
            yield pa.RecordBatch.from_arrays(
                [pa.array(h.view(np.int64)), pa.array(rows[lo + text[start]]), pa.array(first[start] * _SPAN_WORDS + size), pa.array(again)],
                ["hash", "row", "place", "again"])


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = [c for c in batch.schema.names if c != "ranges"]
        texts, removed = [], []
        for text, ranges in zip(batch.column("text").to_pylist(), batch.column("ranges").to_pylist()):
            out, gone, end = [], [], 0
            if ranges:
                at = [m.span() for m in _WORD.finditer(text)]
                for a, b in _merged([(r["first"], r["until"]) for r in ranges]):
                    start, stop = at[a][0], at[b][0] if b < len(at) else len(text)
                    out.append(text[end:start])
                    gone.append({"start": start, "end": stop})
                    end = stop
                text = "".join([*out, text[end:]])
            texts.append(text)
            removed.append(gone)
        place = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        cols = {c: batch.column(c) for c in keep} | {"text": pa.array(texts, pa.string()), "removed": pa.array(removed, place)}
        yield pa.RecordBatch.from_arrays(list(cols.values()), list(cols))


def _merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def dedup_spans(ws: Workspace, docs: DataFrame) -> DataFrame:
    """``docs`` (all columns) with repeated spans cut from ``text`` and an array
    ``removed`` of the (start, end) that went, in code points of the old text.

    The first occurrence is the first in the order of the table as read.  Null
    texts stay null, empty ones empty; a repeated row is an occurrence like
    any other and loses its spans; a text may lose all of its words.  Columns
    named removed, row or ranges are replaced.
    """
    docs = numbered(ws, docs.drop("removed", "row", "ranges"))
    runs = docs.select("row", "text").mapInArrow(_runs, "hash long, row long, place long, again boolean")
    # One shuffle of the spans, three numbers each.
    order = Window.partitionBy("hash", "again").orderBy("row", "place")
    first = F.floor(F.col("place") / _SPAN_WORDS).cast("int")
    repeated = runs.withColumn("n", F.row_number().over(order)).where("again or n > 1").select(
        "row", F.struct(first.alias("first"), (first + F.col("place") % _SPAN_WORDS).cast("int").alias("until")).alias("range"))
    grouped = repeated.groupBy("row").agg(F.collect_list("range").alias("ranges"))  # at most a text's sentences
    # Once the ranges are written, nothing reads the spans' shuffle files again.
    conf, kept = ws.spark.conf, ws.spark.conf.get(_CLEANUP)
    conf.set(_CLEANUP, "true")
    try:
        ranges = ws.table(grouped, "ranges")
    finally:
        conf.set(_CLEANUP, kept)
    joined = docs.join(ranges, "row", "left").drop("row")
    fields = {f.name: f.dataType.simpleString() for f in joined.schema if f.name != "ranges"}
    schema = ", ".join(f"`{c}` {t}" for c, t in fields.items())
    return joined.mapInArrow(_cut, f"{schema}, removed array<struct<start:int,end:int>>")
