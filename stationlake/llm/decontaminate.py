"""Benchmark decontamination with a generalised suffix automaton.

The words of the test items go into one automaton that holds every run of
words of every item.  A document's words stream through it; after each word
the state and the matched length give the longest run of words that ends
here and stands in some item.  A matched length of ``window`` or more is a
contaminated window; items shorter than a window count where they stand
whole.  Documents only pass through tasks, so there is no shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stationlake.session import ship_package

WINDOW = 13
#: Item words per automaton (about 100 MB in a worker).  Further items go
#: into further automata, which the documents pass one after another.
BLOCK_WORDS = 100_000

# Word characters are ASCII letters and digits and everything
# outside ASCII; A-Z are lower-cased, nothing else is.
_WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")

RESULT = ("struct<n_words: bigint, longest: bigint, items: array<string>, "
          "hits: array<struct<first: bigint, until: bigint>>>")
_ARROW = pa.struct([("n_words", pa.int64()), ("longest", pa.int64()), ("items", pa.list_(pa.string())),
                    ("hits", pa.list_(pa.struct([("first", pa.int64()), ("until", pa.int64())])))])


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(_WORD_BYTES).split() if text else []


class SuffixAutomaton:
    """All runs of words of the items, with what to report at each state."""

    def __init__(self, items: list[tuple[str | None, list[bytes]]], window: int):
        self.window, self.ids = window, {}
        self._next: list[dict[int, int]] = [{}]
        self._link, self._length = [-1], [0]
        coded = [(name, [self.ids.setdefault(w, len(self.ids)) for w in words]) for name, words in items]
        for _, run in coded:
            last = 0
            for w in run:
                last = self._extend(last, w)
        self._mark(coded)

    def _new(self, length: int, link: int, following: dict[int, int]) -> int:
        self._length.append(length)
        self._link.append(link)
        self._next.append(following)
        return len(self._length) - 1

    def _split(self, p: int, w: int, q: int) -> int:
        """The state of the runs that reach ``q`` and are at most one longer than those of ``p``."""
        if self._length[q] == self._length[p] + 1:
            return q
        copy = self._new(self._length[p] + 1, self._link[q], dict(self._next[q]))
        self._link[q] = copy
        while p >= 0 and self._next[p].get(w) == q:
            self._next[p][w] = copy
            p = self._link[p]
        return copy

    def _extend(self, last: int, w: int) -> int:
        if w in self._next[last]:  # another item already has this run
            return self._split(last, w, self._next[last][w])
        state, p = self._new(self._length[last] + 1, 0, {}), last
        while p >= 0 and w not in self._next[p]:
            self._next[p][w] = state
            p = self._link[p]
        if p >= 0:
            self._link[state] = self._split(p, w, self._next[p][w])
        return state

    def _of_length(self, state: int, length: int) -> int:
        """The state of the suffix of this length of the runs of ``state``."""
        while self._length[self._link[state]] >= length:
            state = self._link[state]
        return state

    def _mark(self, coded: list[tuple[str | None, list[int]]]) -> None:
        n, window = len(self._length), self.window
        self._names: list[set[str]] = [set() for _ in range(n)]
        self._shorts: list[dict[int, set[str]]] = [{} for _ in range(n)]
        for name, run in coded:
            state = 0
            for k, w in enumerate(run):
                state = self._next[state][w]
                if k + 1 >= window:
                    self._names[self._of_length(state, window)] |= {name} - {None}
            if 0 < len(run) < window:
                self._shorts[self._of_length(state, len(run))].setdefault(len(run), set()).update({name} - {None})
        # In order of length a state's link comes first: where to find its
        # window, the nearest suffix that is a short item, and the least
        # matched length at which there is something to report.
        never = 1 << 60
        self._at_window, self._short, self._least = [0] * n, [-1] * n, [never] * n
        for s in sorted(range(1, n), key=self._length.__getitem__):
            link = self._link[s]
            if self._length[s] >= window:
                self._at_window[s] = s if self._length[link] < window else self._at_window[link]
            self._short[s] = s if self._shorts[s] else self._short[link] if link > 0 else -1
            own = min(self._shorts[s], default=never)
            self._least[s] = min(own, self._least[link], window if self._length[s] >= window else never)

    def scan(self, words: list[bytes]) -> tuple[int, set[str], list[list[int]]]:
        """(longest matched length, items with occurring windows, hit word ranges)."""
        following, link, length, least, window = self._next, self._link, self._length, self._least, self.window
        state = matched = longest = 0
        names: set[str] = set()
        hits: list[list[int]] = []
        for k, w in enumerate(map(self.ids.get, words)):
            if w is None:
                state = matched = 0
                continue
            to = following[state].get(w)
            while to is None and state:
                state = link[state]
                matched = length[state]
                to = following[state].get(w)
            if to is None:
                continue
            state, matched = to, matched + 1
            if matched > longest:
                longest = matched
            if matched >= least[state]:
                reach = 0
                if matched >= window:
                    reach = window
                    names |= self._names[self._at_window[state]]
                s = self._short[state]
                while s > 0:
                    for size, who in self._shorts[s].items():
                        if size <= matched:
                            reach = max(reach, size)
                            names |= who
                    s = self._short[link[s]] if link[s] > 0 else -1
                if reach:
                    first = k + 1 - reach
                    while hits and hits[-1][0] >= first:
                        hits.pop()
                    if hits and hits[-1][1] >= first:
                        hits[-1][1] = k + 1
                    else:
                        hits.append([first, k + 1])
        return longest, names, hits


def _merged(a: list[list[int]], b: list[list[int]]) -> list[list[int]]:
    out: list[list[int]] = []
    for first, until in sorted(a + b):
        if out and first <= out[-1][1]:
            out[-1][1] = max(out[-1][1], until)
        else:
            out.append([first, until])
    return out


def _scan(automaton, text: str, result: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = automaton.value
        for batch in batches:
            before = batch.column(result).to_pylist() if result in batch.schema.names else None
            out = []
            for k, t in enumerate(batch.column(text).cast(pa.binary()).to_pylist()):
                words = words_of(t)
                longest, names, hits = own.scan(words)
                if before:
                    longest = max(longest, before[k]["longest"])
                    names |= set(before[k]["items"])
                    hits = _merged(hits, [[h["first"], h["until"]] for h in before[k]["hits"]])
                out.append({"n_words": len(words), "longest": longest, "items": sorted(names),
                            "hits": [{"first": a, "until": b} for a, b in hits]})
            keep = [c for c in batch.schema.names if c != result]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(out, _ARROW)], [*keep, result])
    return run


def _blocks(benchmark: DataFrame, item_id: str, text: str, block_words: int):
    block, size = [], 0
    for r in benchmark.select(F.col(item_id).cast("string").alias("id"), F.col(text).alias("text")).toLocalIterator():
        words = words_of(r["text"].encode() if r["text"] is not None else None)
        if block and size + len(words) > block_words:
            yield block
            block, size = [], 0
        block.append((r["id"], words))
        size += len(words)
    yield block


def match_benchmark(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, text: str = "text",
                    item_id: str = "item_id", item_text: str = "text", result: str = "benchmark_match",
                    block_words: int = BLOCK_WORDS) -> DataFrame:
    """``docs`` with a struct ``result``: n_words, the longest matched length,
    the sorted ids of items with occurring windows, and the hit ranges of
    words.

    Null and empty texts have no words and no hits; items without words
    match nothing; an item without an id counts for hits but is not named;
    repeated rows and items are taken as they come; a column that is already
    called ``result`` is replaced, all others pass through.
    """
    spark = docs.sparkSession
    ship_package(spark)
    out = docs.drop(result)
    for block in _blocks(benchmark, item_id, item_text, block_words):
        # One automaton per block: its size is bounded by ``block_words``.
        automaton = spark.sparkContext.broadcast(SuffixAutomaton(block, window))
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in out.schema if f.name != result)
        out = out.mapInArrow(_scan(automaton, text, result), f"{schema}, `{result}` {RESULT}")
    return out


def n_hit(result: str = "benchmark_match") -> Column:
    return F.aggregate(F.col(f"{result}.hits"), F.lit(0).cast("long"), lambda n, h: n + h["until"] - h["first"])


def is_contaminated(result: str = "benchmark_match", coverage: int = 20) -> Column:
    """At least 1/``coverage`` of the words are hit."""
    return (n_hit(result) > 0) & (n_hit(result) * coverage >= F.col(f"{result}.n_words"))


def _cut(text: str | None, hits, min_words: int) -> str | None:
    spans = [h for h in hits if h["until"] - h["first"] >= min_words]
    if not spans:
        return text
    at = [m.span() for m in _WORD.finditer(text)]
    out, end = [], 0
    for h in spans:
        out.append(text[end:at[h["first"]][0]])
        end = at[h["until"] - 1][1]
    return "".join([*out, text[end:]])


def remove_spans(matched: DataFrame, min_words: int = 1, coverage: int | None = 20, text: str = "text",
                 result: str = "benchmark_match") -> DataFrame:
    """Documents over the coverage limit go; from the others every hit span of
    ``min_words`` or more is cut.  ``coverage=None`` keeps all documents."""
    @F.udf("string", useArrow=True)
    def cut(t, hits):
        return _cut(t, hits, min_words)

    kept = matched if coverage is None else matched.where(~is_contaminated(result, coverage))
    return kept.withColumn(text, F.when(F.size(f"{result}.hits") > 0, cut(text, f"{result}.hits")).otherwise(F.col(text)))
