"""Language-model scores by a probabilistic suffix tree over tokens.

Tokens are lower-cased words and one end per text; each is a symbol.  A
context is the last one or two symbols (the text's start is one too).  It is
a state of the tree if a likelihood-ratio test finds that what follows it
diverges from what follows its suffix.  A symbol is predicted by the longest
state that is a suffix of what precedes it; a state discounts each of its
counts by one and gives what is left to its suffix.  The empty context
discounts all words, and the discounts of the known words are the
probability of an unknown one.

Every word, context and pair of a context and a symbol that the training
documents hold is counted, whatever its share.  Documents are first turned
into parts of bounded size.  A part sends its distinct words with their counts
to buckets by the word's hash; a bucket adds up, numbers its words, and answers
each part.  For each level of the tree a part does so with its distinct
(context, symbol), by the context's hash; a bucket has all that follows its
contexts, adds up and tests.  Contexts that are seen very often are dealt over
several buckets by the symbol, and their sums are added up after.

A context that is seen once in all training documents is not sent: its one
count less the discount is nothing, so that it gives all to its suffix
whether or not it is a state.  Longer contexts that hold it are seen at most
once as well.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stationlake.llm.common import Workspace
from stationlake.llm.tokens import slices

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

#: A context diverges if its statistic 2 n KL exceeds its degrees of freedom
#: by so many standard deviations.
DEVIATIONS = 4.0
#: Text bytes of a part.
PART_BYTES = 6_000_000
#: A context seen so often is dealt over several buckets.
HOT = 4_000_000
#: A bucket gets the words, the entries of a level of so many parts on average.
WORDS_OF, ENTRIES_OF = 4, 2
#: Fewer bytes of numbers are left as they are (Spark compresses what it writes).
SMALL = 4096

# Symbols: the start of a text, its end, then the words.
START, END, FIRST_WORD = 0, 1, 2
_BITS = np.uint64(20)  # of a symbol in SuffixTree
_HALF = np.uint64(32)  # of a symbol in a pair
_HOT_BIT = np.uint64(40)  # above a symbol


# -- parts -----------------------------------------------------------------

_PART = pa.schema([("part", pa.int64()), ("doc_id", pa.list_(pa.int64())), ("held", pa.list_(pa.bool_())), ("at", pa.binary()),
                   ("code", pa.binary()), ("words", pa.binary()), ("m", pa.int64()), ("seen", pa.binary())])
_PART_SQL = "part long, doc_id array<long>, held array<boolean>, at binary, code binary, words binary, m long, seen binary"


def _hashed(words: pa.Array) -> np.ndarray:
    return pd.util.hash_array(words.to_numpy(zero_copy_only=False).astype(object), categorize=False)


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per slice of documents: its words in the order of their hashes
    (words hold no white space: a line each), how often each is seen in
    training documents, and the documents' word codes one after another."""
    number = TaskContext.get().partitionId() << 32
    for batch in batches:
        texts = batch.column("text")
        # Before slicing: Arrow's ascii_lower misplaces texts where the first offset is not 0.
        lower = pc.ascii_lower(pc.fill_null(texts.cast(pa.large_string()), ""))
        for lo, hi in slices(texts, PART_BYTES):
            lists = pc.ascii_split_whitespace(lower.slice(lo, hi - lo))
            coded = lists.flatten().dictionary_encode()
            words, codes = coded.dictionary.cast(pa.binary()), coded.indices.to_numpy(zero_copy_only=False)
            doc = np.repeat(np.arange(hi - lo), np.diff(lists.offsets.to_numpy()))
            order = np.argsort(_hashed(words), kind="stable")
            empty = pc.index(words, pa.scalar(b"", words.type)).as_py()
            if empty >= 0:
                real = codes != empty
                codes, doc, order = codes[real], doc[real], order[order != empty]
            place = np.empty(len(words), np.int64)
            place[order] = np.arange(len(order))
            codes = place[codes]
            held = batch.column("held").slice(lo, hi - lo)
            train = ~held.to_numpy(zero_copy_only=False)
            seen = np.bincount(codes[train[doc]], minlength=len(order))
            row = [pa.array([number]), pa.ListArray.from_arrays([0, hi - lo], batch.column("doc_id").slice(lo, hi - lo)),
                   pa.ListArray.from_arrays([0, hi - lo], held), pa.array([np.searchsorted(doc, np.arange(hi - lo + 1)).astype("<i8").tobytes()], pa.binary()),
                   pa.array([_squeezed(codes)], pa.binary()), pc.binary_join(pa.ListArray.from_arrays([0, len(order)], words.take(order)), b"\n"),
                   pa.array([len(order)]), pa.array([_squeezed(seen)], pa.binary())]
            yield pa.RecordBatch.from_arrays(row, schema=_PART)
            number += 1


def _pack(*symbols: np.ndarray) -> np.ndarray:
    out = np.zeros(len(symbols[0]), np.uint64)
    for s in symbols:
        out = (out << _BITS) | s.astype(np.uint64)
    return out


# Contexts as numbers: one symbol s is s + 1, two symbols (a, b) have a + 1 above.
def _contexts(before: np.ndarray, earlier: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return before.astype(np.uint64) + np.uint64(1), _pack(earlier + 1, before + 1)


def _suffix_of(context: int) -> int:
    return context & ((1 << 20) - 1) if context >> 20 else 0


# -- the tree --------------------------------------------------------------

@dataclass
class SuffixTree:
    """The tree of counts that fit into memory, as arrays sorted by key: what
    the exchange between parts and buckets computes, in one place (the tests
    hold one against the other).  ``root``: probability of each symbol."""

    root: np.ndarray
    states: np.ndarray  # contexts
    rest: np.ndarray  # share that a state gives to its suffix
    pairs: np.ndarray  # (context, symbol)
    share: np.ndarray  # discounted share of the pair

    @staticmethod
    def _find(where: np.ndarray, what: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(where):
            return np.zeros(len(what), np.int64), np.zeros(len(what), bool)
        at = np.minimum(np.searchsorted(where, what), len(where) - 1)
        return at, where[at] == what

    def step(self, p: np.ndarray, context: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        """``p`` where the context is no state, else the state's prediction."""
        at, known = self._find(self.states, context)
        pair, seen = self._find(self.pairs, (context << _BITS) | symbol.astype(np.uint64))
        if not len(self.states):
            return p
        own = np.where(seen, self.share[pair], 0.0) if len(self.pairs) else 0.0
        return np.where(known, own + self.rest[at] * p, p)

    def probability(self, symbol: np.ndarray, before: np.ndarray, earlier: np.ndarray) -> np.ndarray:
        one, two = _contexts(before, earlier)
        return self.step(self.step(self.root[symbol], one, symbol), two, symbol)


def _diverges(statistic: np.ndarray, freedom: np.ndarray, deviations: float = DEVIATIONS) -> np.ndarray:
    return (freedom > 0) & (statistic >= freedom + deviations * np.sqrt(2 * freedom))


def grow(root: np.ndarray, totals: dict[int, int], pairs: dict[int, list[tuple[int, int]]], deviations: float = DEVIATIONS) -> SuffixTree:
    """The tree from all contexts' totals and pairs: short contexts first, so
    that each is held against the distribution of its suffix."""
    empty = np.zeros(0, np.uint64)
    tree = SuffixTree(root, empty, np.zeros(0), empty, np.zeros(0))
    for long in (False, True):
        states, rest, keys, shares = [], [], [], []
        for context in sorted(c for c in totals if bool(c >> 20) == long):
            own, total = pairs.get(context, []), totals[context]
            symbol = np.array([s for s, _ in own], np.int64)
            n = np.array([k for _, k in own], np.float64)
            suffix = _suffix_of(context)
            below = dict(pairs[suffix]) if long else {}
            q = np.array([below[int(s)] / totals[suffix] for s in symbol]) if long else root[symbol]
            if not _diverges(2 * (n * np.log(n / total / q)).sum(), len(own), deviations):
                continue
            states.append(context)
            rest.append(len(own) / total)
            keys.extend((context << 20) | int(s) for s in symbol)
            shares.extend((n - 1) / total)
        order = np.argsort(np.array([*tree.pairs.tolist(), *keys], np.uint64))
        by = np.argsort(np.array([*tree.states.tolist(), *states], np.uint64))
        tree = SuffixTree(root, np.array([*tree.states.tolist(), *states], np.uint64)[by], np.array([*tree.rest, *rest])[by],
                          np.array([*tree.pairs.tolist(), *keys], np.uint64)[order], np.array([*tree.share, *shares])[order])
    return tree


@dataclass
class Words:
    """The empty context: all tokens, different ones, ends, and the discount."""

    total: int
    distinct: int
    ends: int
    discount: float

    def probability(self, n: np.ndarray) -> np.ndarray:
        """Of a token seen ``n`` times; of any unknown one for 0."""
        if not self.total:
            return np.ones(len(n))
        return np.where(n > 0, n - self.discount, self.discount * self.distinct) / self.total


def train_words(sums: DataFrame, ends: int) -> Words:
    """From the buckets' sums."""
    n, v, once, twice = sums.agg(*(F.coalesce(F.sum(c), F.lit(0)) for c in ("total", "distinct", "once", "twice"))).first()
    discount = once / (once + 2 * twice) if once else 0.5
    return Words(n + ends, v + (ends > 0), ends, min(0.95, max(0.05, discount)))


# -- parts and buckets -----------------------------------------------------

def _blocks(columns: list[np.ndarray], at: list[int]) -> list[bytes]:
    """Columns of 64-bit numbers, a block for each range between two places of
    ``at``: byte plane by byte plane, without the highest planes that are
    zero; first the number of planes of each column."""
    sizes, planes = [], []
    for x in columns:
        x = x.astype(np.uint64, copy=False)
        sizes.append(-(-int(x.max(initial=0)).bit_length() // 8))
        planes.extend((x >> np.uint64(8 * k)).astype(np.uint8) for k in range(sizes[-1]))
    head, table, out = bytes(sizes), np.array(planes, np.uint8).reshape(len(planes), len(columns[0])), []
    for lo, hi in zip(at, at[1:]):
        raw = np.ascontiguousarray(table[:, lo:hi]).tobytes()  # tobytes of a slice goes number by number
        out.append(head + (b"\0" + raw if len(raw) < SMALL else b"\1" + pa.compress(raw, codec="zstd", asbytes=True)))
    return out


def _columns(blocks: list[bytes], m: list[int], width: int) -> list[np.ndarray]:
    """``width`` columns from blocks of ``m`` rows, one block after another."""
    at = np.cumsum([0, *m])
    out = [np.zeros(int(at[-1]), np.uint64) for _ in range(width)]
    alike: dict[bytes, list[int]] = {}
    for i, block in enumerate(blocks):
        alike.setdefault(bytes(block[:width]), []).append(i)
    for head, rows in alike.items():
        planes, raws = sum(head), []
        for i in rows:
            raw = memoryview(blocks[i])[width + 1:]
            raws.append(np.frombuffer(pa.decompress(raw, planes * m[i], codec="zstd") if blocks[i][width] else raw, np.uint8).reshape(planes, m[i]))
        table = np.concatenate(raws, axis=1)
        where = slice(None) if len(alike) == 1 else np.concatenate([np.arange(at[i], at[i + 1]) for i in rows])
        first = np.cumsum([0, *head])
        for column, lo, hi in zip(out, first, first[1:]):
            x = np.zeros(table.shape[1], np.uint64)
            for k, plane in enumerate(table[lo:hi]):
                x |= plane.astype(np.uint64) << np.uint64(8 * k)
            column[where] = x
    return out


def _squeezed(x: np.ndarray) -> bytes:
    return _blocks([x], [0, len(x)])[0]


def _spread(x: bytes, n: int) -> np.ndarray:
    return _columns([x], [n], 1)[0]


def _sorted(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(a stable order, the keys in it).  Where key and place fit into 64 bits,
    numpy's sort of plain numbers takes a fraction of its argsort's time."""
    bits = max(len(key) - 1, 0).bit_length()
    if int(key.max(initial=0)).bit_length() + bits > 64:
        order = np.argsort(key, kind="stable")
        return order, key[order]
    both = np.sort((key.astype(np.uint64) << np.uint64(bits)) | np.arange(len(key), dtype=np.uint64))
    return (both & np.uint64((1 << bits) - 1)).astype(np.int64), both >> np.uint64(bits)


def _ranked(key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(an order, where each different key starts in it, the rank of each key)."""
    order, sorted_key = _sorted(key)
    new = np.ones(len(key), bool)
    new[1:] = sorted_key[1:] != sorted_key[:-1]
    rank = np.empty(len(key), np.int64)
    rank[order] = np.cumsum(new) - 1
    return order, np.flatnonzero(new), rank


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


@dataclass
class Level:
    """The distinct (context, symbol) of a part at one level, but for contexts
    that are seen at most once."""

    context: np.ndarray
    symbol: np.ndarray
    total: np.ndarray  # of the context, in all training documents
    top: np.ndarray  # the symbol's count after the context's suffix,
    base: np.ndarray  # and the suffix's total; 0 for the empty suffix
    where: np.ndarray  # tokens that have an entry
    entry: np.ndarray  # of each of them
    at: np.ndarray  # a token of each entry

    def buckets(self, n_buckets: int, hot: int) -> tuple[np.ndarray, np.ndarray]:
        """The entries in the order of their buckets, and where each bucket starts."""
        salt = self.symbol % (np.uint64(1) + self.total.astype(np.uint64) // np.uint64(hot))
        order, bucket = _sorted(_mixed(self.context + np.uint64(1) + _mixed(salt)) % np.uint64(n_buckets))
        return order, np.searchsorted(bucket, np.arange(n_buckets + 1, dtype=np.uint64))

    def rows(self, part: int, train: np.ndarray, n_buckets: int, hot: int) -> pa.Table:
        """``train``: whether each token of the part is in a training document."""
        n = np.bincount(self.entry[train[self.where]], minlength=len(self.at))
        order, first = self.buckets(n_buckets, hot)
        marked = self.symbol | ((self.total >= hot).astype(np.uint64) << _HOT_BIT)
        some = np.flatnonzero(np.diff(first))
        blocks = _blocks([c[order] for c in (self.context, marked, n, self.top, self.base)], [*first[some].tolist(), len(order)])
        return pa.Table.from_arrays([pa.array(some), pa.array([part] * len(some), pa.int64()), pa.array(np.diff(first)[some]),
                                     pa.array(blocks, pa.binary())], schema=_ASKED)

    def answered(self, answers: pa.Table, hot: tuple[np.ndarray, np.ndarray], n_buckets: int, least: int) -> tuple[np.ndarray, np.ndarray]:
        """Of each entry: its count, and how many symbols follow its context (0: no state)."""
        order, _ = self.buckets(n_buckets, least)
        n, k = np.empty(len(order), np.int64), np.empty(len(order), np.int64)
        n[order], k[order] = _answer(answers)
        often = np.flatnonzero(self.total >= least)
        if len(often):
            k[often] = hot[1][np.searchsorted(hot[0], self.context[often])]
        return n, k

    def predicted(self, n: np.ndarray, k: np.ndarray, p: np.ndarray) -> np.ndarray:
        """Of each token, where its context's suffix gives it ``p``."""
        out, below = p.copy(), p[self.at]
        out[self.where] = np.where(k > 0, np.maximum(n - 1, 0) / self.total + k / self.total * below, below)[self.entry]
        return out


_ASKED = pa.schema([("bucket", pa.int64()), ("part", pa.int64()), ("m", pa.int64()), ("entries", pa.binary())])
_ASKED_SQL = "bucket long, part long, m long, entries binary"
_ANSWER = pa.schema([("part", pa.int64()), ("bucket", pa.int64()), ("m", pa.int64()), ("answer", pa.binary()), ("statistic", pa.binary())])
_ANSWER_SQL = "part long, bucket long, m long, answer binary, statistic binary"


def _answer(answers: pa.Table) -> list[np.ndarray]:
    """The two columns that the buckets answered a part, in the order of the buckets."""
    answers = answers.sort_by("bucket")
    return _columns(answers.column("answer").to_pylist(), answers.column("m").to_pylist(), 2)


def _answers(words: Words):
    """A bucket's answers to the parts.  Of contexts dealt over several
    buckets, a row with part -1: their counts, symbols and sums here."""
    def run(asked: pa.Table) -> pa.Table:
        m = asked.column("m").to_pylist()
        context, symbol, n, top, base = _columns(asked.column("entries").to_pylist(), m, 5)
        rank, plain = _ranked(context)[2].astype(np.uint64), symbol & np.uint64(2 ** 32 - 1)
        order, first, entry = _ranked(rank * (plain.max() + np.uint64(1)) + plain)
        count = np.add.reduceat(n[order].astype(np.int64), first)
        top, base = top[order[first]].astype(np.float64), base[order[first]].astype(np.float64)
        q = np.where(base > 0, top / np.maximum(base, 1), words.probability(top))
        value = np.where(count > 0, count * np.log(np.maximum(count, 1) / np.where(count > 0, q, 1)), 0.0)
        context, symbol = context[order[first]], symbol[order[first]]
        start = np.flatnonzero(np.r_[True, context[1:] != context[:-1]])
        size = np.diff(np.r_[start, len(first)])
        k, total, value = (np.add.reduceat(x, start) for x in ((count > 0).astype(np.int64), count, value))
        often = (symbol[start] >> _HOT_BIT) > 0
        state = _diverges(2 * (value - total * np.log(np.maximum(total, 1))), k) & ~often
        found_n, found_k = count[entry], np.repeat(np.where(state, k, 0), size)[entry]
        answers = pa.Table.from_arrays(
            [asked.column("part"), asked.column("bucket"), asked.column("m"),
             pa.array(_blocks([found_n, found_k], np.cumsum([0, *m]).tolist()), pa.binary()), pa.nulls(len(m), pa.binary())], schema=_ANSWER)
        if not often.any():
            return answers
        row = {"part": -1, "bucket": -1, "m": int(often.sum()), "answer": _blocks([context[start][often], total[often], k[often]], [0, int(often.sum())])[0],
               "statistic": value[often].astype("<f8").tobytes()}
        return pa.concat_tables([answers, pa.Table.from_pylist([row], _ANSWER)])
    return run


def _hot(answers: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(contexts, symbols after each or 0) of those dealt over several buckets:
    at most twice all tokens / HOT rows."""
    sums: dict[int, list] = {}
    for r in answers.where("part < 0").collect():
        columns = (*(c.tolist() for c in _columns([bytes(r["answer"])], [r["m"]], 3)), np.frombuffer(r["statistic"], "<f8").tolist())
        for c, *values in zip(*columns):
            sums[c] = [x + y for x, y in zip(sums.get(c, (0, 0, 0.0)), values)]
    contexts = sorted(sums)
    n, k, value = (np.array([sums[c][i] for c in contexts], t) for i, t in enumerate((np.int64, np.int64, np.float64)))
    return np.array(contexts, np.uint64), np.where(_diverges(2 * (value - n * np.log(np.maximum(n, 1))), k), k, 0)


# -- scores ----------------------------------------------------------------

_NUMBERED = pa.schema([*(_PART.field(c) for c in ("part", "doc_id", "held", "at", "code")), ("symbol", pa.binary()), ("seen", pa.binary())])
_KNOWN = pa.schema([*_NUMBERED, ("n", pa.binary()), ("k", pa.binary())])
_NUMBERED_SQL = "part long, doc_id array<long>, held array<boolean>, at binary, code binary, symbol binary, seen binary"


_SUMS = ("total", "distinct", "once", "twice")
_WORDS = pa.schema([("bucket", pa.int64()), ("part", pa.int64()), ("m", pa.int64()), ("words", pa.binary()), ("seen", pa.binary())])
_WORDS_SQL = "bucket long, part long, m long, words binary, seen binary"
_CODES = pa.schema([("part", pa.int64()), ("bucket", pa.int64()), ("m", pa.int64()), ("answer", pa.binary()), *((c, pa.int64()) for c in _SUMS)])
_CODES_SQL = f"part long, bucket long, m long, answer binary, {', '.join(f'{c} long' for c in _SUMS)}"


def _asked_words(n_buckets: int):
    """The words of a part by buckets, which are ranges of the hashes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, m, words, seen in (r for batch in batches for r in zip(*batch.columns)):
            if not m.as_py():
                continue
            lines = pc.split_pattern(pa.array([words.as_py()], pa.binary()), "\n").flatten()
            count = _spread(seen.as_py(), m.as_py())
            bucket = (_hashed(lines) >> _HALF) * np.uint64(n_buckets) >> _HALF
            first = np.searchsorted(bucket, np.arange(n_buckets + 1, dtype=np.uint64))
            some = np.flatnonzero(np.diff(first))
            joined = pc.binary_join(pa.ListArray.from_arrays(np.r_[first[some], len(lines)].astype(np.int32), lines), b"\n")
            yield pa.RecordBatch.from_arrays(
                [pa.array(some), pa.array([part.as_py()] * len(some), pa.int64()), pa.array(np.diff(first)[some]), joined,
                 pa.array(_blocks([count], [*first[some].tolist(), len(lines)]), pa.binary())], schema=_WORDS)
    return run


def _word_answers(n_buckets: int):
    """Counts and symbols of a bucket's words for each part, and a row with
    part -1: the bucket's sums.  The bucket's most frequent words get the
    smallest symbols, which squeeze well."""
    def run(asked: pa.Table) -> pa.Table:
        bucket, m = asked.column("bucket")[0].as_py(), asked.column("m").to_pylist()
        lines = pc.split_pattern(asked.column("words").cast(pa.large_binary()).combine_chunks(), "\n").flatten().dictionary_encode()
        code = lines.indices.to_numpy()
        seen, = _columns(asked.column("seen").to_pylist(), m, 1)
        n = np.zeros(len(lines.dictionary), np.int64)
        np.add.at(n, code, seen.astype(np.int64))
        symbol = np.empty(len(n), np.int64)
        symbol[np.argsort(-n, kind="stable")] = FIRST_WORD + np.arange(len(n)) * n_buckets + bucket
        if symbol.max() >= 2 ** 32:
            raise ValueError("more different words than symbols of 32 bits")
        answers = pa.Table.from_arrays(
            [asked.column("part"), asked.column("bucket"), asked.column("m"),
             pa.array(_blocks([n[code], symbol[code]], np.cumsum([0, *m]).tolist()), pa.binary()), *[pa.nulls(len(m), pa.int64())] * len(_SUMS)], schema=_CODES)
        row = {"part": -1, "bucket": bucket, "m": 0, "total": int(n.sum()), "distinct": int((n > 0).sum()),
               "once": int((n == 1).sum()), "twice": int((n == 2).sum())}
        return pa.concat_tables([answers, pa.Table.from_pylist([row], _CODES)])
    return run


def _numbered(part: pa.Table, codes: pa.Table) -> pa.Table:
    """The part with the symbol and the count of each word code; codes are now
    in the order of the symbols."""
    seen, symbol = _answer(codes)
    at = part.column("at")[0].as_py()
    order, _, rank = _ranked(symbol)
    code = rank[_spread(part.column("code")[0].as_py(), int(np.frombuffer(at, "<i8")[-1])).astype(np.int64)]
    return pa.Table.from_arrays([*part.select(["part", "doc_id", "held", "at"]).columns,
                                 *(pa.array([_squeezed(x)], pa.binary()) for x in (code, symbol[order], seen[order]))], schema=_NUMBERED)


class _Part:
    """The tokens of a numbered part.  Here words are their codes from FIRST_WORD on."""

    def __init__(self, row: dict, ends: int):
        self.ends, self.number = ends, row["part"].as_py()
        at = np.frombuffer(row["at"].as_py(), "<i8")
        code = _spread(row["code"].as_py(), int(at[-1])).astype(np.int64)
        size = int(code.max(initial=-1)) + 1
        symbol, seen = (_spread(row[c].as_py(), size) for c in ("symbol", "seen"))
        self.symbol = np.r_[np.array([START, END], np.uint64), symbol]
        self.seen = np.r_[ends, ends, seen.astype(np.int64)]  # a start before, and an end after every text
        self.size = np.diff(at) + 1
        self.first = at[:-1] + np.arange(len(at) - 1)
        last = self.first + self.size - 1
        word = np.ones(int(self.size.sum()), bool)
        word[last] = False
        self.token = np.full(len(word), END, np.int64)
        self.token[word] = code + FIRST_WORD
        self.train = np.repeat(~row["held"].values.to_numpy(zero_copy_only=False).astype(bool), self.size)

    def _ranked(self, context: np.ndarray, total: np.ndarray) -> tuple[np.ndarray, ...]:
        """Level's ``where``, ``entry`` and ``at``, if these are the tokens' contexts and their totals."""
        where = np.flatnonzero((total > 1)[context])
        order, first, entry = _ranked(context[where] * len(self.symbol) + self.token[where])
        return where, entry, where[order[first]]

    def one(self) -> Level:
        before = np.roll(self.token, 1)
        before[self.first] = START
        where, entry, at = self._ranked(before, self.seen)
        context, symbol = before[at], self.token[at]
        return Level(self.symbol[context], self.symbol[symbol], self.seen[context], self.seen[symbol], np.zeros(len(at), np.int64), where, entry, at)

    def two(self, one: Level, n: np.ndarray) -> Level:
        """``n``: the counts of the level below.  A context of two is an entry
        there, or is seen at most once, or is two starts."""
        entry = np.full(len(self.token), len(n), np.int64)
        entry[one.where] = one.entry
        context = np.roll(entry, 1)
        context[self.first] = len(n) + 1
        total = np.r_[n, 0, self.ends]
        where, ranked, at = self._ranked(context, total)
        pair = np.r_[(one.context << _HALF) | one.symbol, np.array([0, START], np.uint64)]
        return Level(pair[context[at]], self.symbol[self.token[at]], total[context[at]], n[entry[at]], one.total[entry[at]], where, ranked, at)


def _asked_one(ends: int, n_buckets: int, hot: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                part = _Part({c: batch.column(c)[k] for c in batch.schema.names}, ends)
                yield from part.one().rows(part.number, part.train, n_buckets, hot).to_batches()
    return run


def _with_one(ends: int, n_buckets: int, hot: int, often):
    """The part with the answers of the first level."""
    def run(row: pa.Table, answers: pa.Table) -> pa.Table:
        part = _Part({c: row.column(c)[0] for c in row.schema.names}, ends)
        found = part.one().answered(answers, often.value, n_buckets, hot)
        return pa.Table.from_arrays([*row.select(_NUMBERED.names).columns, *(pa.array([_squeezed(x)], pa.binary()) for x in found)], schema=_KNOWN)
    return run


def _levels(part: _Part, row: dict) -> tuple[Level, np.ndarray, np.ndarray, Level]:
    """The first level with its counts and followers, and the second."""
    one = part.one()
    n, k = (_spread(row[c].as_py(), len(one.at)).astype(np.int64) for c in ("n", "k"))
    return one, n, k, part.two(one, n)


def _asked_two(ends: int, n_buckets: int, hot: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = {c: batch.column(c)[k] for c in batch.schema.names}
                part = _Part(row, ends)
                yield from _levels(part, row)[-1].rows(part.number, part.train, n_buckets, hot).to_batches()
    return run


_SCORES = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
                     ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])


def _document_scores(words: Words, n_buckets: int, hot: int, often):
    # In Arrow, as pandas would turn a list of ids with a null among them into floats.
    def run(row: pa.Table, answers: pa.Table) -> pa.Table:
        own = {c: row.column(c)[0] for c in row.schema.names}
        part = _Part(own, words.ends)
        one, n, k, two = _levels(part, own)
        p = one.predicted(n, k, words.probability(part.seen)[part.token])
        p = two.predicted(*two.answered(answers, often.value, n_buckets, hot), p)
        seen = part.seen[part.token]
        # Pairwise sums: one by one, the rounding errors of millions of tokens add up.
        each = lambda x: np.add.reduceat(x, part.first)
        return pa.Table.from_arrays([
            row.column("doc_id")[0].values, row.column("held")[0].values, pa.array(part.size), pa.array(each((seen > 0).astype(np.int64))),
            pa.array(np.full(len(part.first), words.total, np.int64)),
            pa.array(each(np.log10((part.seen + 0.1) / (words.total + 0.1 * (words.distinct + 1)))[part.token])), pa.array(each(np.log10(p)))], schema=_SCORES)
    return run


def _written(ws: Workspace, df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table; nothing reads its shuffle files again."""
    conf, kept = ws.spark.conf, ws.spark.conf.get(_CLEANUP)
    conf.set(_CLEANUP, "true")
    try:
        return ws.table(df, name)
    finally:
        conf.set(_CLEANUP, kept)


def score_documents(ws: Workspace, docs: DataFrame, held: Column) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of ``docs``.

    Trained on the documents where ``held`` is false; base_score is that of
    single tokens with 0.1 added to every count.  Null and empty texts are
    one end; repeated rows are counted and scored once each; an empty table
    gives no rows; without training documents every score is 0; other
    columns are not read.
    """
    spark, hot = ws.spark, HOT

    def by_part(part: DataFrame, answers: DataFrame):
        return part.groupBy("part").cogroup(answers.where("part >= 0").select("part", "bucket", "m", "answer").groupBy("part"))

    parts = ws.table(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", held.alias("held"))
                     .mapInArrow(_parts, _PART_SQL), "parts")
    size = parts.agg(F.count("*").alias("n"), F.sum(F.size(F.filter("held", lambda h: ~h))).alias("ends")).first()
    n_parts, ends = max(1, size["n"]), size["ends"] or 0
    of_words, n_buckets = -(-n_parts // WORDS_OF), -(-n_parts // ENTRIES_OF)
    # Written, so that the words' shuffle files are gone when the parts are shuffled.
    of_part = _written(ws, parts.select("part", "m", "words", "seen").mapInArrow(_asked_words(of_words), _WORDS_SQL)
                       .groupBy("bucket").applyInArrow(_word_answers(of_words), _CODES_SQL), "of_part")
    words = train_words(of_part.where("part < 0"), ends)
    numbered = _written(ws, by_part(parts.select("part", "doc_id", "held", "at", "code"), of_part)
                        .applyInArrow(_numbered, _NUMBERED_SQL), "numbered")
    ws.remove("parts", "of_part")

    def answered(asked: DataFrame, name: str) -> DataFrame:
        return _written(ws, asked.groupBy("bucket").applyInArrow(_answers(words), _ANSWER_SQL), name)

    send = spark.sparkContext.broadcast
    one = answered(numbered.mapInArrow(_asked_one(ends, n_buckets, hot), _ASKED_SQL), "one")
    known = _written(ws, by_part(numbered, one).applyInArrow(_with_one(ends, n_buckets, hot, send(_hot(one))), f"{_NUMBERED_SQL}, n binary, k binary"), "known")
    ws.remove("numbered", "one")
    two = answered(known.mapInArrow(_asked_two(ends, n_buckets, hot), _ASKED_SQL), "two")
    return by_part(known, two).applyInArrow(
        _document_scores(words, n_buckets, hot, send(_hot(two))),
        "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
