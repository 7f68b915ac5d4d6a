"""Quality rules of documents, and of the hosts that they come from.

Every document is measured and judged by each rule.  Rule failures are
counted by host; a host's failure rate is shrunk towards that of all hosts
with a beta prior whose mean and strength are estimated from the hosts
themselves (the spread of their rates beyond what chance gives), so a host
of few documents is not judged by them alone.  A host whose shrunk rate of
some rule exceeds ``HOST_LIMIT`` is rejected, and that verdict is joined
back: its documents go, whatever they are like.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stationlake.llm.common import Workspace, unused
from stationlake.llm.tokens import slices
from stationlake.session import ship_package

MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"]
#: A rejected host's shrunk rate of some rule is over this.
HOST_LIMIT = 0.5
#: Correlation within hosts where it cannot be estimated, and its least and greatest value.
DEFAULT_CORRELATION, LEAST_CORRELATION = 0.01, 1e-6
#: Rejected hosts up to this many (about 10 MB) are broadcast; more are joined by a salted shuffle.
BROADCAST_HOSTS, SALTS = 100_000, 64

WINDOW = 3
_SYMBOL = np.isin(np.arange(256), list(b"#*$%&|<>"))


def rules() -> dict[str, Column]:
    """Whether a measured document fails each rule; the first two are the base."""
    n = F.col("n_words")
    return {
        "few_words": n < 50,
        "repeats": 100 * F.col("n_repeat_words") > 50 * n,
        "symbols": 10 * F.col("n_symbols") > n,
        "dup_lines": 10 * F.col("n_dup_lines") > 3 * F.col("n_lines"),
        "word_length": (F.col("word_chars") < 2 * n) | (F.col("word_chars") > 12 * n),
    }


BASE = ("few_words", "repeats")


# -- measures --------------------------------------------------------------

def _ranks(high: np.ndarray, n_high: int, low: np.ndarray, n_low: int) -> tuple[np.ndarray, int]:
    """Numbers for the pairs (high, low), equal just for equal pairs, and their bound."""
    if n_high > 2**62 // max(1, n_low):
        found, high = np.unique(high, return_inverse=True)
        n_high = len(found)
    return high * n_low + low, n_high * n_low


def _counts(keys: np.ndarray) -> np.ndarray:
    """How often each element's value occurs."""
    _, which, n = np.unique(keys, return_inverse=True, return_counts=True)
    return n[which]


def _repeat_words(codes: np.ndarray, n_codes: int, doc: np.ndarray, n_docs: int) -> np.ndarray:
    """Words in windows that occur twice or more in their text, per text."""
    if len(codes) < WINDOW:
        return np.zeros(n_docs, np.int64)
    last = len(codes) - WINDOW + 1
    inside = np.flatnonzero(doc[:last] == doc[WINDOW - 1:])
    key, bound = doc[inside].astype(np.int64), n_docs
    for j in range(WINDOW):
        key, bound = _ranks(key, bound, codes[inside + j], n_codes)
    again = inside[_counts(key) > 1]
    covered = np.zeros(len(codes), bool)
    for j in range(WINDOW):
        covered[again + j] = True
    return np.bincount(doc[covered], minlength=n_docs)


def measure_texts(texts: pa.Array) -> dict[str, np.ndarray]:
    """MEASURES of each text: words (runs without ASCII white space), their
    code points, symbol characters, lines with a word that equal an earlier
    line, words in repeated three-word windows, and lines with a word.  Null
    texts have none of these."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    n_docs = len(texts)
    lists = pc.ascii_split_whitespace(texts)
    coded = lists.flatten().dictionary_encode()
    codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    doc = np.repeat(np.arange(n_docs), np.diff(lists.offsets.to_numpy()))
    chars = pc.utf8_length(coded.dictionary).to_numpy(zero_copy_only=False).astype(np.int64)
    if len(codes):  # the splitter gives empty words at the ends of a text
        real = chars[codes] > 0
        codes, doc = codes[real], doc[real]

    lines = pc.split_pattern(texts, "\n")
    line = lines.flatten().dictionary_encode()
    worded = np.fromiter((bool(x.strip()) for x in line.dictionary.cast(pa.large_binary()).to_pylist()), bool, len(line.dictionary))
    of, kind = np.repeat(np.arange(n_docs), np.diff(lines.offsets.to_numpy())), line.indices.to_numpy(zero_copy_only=False)
    kept = worded[kind] if len(kind) else np.zeros(0, bool)
    of, kind = of[kept], kind[kept].astype(np.int64)
    distinct = np.unique(of * (len(worded) + 1) + kind) // (len(worded) + 1)
    n_lines = np.bincount(of, minlength=n_docs)

    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64, n_docs + 1, texts.offset * 8) if n_docs else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8)[at[0]:at[-1]] if data is not None and data.size else np.zeros(0, np.uint8)
    symbols = np.concatenate(([0], np.cumsum(_SYMBOL[raw], dtype=np.int64)))[at - at[0]]
    return {
        "n_words": np.bincount(doc, minlength=n_docs),
        "word_chars": np.bincount(doc, chars[codes] if len(codes) else None, n_docs).astype(np.int64),
        "n_symbols": np.diff(symbols),
        "n_dup_lines": n_lines - np.bincount(distinct, minlength=n_docs),
        "n_repeat_words": _repeat_words(codes, len(chars), doc, n_docs),
        "n_lines": n_lines,
    }


def _measured(text: str, keep: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in slices(batch.column(text)):
                part = batch.slice(lo, hi - lo)
                own = measure_texts(part.column(text))
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in keep), *(pa.array(own[m].astype(np.int64)) for m in MEASURES)], [*keep, *MEASURES])
    return run


def measure(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (default: all) of ``docs`` and the MEASURES of ``text``.

    Columns with a measure's name are replaced; empty texts measure zero.
    """
    ship_package(docs.sparkSession)
    keep = [c for c in (docs.columns if keep is None else keep) if c.lower() not in MEASURES]
    docs = docs.select(*dict.fromkeys([*keep, text]))
    schema = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema] + [f"{m} long" for m in MEASURES]
    return docs.mapInArrow(_measured(text, keep), ", ".join(schema))


# -- hosts -----------------------------------------------------------------

@dataclass(frozen=True)
class Prior:
    """Beta(a, b) of a rule's failure rate over hosts."""

    a: float
    b: float


def fit_prior(n_hosts: int, n_docs: int, n_failed: int, sum_n2: float, sum_rate2: float) -> Prior:
    """By moments, from sums over the hosts: documents, failed ones, squares
    of their documents, and (failed squared / documents).

    The correlation within hosts is the spread of their rates beyond a
    binomial's; without failures, or with them alone, or from one host, it
    cannot be told and is ``DEFAULT_CORRELATION``.
    """
    mean = n_failed / n_docs if n_docs else 0.0
    spread = sum_rate2 - n_docs * mean * mean
    free = n_docs - (sum_n2 / n_docs if n_docs else 0.0) - (n_hosts - 1)
    rho = DEFAULT_CORRELATION
    if 0 < mean < 1 and n_hosts > 1 and free > 0:
        rho = min(max((spread / (mean * (1 - mean)) - (n_hosts - 1)) / free, LEAST_CORRELATION), 1 - LEAST_CORRELATION)
    strength = 1 / rho - 1
    return Prior(mean * strength, (1 - mean) * strength)


def host_rates(measured: DataFrame, host: str = "host") -> tuple[DataFrame, dict[str, Prior]]:
    """(one row per host: its documents, failures and shrunk rate of every
    rule, rejected), and the priors.  A document without host counts in none."""
    hosts = (measured.where(F.col(host).isNotNull()).groupBy(host)
             .agg(F.count("*").alias("n_docs"), *(F.sum(failed.cast("long")).alias(f"failed_{r}") for r, failed in rules().items())))
    n = F.col("n_docs").cast("double")
    sums = hosts.agg(F.count("*").alias("hosts"), F.sum("n_docs").alias("docs"), F.sum(n * n).alias("n2"),
                     *(F.sum(f"failed_{r}").alias(f"k_{r}") for r in rules()),
                     *(F.sum(F.col(f"failed_{r}").cast("double") * F.col(f"failed_{r}") / n).alias(f"q_{r}") for r in rules())).first()
    priors = {r: fit_prior(sums["hosts"], sums["docs"] or 0, sums[f"k_{r}"] or 0, sums["n2"] or 0.0, sums[f"q_{r}"] or 0.0) for r in rules()}
    rates = {f"rate_{r}": (F.col(f"failed_{r}") + F.lit(p.a)) / (n + F.lit(p.a + p.b)) for r, p in priors.items()}
    return hosts.withColumns(rates).withColumn("rejected", F.greatest(*(F.col(c) for c in rates)) > HOST_LIMIT), priors


def _with_verdict(measured: DataFrame, rejected: DataFrame, host: str, n_rejected: int, broadcast_hosts: int) -> DataFrame:
    """``measured`` with ``host_rejected``; ``rejected`` has distinct hosts."""
    key, salt, own_salt = (unused(c, measured.columns) for c in ("rejected_host", "salt", "own_salt"))
    marked = rejected.select(F.col(host).alias(key), F.lit(True).alias("host_rejected"))
    if n_rejected <= broadcast_hosts:
        joined = measured.join(F.broadcast(marked), F.col(host) == F.col(key), "left").drop(key)
    else:  # a host's documents are spread over the salts
        salted = marked.withColumn(salt, F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        own = measured.withColumn(own_salt, F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int"))
        joined = own.join(salted, (F.col(host) == F.col(key)) & (F.col(own_salt) == F.col(salt)), "left").drop(key, salt, own_salt)
    return joined.withColumn("host_rejected", F.coalesce("host_rejected", F.lit(False)))


def judge(ws: Workspace, docs: DataFrame, host: Column, text: str = "text", keep: list[str] | None = None,
          broadcast_hosts: int = BROADCAST_HOSTS) -> DataFrame:
    """``docs`` with MEASURES, ``host``, ``base_failed``, ``host_rejected`` and ``kept``.

    Kept is what passes the base rules and comes from no rejected host.  Null
    and empty texts have no words and so fail; a null host is no host: its
    documents are judged by the base rules alone; repeated rows count like
    others.  Columns of the new names are replaced; ``keep`` limits the
    columns that are carried along (default: all).
    """
    new = ["host", "base_failed", "host_rejected", "kept", *MEASURES]
    host_of = unused("host_of", docs.columns)
    carried = [c for c in (docs.columns if keep is None else keep) if c.lower() not in new]
    measured = measure(docs.withColumn(host_of, host), text, [*carried, host_of]).withColumnRenamed(host_of, "host")
    table = ws.table(measured, "measured")
    rates, _ = host_rates(table)
    rejected = ws.table(rates.where("rejected"), "rejected")
    base = F.lit(False)
    for r in BASE:
        base = base | rules()[r]
    verdict = _with_verdict(table, rejected, "host", rejected.count(), broadcast_hosts)
    return verdict.withColumn("base_failed", base).withColumn("kept", ~F.col("base_failed") & ~F.col("host_rejected"))
