"""Regular-expression matches with their places, as Spark SQL columns.

Patterns must not need backtracking over repeated groups: those are written
possessively, as Java's matcher recurses otherwise and a very long text
would exhaust its stack.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Type of a span in every array of this module.
SPAN = "array<struct<kind:string,start:int,end:int,value:string>>"
_BLOCK = 64


def let(value: Column, f: Callable[[Column], Column]) -> Column:
    """``f(value)`` with ``value`` computed once."""
    return F.transform(F.array(value), f)[0]


def running_total(sizes: Column) -> Column:
    """The sum of the elements before each element.

    In blocks, so that an array of n elements costs n * 64 steps, not n².
    """
    zero = F.lit(0)
    block = lambda a, b: F.slice(a, b * _BLOCK + 1, F.lit(_BLOCK))
    total = lambda a: F.aggregate(a, zero, lambda s, x: s + x)
    blocks = F.sequence(zero, F.floor((F.size(sizes) - 1) / _BLOCK).cast("int"))
    before = let(F.transform(blocks, lambda b: total(block(sizes, b))),
                 lambda sums: F.transform(sums, lambda _, i: total(F.slice(sums, F.lit(1), i))))
    placed = let(before, lambda starts: F.flatten(F.transform(starts, lambda s, b: let(
        block(sizes, b), lambda own: F.transform(own, lambda _, i: s + total(F.slice(own, F.lit(1), i)))))))
    return F.when(F.size(sizes) > 0, placed).otherwise(F.array().cast("array<int>"))


def matches(text: Column, kind: str, pattern: str, group: int = 0) -> Column:
    """The leftmost non-overlapping matches of ``pattern`` in ``text``.

    An array of (kind, start, end, value), in code points, end exclusive;
    value is the given group of the match.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = found if group == 0 else F.regexp_extract_all(text, F.lit(pattern), F.lit(group))

    def place(whole: Column, value: Column) -> Column:
        # The text between matches gives their places.
        between = F.transform(F.split(text, pattern, -1), lambda x: F.length(x))
        return let(between, lambda gaps: let(
            running_total(F.zip_with(F.slice(gaps, F.lit(1), F.size(whole)), whole, lambda g, m: g + F.length(m))),
            lambda starts: F.transform(whole, lambda m, i: F.struct(
                F.lit(kind).alias("kind"), (starts[i] + gaps[i]).alias("start"),
                (starts[i] + gaps[i] + F.length(m)).alias("end"), value[i].alias("value")))))

    none = F.array().cast(SPAN)
    return let(found, lambda whole: F.when(F.size(whole) == 0, none).otherwise(
        place(whole, whole) if group == 0 else let(values, lambda v: place(whole, v))))


def where_contains(text: Column, pattern: str, spans: Column) -> Column:
    """``spans`` where the text has a match of the cheap ``pattern``, else none."""
    return F.when(text.rlike(pattern), spans).otherwise(F.array().cast(SPAN))


def joined(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def by_start(spans: Column, kinds: list[str]) -> Column:
    """Ordered by start, then kind as listed, then end."""
    rank = lambda s: F.array_position(F.lit(kinds), s["kind"])
    return F.transform(
        F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("a"), rank(s).alias("b"), s["end"].alias("c"), s.alias("s")))),
        lambda x: x["s"])


def by_kind(spans: Column, kinds: list[str]) -> Column:
    """Ordered by kind as listed, then start, then end."""
    rank = lambda s: F.array_position(F.lit(kinds), s["kind"])
    return F.transform(
        F.array_sort(F.transform(spans, lambda s: F.struct(rank(s).alias("a"), s["start"].alias("b"), s["end"].alias("c"), s.alias("s")))),
        lambda x: x["s"])


def count(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def redacted(text: Column, spans: Column) -> Column:
    """``text`` with every span replaced by its kind in brackets; overlapping
    spans are replaced as one, by the kind of the first."""
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"], s["end"], s["kind"])))
    state = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))

    def step(acc: Column, s: Column) -> Column:
        apart = s["start"] >= acc["at"]
        piece = F.array(text.substr(acc["at"] + 1, s["start"] - acc["at"]), F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]")))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"),
                        F.when(apart, F.concat(acc["parts"], piece)).otherwise(acc["parts"]).alias("parts"))

    done = F.aggregate(ordered, state, step, lambda acc: F.concat(
        F.array_join(acc["parts"], ""), text.substr(acc["at"] + 1, F.length(text))))
    return F.when(F.size(spans) > 0, done).otherwise(text)
