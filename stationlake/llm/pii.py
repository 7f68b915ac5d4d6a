"""Personal data by candidate gradient boosting, in DataFrame operations only.

Generators propose spans of high recall: the four fixed patterns (kinds
email, ip, card, phone) and looser ones of the same kinds, which overlap.
A gradient-boosted classifier (Spark ML) learns from all candidates, counted
by their features, which of them pass their kind's rule, from format and
context alone; its trees become one SQL expression, so scoring runs in the
scan.
Fixed-pattern spans that pass the rule always stay.  Of what overlaps none of
them, looser candidates that pass their own rule are added, and those above
their kind's calibrated threshold, the best of overlapping ones.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stationlake.llm import spans as S
from stationlake.llm.common import empty_if_null, parts_for

KINDS = ["email", "ip", "card", "phone"]

# The contract's patterns, written so that Java's matcher needs
# no recursion.  "Not after a character of the first class, or where the last
# match ended" starts a match where a leftmost search would.
_START = r"(?:(?<![{0}])|\G)"
BASE = {
    "email": _START.format("A-Za-z0-9._%+-") + r"[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": _START.format("0-9") + r"[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": _START.format("0-9") + r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# Looser patterns of the same kinds: spelled-out addresses, IPv6, grouped
# digits, national numbers.
LOOSE = {
    "email": (r"(?<![A-Za-z0-9])[A-Za-z0-9._%+-]{1,64}+(?:\x20?[(\[](?:at|@)[)\]]\x20?|\x20at\x20)"
              r"[A-Za-z0-9-]{1,63}+(?:\x20?[(\[](?:dot|\.)[)\]]\x20?|\x20dot\x20)[A-Za-z]{2,10}+(?![A-Za-z0-9])"),
    "ip": r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){3,7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])",
    "card": r"(?<![0-9])[0-9]{3,6}+(?:[.\x20/-][0-9]{2,6}+){2,5}+(?![0-9])",
    "phone": r"(?<![0-9+])(?:\([0-9]{2,4}\)\x20?|[0-9]{2,4}[\x20.-])[0-9]{3,4}[\x20.-][0-9]{3,5}(?![0-9])",
}
# Words that announce a kind.
CUES = {"email": "mail|e-mail|contact|write", "ip": "ip|host|server|addr|address", "card": "card|visa|credit|iban|account",
        "phone": "tel|phone|call|mobile|fax"}
# Domains that make "name at host dot domain" an address without brackets or a cue.
_DOMAINS = "com|org|net|edu|gov|mil|info|io|de|fr|uk|nl|es|eu|ch|pl|se|ca|au|jp|cn|br|ru"
# What every match of a kind's fixed, and of its looser, pattern contains.
_NEEDS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][\x20-]?[0-9]", "phone": r"\+[0-9]"}
_LOOSE_NEEDS = {"email": r"@|\bat\b", "ip": "[0-9A-Fa-f]:", "card": "[0-9]{3}[.\x20/-]", "phone": r"[0-9]{2}[)\x20.-]"}

TREES, DEPTH, STEP = 12, 3, 0.3
#: Split points per feature, at least.
LEAST_BINS = 100
FORMS_PER_TASK = 20_000
#: Least share of valid candidates above a kind's threshold, on the held-out part.
PRECISION = 0.99
_CONTEXT = 24


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(value: Column) -> Column:
    reverse = F.reverse(_digits(value))

    def total(d: Column) -> Column:
        places = F.sequence(F.lit(1), F.length(d))
        digit = lambda i: d.substr(i, F.lit(1)).cast("int")
        return F.aggregate(places, F.lit(0), lambda s, i: s + F.when(i % 2 == 1, digit(i)).otherwise(
            digit(i) * 2 - F.when(digit(i) > 4, 9).otherwise(0)))

    return S.let(reverse, lambda d: F.when(F.length(d).between(13, 19), total(d) % 10 == 0).otherwise(False))


def valid(kind: str, value: Column) -> Column:
    """The validity rule of a kind."""
    if kind == "ip":
        return F.forall(F.split(value, r"\."), lambda p: S.let(
            F.regexp_replace(p, "^0+(?=.)", ""), lambda q: (F.length(q) <= 3) & (F.lpad(q, 3, "0") <= "255")))
    if kind == "card":
        return _luhn(value)
    if kind == "phone":
        return F.length(_digits(value)).between(9, 15)
    return F.lit(True)


def _cue(c: Column) -> Column:
    """Whether a word that announces the candidate's kind stands before it."""
    found = F.lit(False)
    for kind, words in CUES.items():
        found = F.when(c["kind"] == kind, F.lower(c["before"]).rlike(rf"\b(?:{words})\b")).otherwise(found)
    return found


def plausible(kind: str, c: Column) -> Column:
    """The rule of a kind's looser candidates: what fixed patterns would call
    valid once it is normalised, and a cue or a telling form where that says little."""
    value = c["value"]
    if kind == "email":  # brackets around "at" or "dot", a known domain, or a cue
        return value.rlike(r"[(\[]") | F.lower(value).rlike(rf"(?:dot\x20|\.)(?:{_DOMAINS})$") | _cue(c)
    if kind == "ip":  # all eight groups
        return value.rlike("^(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}$")
    if kind == "card":
        return _luhn(value)
    return F.length(_digits(value)).between(9, 15) & (value.startswith("(") | _cue(c))


def _rule(kind: str):
    return lambda s: valid(kind, s["value"])


def base_spans(text: str | Column = "text") -> Column:
    """The fixed-pattern spans that pass their rule, by kind, then start."""
    t = empty_if_null(text)
    found = []
    for kind in KINDS:
        spans = F.filter(S.matches(t, kind, BASE[kind]), _rule(kind))
        found.append(S.where_contains(t, _NEEDS[kind], spans))
    return F.concat(*found)


def candidates(text: str | Column = "text") -> Column:
    """What either set of patterns proposes, with the context of each:
    kind, start, end, value, loose, before, after."""
    t = empty_if_null(text)

    def dressed(spans: Column, loose: bool) -> Column:
        return F.transform(spans, lambda s: F.struct(
            s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["value"].alias("value"),
            F.lit(loose).alias("loose"),
            t.substr(F.greatest(s["start"] - _CONTEXT, F.lit(0)) + 1, F.least(s["start"], F.lit(_CONTEXT))).alias("before"),
            t.substr(s["end"] + 1, F.lit(2)).alias("after")))

    parts = []
    for kind in KINDS:
        for loose, patterns, needs in ((False, BASE, _NEEDS), (True, LOOSE, _LOOSE_NEEDS)):
            parts.append(dressed(S.where_contains(t, needs[kind], S.matches(t, kind, patterns[kind])), loose))
    return F.concat(*parts)


def features(c: Column) -> Column:
    """Format and context of a candidate, as an array of doubles.  Validity
    rules are not among them."""
    value, before = c["value"], F.lower(c["before"])
    n = F.length(value)
    digits = F.length(_digits(value))
    seps = F.length(F.regexp_replace(value, r"[^\x20.()/:-]", ""))
    flags = [c["kind"] == k for k in KINDS[1:]]
    flags += [value.contains("@"), value.startswith("+"), value.contains("("), value.rlike(r"\.[A-Za-z]{2,4}$"),
              value.rlike("^([0-9])\\1*$"), before.rlike(r"[\p{L}0-9_]$"), before.rlike(r"[=:]\x20?$"), c["after"].rlike(r"^[\p{L}0-9_]")]
    numbers = [n, digits, seps, digits / F.greatest(n, F.lit(1)), F.size(F.split(value, r"[\x20.()/:@-]+"))]
    return F.array(*(x.cast("double") for x in [*numbers, *flags, _cue(c)]))


@dataclass(frozen=True)
class Model:
    """Trees as (weight, node); a node is a number or (feature, threshold, left, right).
    Kinds without a threshold get no candidates by probability."""

    trees: tuple
    thresholds: dict[str, float]

    def probability(self, f: Column) -> Column:
        def value(node) -> Column:
            if isinstance(node, float):
                return F.lit(node)
            feature, at, left, right = node
            return F.when(f[feature] <= at, value(left)).otherwise(value(right))

        margin = F.lit(0.0)
        for weight, node in self.trees:
            margin = margin + value(node) * weight
        return F.lit(1.0) / (F.lit(1.0) + F.exp(margin * -2.0))

    def likely(self, c: Column) -> Column:
        """Whether a candidate's probability ``p`` reaches its kind's threshold."""
        out = F.lit(False)
        for kind, least in self.thresholds.items():
            out = F.when(c["kind"] == kind, c["p"] >= least).otherwise(out)
        return out


def _node(java) -> float | tuple:
    if java.subtreeDepth() == 0:
        return float(java.prediction())
    split = java.split()
    return split.featureIndex(), float(split.threshold()), _node(java.leftChild()), _node(java.rightChild())


def _passes(c: Column) -> Column:
    """Whether a candidate passes the rule of its kind and patterns."""
    rule = F.lit(False)
    for kind in KINDS:
        own = F.when(c["loose"], plausible(kind, c)).otherwise(valid(kind, c["value"]))
        rule = F.when(c["kind"] == kind, own).otherwise(rule)
    return rule


def _overlap(a: Column, b: Column) -> Column:
    return (a["start"] < b["end"]) & (b["start"] < a["end"])


def _counted(docs: DataFrame) -> DataFrame:
    """How many candidates of ``docs`` (``n``) have the same features, label
    (valid by the rule of their patterns), kind, ``open`` (no fixed span
    overlaps them) and ``held`` (in the fifth that sets the thresholds)."""
    c = F.col("c")
    open_ = ~F.exists(F.col("base"), lambda b: _overlap(b, c))
    found = docs.select(base_spans().alias("base"), F.explode(candidates()).alias("c")).select(
        features(c).alias("f"), _passes(c).cast("double").alias("label"), c["kind"].alias("kind"),
        open_.alias("open"), (F.pmod(F.xxhash64("c"), F.lit(5)) == 0).alias("held"))
    return found.groupBy("f", "label", "kind", "open", "held").agg(F.count("*").cast("double").alias("n"))


def train(docs: DataFrame, precision: float = PRECISION) -> Model | None:
    """Learn from all candidates of all documents.

    Each is valid by the rule of its patterns.  Four fifths train the trees;
    on those of the rest that overlap no fixed span (which scoring asks about)
    every kind's threshold is set: the least tenth of a per cent above which
    at least ``precision`` of the candidates are valid.  Candidates of equal
    features are one weighted row, so what is learned from grows with the
    different forms alone.  None if the four fifths show one class only.
    """
    rows = _counted(docs).persist()
    try:
        forms = {r["label"]: r["n"] for r in rows.where("not held").groupBy("label").agg(F.count("*").alias("n")).collect()}
        if len(forms) < 2:
            return None
        # Split points come from all rows: Spark ML would draw maxBins squared of them if there were more.
        n_forms = sum(forms.values())
        bins = max(LEAST_BINS, math.isqrt(n_forms) + 1)
        booster = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=STEP, maxBins=bins, weightCol="n", seed=7)
        # The dozens of jobs of a fit would each have a task per shuffle partition, most of them empty.
        fitted = booster.fit(rows.where("not held").select(array_to_vector("f").alias("features"), "label", "n")
                             .coalesce(parts_for(n_forms, FORMS_PER_TASK)))
        trees = tuple((float(w), _node(t._java_obj.rootNode())) for w, t in zip(fitted.treeWeights, fitted.trees))
        model = Model(trees, {})
        steps = (rows.where("held and open").groupBy("kind", F.floor(model.probability(F.col("f")) * 1000).alias("step"))
                 .agg(F.sum(F.col("label") * F.col("n")).alias("good"), F.sum("n").alias("n")).collect())  # at most 4004 rows
    finally:
        rows.unpersist()
    for kind in KINDS:
        good = n = 0
        for r in sorted((r for r in steps if r["kind"] == kind), key=lambda r: -r["step"]):
            good, n = good + r["good"], n + r["n"]
            if good < precision * n:
                break
            model.thresholds[kind] = r["step"] / 1000
    return model


def find_personal_data(docs: DataFrame, model: Model | None, text: str = "text", base: str = "base_spans",
                       result: str = "pii_spans") -> DataFrame:
    """``docs`` with two arrays of (kind, start, end, value): ``base``, by kind,
    and ``result``, all spans by kind.

    Null and empty texts have none; columns with these names are replaced,
    others pass through.  Nothing is shuffled.
    """
    own = docs.withColumn(base, base_spans(text))
    if model is None:
        return own.withColumn(result, F.col(base))
    fixed = F.col(base)
    t = empty_if_null(text)
    # Fixed-pattern candidates that pass their rule are the fixed spans themselves, and
    # looser numbers that fail Luhn or have too few groups are none; of the rest the few
    # that pass or are likely are held against the fixed spans.
    judged = F.transform(candidates(t), lambda c: F.struct(c.alias("c"), _passes(c).alias("passes")))
    open_ = F.filter(judged, lambda j: F.when(
        j["c"]["loose"], j["passes"] | j["c"]["kind"].isin("email", "phone")).otherwise(~j["passes"]))
    scored = F.transform(open_, lambda j: S.let(j["c"], lambda c: F.struct(
        j["passes"].alias("passes"), S.let(features(c), model.probability).alias("p"), c["kind"].alias("kind"), c["start"].alias("start"),
        c["end"].alias("end"), c["value"].alias("value"))))
    likely = F.filter(scored, lambda c: (c["passes"] | model.likely(c)) & ~F.exists(fixed, lambda b: _overlap(b, c)))
    # Of overlapping candidates one that passes stays, then the likelier, then the earlier, then the longer.
    rank = lambda c: F.struct(c["passes"], c["p"], -c["start"], c["end"], -F.array_position(F.lit(KINDS), c["kind"]))
    best = S.let(likely, lambda all_: F.filter(all_, lambda c: ~F.exists(
        all_, lambda d: _overlap(c, d) & (rank(d) > rank(c)))))
    extra = F.transform(best, lambda c: F.struct(c["kind"], c["start"], c["end"], c["value"])).cast(S.SPAN)
    some = t.rlike("|".join([*_NEEDS.values(), *_LOOSE_NEEDS.values()]))
    return own.withColumn(result, F.when(some, S.by_kind(F.concat(fixed, extra), KINDS)).otherwise(fixed))


def redact(found: DataFrame, text: str = "text", result: str = "pii_spans") -> DataFrame:
    """``text`` with every span replaced by its kind, as in ``[EMAIL]``."""
    return found.withColumn(text, S.redacted(F.col(text), F.col(result)))
