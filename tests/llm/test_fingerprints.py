from __future__ import annotations

import hashlib
import re

from llm_fixtures import SF_SMALL, make_docs, ws  # noqa: F401
from pyspark.sql import functions as F

from stationlake.llm import fingerprints as fp
from stationlake.llm.queries import QUERIES


def shingles(text):
    w = [x for x in re.split(r"[\W_]+", (text or "").lower()) if x]
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def test_query_meets_the_contract(spark):
    docs = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect())
    got = {r.doc_id: r for r in QUERIES["op6_fingerprints"](spark, SF_SMALL).collect()}
    assert len(got) == len(docs)
    error, prints = [], {}
    for k, (key, text) in enumerate(docs):
        following = docs[(k + 1) % len(docs)][1]
        half = len(text) // 2
        edited = text[:len(text) - half] + following[:half]
        r = got[key]
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        error.append(abs(r.near_edited - jaccard(shingles(text), shingles(edited))))
        error.append(abs(r.near_next - jaccard(shingles(text), shingles(following))))
        assert prints.setdefault(text, r.fingerprint) == r.fingerprint
    assert sum(error) / len(error) < 0.03 and max(error) < 0.25


def test_neighbours_in_many_buckets_with_null_and_repeated_ids(spark, make_docs):
    rows = [(i, f"text number {i}") for i in range(40)] + [(None, None), (7, "other"), (7, "other"), (7, "z" * 50_000)]
    docs = make_docs(rows).withColumn("next", F.lit("old")).drop("next")
    got = fp.with_next(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")), ["doc_id", "text"], bucket_bytes=400).collect()
    assert len(got) == len(rows)
    follows = {(r.doc_id, r.text): (r.next.doc_id, r.next.text) for r in got}
    assert follows[None, ""] == (0, "text number 0") and follows[39, "text number 39"] == (None, "")
    assert sum(r.doc_id == 7 and r.next.doc_id == 7 for r in got) == 3
    assert all(r.next.doc_id == r.doc_id + 1 for r in got if r.doc_id is not None and r.doc_id not in (6, 7, 39))
    one = fp.with_next(make_docs([(5, "a")]), ["text"]).collect()
    assert [(r.doc_id, r.next.text) for r in one] == [(5, "a")]


def test_merge_containment_and_counts(spark):
    text = " ".join(f"w{i}" for i in range(3000))
    parts = spark.createDataFrame([("d", " ".join(f"w{i}" for i in range(a, b))) for a, b in ((0, 1504), (1500, 3000))] + [("e", ""), ("e", None)],
                                  "doc string, text string").withColumn("sketch", fp.sketch(F.col("text")))
    merged = {r.doc: r.sketch for r in fp.merge_parts(parts, ["doc"]).collect()}
    whole = spark.createDataFrame([(text,)], "text string").select(fp.sketch(F.col("text")).alias("s")).first().s
    assert merged["d"] == whole and merged.get("e", []) == []
    est = spark.createDataFrame([(whole, parts.where("doc = 'd'").first().sketch)], "a array<long>, b array<long>").select(
        fp.distinct_shingles(F.col("a")).alias("n"), fp.containment(F.col("b"), F.col("a")).alias("inside"),
        fp.resemblance(F.col("a"), F.col("b")).alias("r")).first()
    assert abs(est.n - 2996) < 900 and est.inside > 0.8 and 0.3 < est.r < 0.7


def test_empty_table(spark, make_docs):
    assert fp.with_next(make_docs([]).select("doc_id", "text"), ["text"]).collect() == []


def test_columns_named_like_internal_ones(spark, make_docs):
    docs = make_docs([(3, "c"), (1, "a"), (2, "b"), (2, "b"), (None, "n")])
    names = ["key", "bucket", "before", "borrowed", "_key", "_bucket", "_borrowed", "next"]
    for name in names:
        docs = docs.withColumn(name, F.lit(name))
    rows = fp.with_next(docs, ["text"], bucket_bytes=1).collect()
    assert [(r.doc_id, r.next.text) for r in sorted(rows, key=lambda r: (r.doc_id is not None, r.doc_id or 0))][0] == (None, "a")
    assert sorted((r.text, r.next.text) for r in rows) == [("a", "b"), ("b", "b"), ("b", "c"), ("c", "n"), ("n", "a")]
    assert all(r[n] == n for r in rows for n in names[:-1])
