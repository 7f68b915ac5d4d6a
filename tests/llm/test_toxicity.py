from __future__ import annotations

import zlib

import pyarrow as pa
from llm_fixtures import make_docs, ws  # noqa: F401
from pyspark.sql import functions as F

from stationlake.llm import toxicity
from stationlake.llm.common import fold
from stationlake.llm.queries import QUERIES

SF = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    """On documents whose labels were not seen; equal texts score equally."""
    got = QUERIES["op8_toxicity"](spark, SF)
    assert dict(got.dtypes) == {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"}
    rows = got.join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").where("held_out").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows)
    toxic = [r.predicted for r in rows if r.toxic]
    flagged = [r.toxic for r in rows if r.predicted]
    assert sum(toxic) / len(toxic) > 0.85 and sum(flagged) / len(flagged) > 0.97
    texts = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    assert got.join(texts, "doc_id").groupBy("text").agg(F.count_distinct("score").alias("n")).where("n > 1").count() == 0


def sample():
    ordinary = [f"the quiet river number{i} flows past house{i} and field" for i in range(60)]
    return ordinary + [t + " you vile blockhead" for t in ordinary[:20]], [0] * 60 + [1] * 20


def test_words_of_toxic_texts_decide():
    model = toxicity.fit(*sample())
    got = toxicity.score_texts(model, pa.array(
        ["the calm lake number71 flows past house82 and mill you vile blockhead", "the calm lake number71 flows past house82 and mill",
         None, "", "x " * 500_000, "a vile blockhead came"], pa.string()))
    assert got[0] > 0.7 and max(got[1:5]) < 0.3 and got[2] == got[3] and got[5] > got[1]
    assert len(toxicity.score_texts(model, pa.array([], pa.string()))) == 0


def test_toxic_words_inside_long_runs_count():
    """Between other joints than ASCII spaces, and in the middle of one long run."""
    model = toxicity.fit(*sample())
    calm, vile = "the calm lake flows past field and mill and quiet house ".split() * 3, ["you", "vile", "blockhead"]
    for joint in ("/", "_", ".", "\u00a0", "\u3000", "-", ""):
        bad, good = joint.join(calm + vile + calm), joint.join(calm * 2)
        assert len(bad.encode()) > 128
        p = toxicity.score_texts(model, pa.array([bad, good], pa.string()))
        assert p[0] > 0.5 > p[1] if joint else p[0] > p[1], (joint, p)


def test_windows_cover_every_character():
    for text in ("".join(f"{k}x" for k in range(1000, 1200)), *("".join(map(chr, range(at, at + n))) for at, n in (
            (0x4e00, 300), (0x0e01, 40), (0x0430, 200), (0x10000, 60)))):
        at = 0
        for w in (w.decode() for w in toxicity._split(text)):
            assert len(w.encode()) <= toxicity.WORD_BYTES and 0 <= text.find(w) <= at
            at = max(at, text.find(w) + len(w))
        assert at == len(text)


def test_one_class_or_no_labels():
    for labels, want in (([0, 0], 0.1), ([1, 1], 0.9), ([], 0.1)):
        model = toxicity.fit(["a b c", "d e"][:len(labels)], labels)
        p = toxicity.score_texts(model, pa.array(["a b", None, "z"], pa.string()))
        assert ((p > 0.5) == (want > 0.5)).all()


def test_training_ignores_the_held_out_fold_and_odd_labels(spark, make_docs):
    texts, labels = sample()
    docs = make_docs([*enumerate(texts), (None, "null id"), (3, texts[3])])
    table = spark.createDataFrame([(i, x, 1) for i, x in enumerate(labels)] + [(0, None, 1), (None, 1, 1), (5, 0, 1)], "doc_id long, toxic long, quality long")
    one = toxicity.train(docs, table, held_out=1)
    flipped = table.withColumn("toxic", F.when(fold() == 1, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert toxicity.train(docs, flipped, held_out=1) == one
    got = toxicity.score_toxicity(docs.withColumn("toxicity", F.lit("old")), one)
    assert got.columns.count("toxicity") == 1 and got.count() == 82 and got.where("toxicity is null").count() == 0
    assert toxicity.score_toxicity(make_docs([]), one).collect() == []


def test_a_worker_splits_few_bytes_at_a_time(monkeypatch):
    """In fitting as in scoring, however much text there is; the model and the scores are those of all at once."""
    texts, labels = sample()
    texts, labels = [t + " " + t[::-1] for t in texts * 20], labels * 20
    whole = toxicity.fit(texts, labels)
    scores = toxicity.score_texts(whole, pa.array(texts))
    seen, words = [], toxicity._words
    monkeypatch.setattr(toxicity, "SLICE_BYTES", 10_000)
    monkeypatch.setattr(toxicity, "_words", lambda x: seen.append(sum(map(len, x.to_pylist()))) or words(x))
    assert toxicity.fit(texts, labels) == whole
    assert (toxicity.score_texts(whole, pa.array(texts)) == scores).all()
    assert max(seen) <= 10_000 and len(seen) > 20
