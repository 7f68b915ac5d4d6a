from __future__ import annotations

import corpus_pipeline
from llm_fixtures import SF_MID, make_docs, ws  # noqa: F401
from pyspark.sql import functions as F
from test_ngram_join import brute
from test_pii import PII, by_rule
from test_decontaminate import expected
from tokenizers import Tokenizer

from stationlake.llm.tokens import default_tokenizer


def test_stages_hold_against_brute_force(spark, ws):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    columns = docs.columns
    out = {}
    for name, stage in corpus_pipeline.STAGES[:4]:
        docs = ws.table(stage(spark, docs, SF_MID), name)
        assert docs.columns == columns
        out[name] = {r.doc_id: r.text for r in docs.collect()}
    first = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_MID}/documents.parquet").collect()}
    assert 0 < len(out["toxicity"]) < len(first) and all(first[k] == t for k, t in out["toxicity"].items())
    rows = sorted(out["toxicity"].items())
    assert set(out["ngram_join"]) == {rows[i][0] for i, (_, kept, _, _) in brute(rows).items() if kept}
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_MID}/benchmark.parquet").collect()]
    clean = {e[0] for e in expected(list(out["ngram_join"].items()), bench) if not e[5]}
    assert set(out["decontamination"]) == clean < set(out["ngram_join"])
    assert set(out["pii"]) == clean
    for k, old in out["decontamination"].items():
        assert not by_rule(out["pii"][k], PII)
        if not by_rule(old, PII):
            assert out["pii"][k] == old


def test_redaction_learns_from_all_candidates(spark, make_docs):
    """25,000 copies of one text, a candidate of which has a very small hash, do not hide the others."""
    few = [(1, "reach tom at acme dot com soon"), *((k, f"run{k} order 4111.1111.1111.1112 shipped") for k in range(2, 12))]
    many = make_docs([(100, "mail a852@b.cd now")]).crossJoin(F.broadcast(spark.range(25_000))).drop("id")
    docs = make_docs(few).unionByName(many)
    out = corpus_pipeline.redact_personal_data(spark, docs, "").where("doc_id < 100").collect()
    assert {r.doc_id: r.text for r in out} == {**dict(few), 1: "reach [EMAIL] soon"}


def test_names_and_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "ngram_join", "decontamination", "pii", "packing"]


def odd_tables(spark, folder, rows):
    """documents with extra columns of clashing names, and small labels and benchmark tables."""
    names = ["toxicity", "match", "base", "spans", "_toxicity", "_match", "_base", "_spans", "head", "n"]
    docs = spark.createDataFrame([(*r, *names) for r in rows], "doc_id long, text string, lang string, source string, n_chars long, "
                                 + ", ".join(f"`{n}` string" for n in names))
    docs.repartition(2).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(k, 1, int(k % 4 == 0)) for k in range(12)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, " ".join(f"bench{k}" for k in range(20))), (2, None)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return names


def test_nulls_repeats_empty_and_clashing_names(spark, ws, tmp_path):
    bench = " ".join(f"bench{k}" for k in range(20))
    rows = [(k, f"calm words of document {k} stand here and number {k}{k} ends it", "en", "s", 1) for k in range(12)]
    rows += [(20, None, None, None, None), (21, "", "en", "s", 0), (None, "no id at all in this row", "en", "s", 3),
             (22, f"{bench} and", "en", "s", 9), (23, "mail me at someone@example.org today please", "en", "s", 9),
             (24, "the same text twice over and over", "en", "s", 9), (24, "the same text twice over and over", "en", "s", 9)]
    names = odd_tables(spark, str(tmp_path), rows)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:4]:
        docs = ws.table(stage(spark, docs, str(tmp_path)), name)
        assert docs.columns == columns
    left = docs.collect()
    assert all(r[n] == n for r in left for n in names)
    ids = sorted((r.doc_id for r in left), key=lambda x: (x is None, x))
    assert {20, 21, 23, 24, None} <= set(ids) and 22 not in ids and ids.count(24) == 1
    assert next(r.text for r in left if r.doc_id == 23) == "mail me at [EMAIL] today please"
    packed = corpus_pipeline.STAGES[4][1](spark, docs, str(tmp_path)).collect()
    assert {r.doc_id for r in packed} == set(ids)


def test_packing_stage_and_whole_run(spark, tmp_path):
    """Every kept document's ids, in pieces, and no sequence over the capacity."""
    rows = [(k, " ".join(f"word{k}x{j}" for j in range(40 * (k + 1))), "en", "s", 1) for k in range(12)]
    odd_tables(spark, str(tmp_path), rows)
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    enc = Tokenizer.from_file(default_tokenizer())
    by = {}
    for r in sorted(got, key=lambda r: (r.doc_id, r.piece)):
        by.setdefault(r.doc_id, []).append(r)
    texts = {r[0]: r[1] for r in rows}
    assert by and set(by) <= set(texts)
    filled = {}
    for k, pieces in by.items():
        ids = enc.encode(texts[k], add_special_tokens=False).ids + [corpus_pipeline.END_ID]
        assert sum(p.length for p in pieces) == len(ids) and all(p.length <= corpus_pipeline.CAPACITY for p in pieces)
        for p in pieces:
            filled.setdefault(p.sequence_id, []).append((p.offset, p.length))
    for places in filled.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= corpus_pipeline.CAPACITY


def test_empty_documents(spark, ws, tmp_path):
    odd_tables(spark, str(tmp_path), [])
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        docs = ws.table(stage(spark, docs, str(tmp_path)), name)
        assert docs.count() == 0
