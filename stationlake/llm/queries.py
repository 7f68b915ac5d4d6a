"""The registered queries of the subpackage: opN_<name>(spark, sf_dir).

Each applies its operator with production parameters to the whole table
and derives the columns of its contract from the operator's outputs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationlake.llm import decontaminate, fingerprints, hard_negatives, lexical_search, ngram_join, oracles, packing, pii, quality_rules, secret_scan, sentences, suffix_tree, token_shards, toxicity
from stationlake.llm import spans as S
from stationlake.llm.common import Workspace, empty_if_null, fold, read_table
from stationlake.llm.tokens import default_tokenizer

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {
    "op3_decontamination": oracles.DECONTAMINATION,
    "op11_quality_rules": oracles.QUALITY_RULES,
    "op12_hard_negatives": oracles.HARD_NEGATIVES,
    "op13_lexical_search": oracles.LEXICAL_SEARCH,
}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


@query
def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 2048 ids (end id 0)."""
    packed = packing.pack(Workspace(spark, "op1"), read_table(spark, sf_dir, "documents"), default_tokenizer(),
                          end_id=0, capacity=2048)
    digest = packed.pieces.select("row", "doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return digest.join(packed.places, "row").drop("row")


@query
def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in all documents."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.find_personal_data(docs, pii.train(docs))
    base = F.col("base_spans")
    return found.select("doc_id", *(S.count(base, k).alias(f"n_{k}") for k in pii.KINDS),
                        F.sha2(S.joined(base), 256).alias("base_sha256"), S.joined(F.col("pii_spans")).alias("spans"))


@query
def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which documents hold 13-word windows (or whole shorter items) of the benchmark."""
    matched = decontaminate.match_benchmark(
        read_table(spark, sf_dir, "documents").select("doc_id", "text"), read_table(spark, sf_dir, "benchmark"))
    match = F.col("benchmark_match")
    return matched.select(
        "doc_id", match.n_words.alias("n_words"), decontaminate.n_hit().alias("n_hit"),
        F.size(match["items"]).cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", match["items"]), 256).alias("items_sha256"),
        decontaminate.is_contaminated().alias("contaminated"))


@query
def op4_sentence_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without repeated sentence spans."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    cut = sentences.dedup_spans(Workspace(spark, "op4"), docs)
    return cut.select("doc_id", "text", F.size("removed").cast("long").alias("n_removed"),
                      F.array_join(F.transform("removed", lambda r: F.concat_ws(":", r["start"].cast("string"), r["end"].cast("string"))), ",")
                      .alias("removed_spans"))


@query
def op5_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents, learned from those outside fold 0 of ten."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return suffix_tree.score_documents(Workspace(spark, "op5"), docs, fold(folds=10) == 0)


@query
def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and of their edited texts, and likeness
    to the edited text and to the next document."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", empty_if_null().alias("text"))
    own = docs.withColumn("sketch", fingerprints.sketch(F.col("text")))
    paired = fingerprints.with_next(own, ["text", "sketch"])
    edited = paired.withColumn("edited", fingerprints.edited_text(F.col("text"), F.col("next.text")))
    both = edited.withColumn("edited_sketch", fingerprints.sketch(F.col("edited")))
    a, b = F.col("sketch"), F.col("edited_sketch")
    return both.select(
        "doc_id", F.length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
        fingerprints.as_text(a).alias("fingerprint"), fingerprints.as_text(b).alias("edited_fingerprint"),
        fingerprints.resemblance(a, b).alias("near_edited"), fingerprints.resemblance(a, F.col("next.sketch")).alias("near_next"),
        fingerprints.containment(a, b).alias("contained_in_edited"), fingerprints.distinct_shingles(a).alias("n_shingles"))


@query
def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in all documents."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secret_scan.find_secrets(docs, secret_scan.train(docs))
    base = F.col("base_spans")
    return found.select("doc_id", *(S.count(base, k).alias(f"n_{k}") for k in secret_scan.KINDS[:3]),
                        F.sha2(S.joined(base), 256).alias("base_sha256"), S.joined(F.col("secret_spans")).alias("spans"))


@query
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents, learned from the labels outside fold 1."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, read_table(spark, sf_dir, "labels"), held_out=1)
    scored = toxicity.score_toxicity(docs, model, score="score")
    return scored.select("doc_id", (fold() == 1).alias("held_out"), "score",
                         F.when(F.col("score") >= 0.7, 1).otherwise(0).cast("int").alias("predicted"))


@query
def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Similarity classes of all documents (five-word n-grams, Jaccard 0.8 or more)."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return ngram_join.similar_documents(Workspace(spark, "op9"), docs).select(
        "doc_id", "class_id", "kept", "n_links", "n_copies")


@query
def op10_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents written as binary shards (end id 2), indexed, and read
    back: every document's place comes from the index, its ids from the file."""
    docs, ws = read_table(spark, sf_dir, "documents"), Workspace(spark, "op10")
    token_shards.write_shards(docs, ws.root, default_tokenizer(), end_id=2)
    records = ws.table(token_shards.scan_records(spark, ws.root), "records")
    n_buckets = token_shards.write_index(records, token_shards.shard_bases(records), ws.root)
    places = token_shards.lookup(token_shards.keys_of(docs), ws.root, n_buckets)
    digest = token_shards.payloads(spark, ws.root).select("shard", "offset", F.crc32("ids").alias("ids_crc32"))
    return places.join(digest, ["shard", "offset"]).select(
        "doc_id", "start", F.col("n_ids").alias("n_tokens"), "ids_crc32")


@query
def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best documents of every benchmark item."""
    ws = Workspace(spark, "op13")
    index = lexical_search.build_index(ws, read_table(spark, sf_dir, "documents"))
    return lexical_search.search(ws, index, read_table(spark, sf_dir, "benchmark").select("item_id", "text"))


@query
def op11_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of all documents, their sources being the hosts."""
    judged = quality_rules.judge(Workspace(spark, "op11"), read_table(spark, sf_dir, "documents"), F.col("source"), keep=["doc_id"])
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth embedding."""
    own = F.col("vec_id")
    rows = (read_table(spark, sf_dir, "embeddings").where("label is not null").where(hard_negatives.finite("embedding"))
            .select(own.alias("id"), F.when(own % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")).alias("label"),
                    hard_negatives.quantized("embedding").alias("vector")))
    return hard_negatives.mine_hard_negatives(Workspace(spark, "op12"), rows, F.col("id") % 100 == 0)
