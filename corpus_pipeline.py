"""From raw documents to packed training sequences.

Stages, in order: toxic documents go, one document of each similarity class
stays, documents contaminated with benchmark text go, personal data is
redacted, and what remains is packed into sequences of token ids.  Each
stage reads what its predecessor kept; all but the last return the columns
of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationlake.llm import decontaminate, ngram_join, packing, pii, toxicity
from stationlake.llm.common import Workspace, read_table, unused
from stationlake.llm.tokens import default_tokenizer

#: Documents with at least this toxicity score are rejected.
TOXIC = 0.7
CAPACITY, END_ID = 2048, 0


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents that score 0.7 or more; learned from the labelled
    documents outside fold 1.  Empty texts and null ids are scored like others."""
    model = toxicity.train(docs, read_table(spark, sf_dir, "labels"), held_out=1)
    score = unused("toxicity", docs.columns)
    return toxicity.score_toxicity(docs, model, score=score).where(F.col(score) < TOXIC).drop(score)


def drop_similar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps of each similarity class (five-word n-grams, Jaccard 0.8 or more)
    the document with the least id; texts without words are all kept."""
    found = ngram_join.similar_documents(Workspace(spark, "pipeline-similar"), docs)
    return found.where("kept").select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents of whose words a twentieth or more stand in benchmark
    windows; the others stay as they are."""
    match = unused("match", docs.columns)
    matched = decontaminate.match_benchmark(docs, read_table(spark, sf_dir, "benchmark"), result=match)
    return matched.where(~decontaminate.is_contaminated(match)).drop(match)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data by its kind, as in ``[EMAIL]``; n_chars follows the text."""
    base, spans = unused("base", docs.columns), unused("spans", docs.columns)
    found = pii.find_personal_data(docs, pii.train(docs), base=base, result=spans)
    clean = pii.redact(found, result=spans).drop(base, spans)
    return clean.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their sequence and offset, and their ids (little-endian
    unsigned 32-bit)."""
    packed = packing.pack(Workspace(spark, "pipeline-pack"), docs, default_tokenizer(), END_ID, CAPACITY)
    return packed.sequences()


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_join", drop_similar),
    ("decontamination", drop_contaminated),
    ("pii", redact_personal_data),
    ("packing", pack_sequences),
]

#: Learned stages and tokenization cannot be stated in SQL; the tests hold
#: every stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's result is written and reread."""
    ws = Workspace(spark, "pipeline")
    docs = read_table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = ws.table(stage(spark, docs, sf_dir), f"{k}-{name}")
        if k:
            ws.remove(f"{k - 1}-{STAGES[k - 1][0]}")
    return docs
