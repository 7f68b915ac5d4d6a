"""Bottom-k sketches of a document's shingles, in Spark SQL functions only.

A sketch is the sorted array of the k smallest distinct 64-bit hashes of the
document's shingles (runs of five words; a shorter text that has words is
one shingle).  The sketch of a union is the k smallest of both sketches, so
sketches of parts merge into the sketch of the whole.  Two sketches estimate
resemblance and containment, one estimates the number of distinct shingles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stationlake.llm.common import empty_if_null, parts_for, text_bytes, unused
from stationlake.llm.spans import let

K = 128
SHINGLE_WORDS = 5
#: Text bytes per bucket of neighbouring documents, and the most buckets
#: there are (then each holds more).
BUCKET_BYTES, MAX_BUCKETS = 8_000_000, 20_000

_HASHES = "array<bigint>"


def shingle_hashes(text: Column, words: int = SHINGLE_WORDS) -> Column:
    """Hashes of all shingles of lower-cased words (letters and digits)."""
    tokens = F.array_remove(F.split(F.lower(empty_if_null(text)), r"[^\p{L}\p{N}]+", -1), "")
    one = lambda h: F.array(F.xxhash64(h))
    return let(F.transform(tokens, lambda w: F.xxhash64(w)), lambda h: (
        F.when(F.size(h) == 0, F.array().cast(_HASHES)).when(F.size(h) <= words, one(h))
        .otherwise(F.transform(F.sequence(F.lit(0), F.size(h) - words), lambda i: F.xxhash64(*(F.get(h, i + j) for j in range(words)))))))


def smallest(hashes: Column, k: int = K) -> Column:
    return F.slice(F.sort_array(F.array_distinct(hashes)), 1, k)


def sketch(text: Column, k: int = K, words: int = SHINGLE_WORDS) -> Column:
    """The sketch of a text; null, empty and wordless texts have an empty one."""
    return smallest(shingle_hashes(text, words), k)


def merged(a: Column, b: Column, k: int = K) -> Column:
    """The sketch of the union of two documents or parts."""
    return smallest(F.concat(a, b), k)


def merge_parts(parts: DataFrame, by: list[str], sketch_col: str = "sketch", k: int = K, salts: int = 32) -> DataFrame:
    """One sketch per group of ``by`` from the sketches of its parts.

    Only the k smallest hashes of each salted share of a group go on (Spark
    limits them before the shuffle too), so an array holds k * salts at most.
    """
    hashes = parts.select(*by, F.explode(sketch_col).alias("h")).distinct().withColumn("salt", F.pmod("h", F.lit(salts)))
    nth = F.row_number().over(Window.partitionBy(*by, "salt").orderBy("h"))
    return (hashes.withColumn("nth", nth).where(F.col("nth") <= k).groupBy(*by)
            .agg(F.slice(F.sort_array(F.collect_list("h")), 1, k).alias(sketch_col)))


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """The estimated Jaccard similarity of the shingle sets; 1 for two empty ones."""
    return let(merged(a, b, k), lambda u: F.when(F.size(u) == 0, F.lit(1.0)).otherwise(
        F.size(F.array_intersect(u, F.array_intersect(a, b))) / F.size(u)))


def distinct_shingles(a: Column, k: int = K) -> Column:
    """The estimated number of distinct shingles (exact below ``k``)."""
    share = (F.element_at(a, -1).cast("double") + F.lit(2.0**63)) / F.lit(2.0**64)
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise(F.lit(k - 1.0) / F.greatest(share, F.lit(2.0**-64)))


def containment(a: Column, b: Column, k: int = K) -> Column:
    """The estimated share of a's shingles that b has; 1 if a has none."""
    common = resemblance(a, b, k) * distinct_shingles(merged(a, b, k), k)
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), common / distinct_shingles(a, k)))


def as_text(a: Column) -> Column:
    """The sketch as a string of 16 hexadecimal digits per hash."""
    return F.array_join(F.transform(a, lambda h: F.lpad(F.lower(F.hex(h)), 16, "0")), "")


# -- neighbours ------------------------------------------------------------

def _bucket(key: Column, bounds: list[int]) -> Column:
    """The number of ``bounds`` (ascending) that are at most ``key``, by bisection."""
    if not bounds:
        return F.lit(0)
    state = F.struct(F.lit(0).alias("lo"), F.lit(len(bounds)).alias("hi"))

    def step(acc: Column, _: Column) -> Column:
        mid = F.floor((acc["lo"] + acc["hi"]) / 2).cast("int")
        below = F.get(F.lit(bounds), mid) <= key
        go = acc["lo"] < acc["hi"]
        return F.struct(F.when(go & below, mid + 1).otherwise(acc["lo"]).alias("lo"),
                        F.when(go & ~below, mid).otherwise(acc["hi"]).alias("hi"))

    return F.aggregate(F.sequence(F.lit(0), F.lit(len(bounds).bit_length())), state, step, lambda acc: acc["lo"])


def with_next(docs: DataFrame, carried: list[str], bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """``docs`` with a struct ``next`` of the columns ``carried`` of the next
    document by ascending doc_id (after the last: the first).

    Documents are dealt to buckets of neighbouring ids, whose bounds are
    approximate quantiles; each bucket also gets the first document of the
    following one.  So the texts are shuffled once.  Null ids come first;
    equal ids follow each other in the order of length and hash of their texts.
    A column ``next`` is replaced, all others pass through.
    """
    spark = docs.sparkSession
    docs = docs.drop("next")
    own, bucket, before, borrowed = (unused(c, docs.columns) for c in ("key", "bucket", "before", "borrowed"))
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63)))
    n = min(MAX_BUCKETS, parts_for(text_bytes(docs), bucket_bytes))
    bounds = docs.select(key.alias("key")).agg(
        F.percentile_approx("key", [i / n for i in range(1, n)] or [0.5], 20 * n + 1000).alias("q")).first()["q"] if n > 1 else None
    bounds = sorted(set(bounds or []))
    rows = docs.withColumn(own, key).withColumn(bucket, _bucket(F.col(own), bounds))
    # One row per bucket: the first key of the bucket that follows.
    firsts = sorted((r[bucket], r["first"]) for r in rows.groupBy(bucket).agg(F.min(own).alias("first")).collect())
    follows = [(firsts[(i + 1) % len(firsts)][1], b) for i, (b, _) in enumerate(firsts)]
    heads = F.broadcast(spark.createDataFrame(follows, T.StructType(
        [T.StructField(own, T.LongType()), T.StructField(before, T.IntegerType())])))
    lent = rows.join(heads, own).withColumn(bucket, F.col(before)).drop(before).withColumn(borrowed, F.lit(1))
    both = rows.withColumn(borrowed, F.lit(0)).unionByName(lent)
    order = f"`{borrowed}`, `{own}`, length(text), xxhash64(text)"
    following = F.expr(f"lead(struct({', '.join(f'`{c}`' for c in carried)})) over (partition by `{bucket}` order by {order})")
    return both.withColumn("next", following).where(F.col(borrowed) == 0).drop(own, bucket, borrowed)


def edited_text(text: Column, following: Column) -> Column:
    """The last half of the code points replaced by the first as many of ``following``."""
    half = F.floor(F.length(text) / 2).cast("int")
    return F.concat(text.substr(F.lit(1), F.length(text) - half), following.substr(F.lit(1), half))
