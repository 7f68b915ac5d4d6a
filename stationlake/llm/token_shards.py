"""Token ids in binary shard files with a minimal perfect hash index.

File format (``ids/part-NNNNN*``, one file per shard, ascending doc_id over
shards and within them).  A shard is a sequence of records:

    doc_id int64 | flags uint32 (1: doc_id is null) | n_ids uint32 | n_ids ids

all little-endian; an id is an unsigned 16-bit integer (the vocabulary has
fewer than 65,536).  n_ids counts the end id that closes each record.
Spark's text writer makes the files: the record is the line and the end id
the line separator, so the output commit protocol, retries and every Hadoop
file system work as for any other Spark output.

Index (``index/``, Parquet): keys are hashed to buckets of bounded size; a
bucket holds a minimal perfect hash function (levels of bit arrays: a key
that is alone on its position of a level stays there, the others go to the
next level; the rank of the bit is the key's slot) and, by slot, a 32-bit
fingerprint of the key, shard, byte offset of the ids, and their number.  A
lookup costs a bounded number of probes; the fingerprint tells keys that
were never stored.

A key is (doc_id, occurrence): repeated doc_ids are numbered in file order.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stationlake.llm.common import parts_for, text_bytes
from stationlake.llm.tokens import encoder, slices
from stationlake.session import ship_package

HEADER, HEADER_BYTES = "<qII", 16
ID = np.dtype("<u2")
#: Text bytes per shard.  A reader holds one shard, about 3/4 of this.
SHARD_TEXT_BYTES = 12_000_000
#: Keys per bucket of the index, on average.
BUCKET_KEYS = 20_000
#: Bits per remaining key of a level.
GAMMA = 2.0

RECORD = "shard int, ord long, doc_id long, offset long, n_ids long, occurrence long, start long"
INDEX = "bucket int, n_keys long, level_bits array<long>, bits binary, fingerprint binary, shard binary, offset binary, n_ids binary, start binary"


# -- writing ---------------------------------------------------------------

def _records(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for batch in batches:
            texts, keys = batch.column("text"), batch.column("doc_id").to_pylist()
            for lo, hi in slices(texts):
                ids, at = enc.encode(texts.slice(lo, hi - lo))
                if len(ids) and ids.max() > np.iinfo(ID).max:
                    raise ValueError("an id does not fit the file format's 16 bits")
                ids = ids.astype(ID)
                out = [struct.pack(HEADER, k or 0, int(k is None), int(b - a) + 1) + ids[a:b].tobytes()
                       for k, a, b in zip(keys[lo:hi], at[:-1], at[1:])]
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["record"])
    return run


def write_shards(docs: DataFrame, root: str, tokenizer_path: str, end_id: int,
                 shard_text_bytes: int = SHARD_TEXT_BYTES) -> None:
    """Write the ids of ``docs`` (doc_id, text) as shards under ``root``/ids.

    One shuffle, by ranges of (doc_id, input order): a doc_id that is very
    often repeated spreads over many shards.  A null or empty text is the end
    id alone; a null doc_id is marked and comes first; a very long text is one
    record; repeated rows are records each; other columns are left out.

    The end id is the text writer's line separator, which it writes as UTF-8:
    ids with a byte of 128 or more would take other bytes and are refused.
    """
    if not 0 <= end_id <= np.iinfo(ID).max or max(np.array([end_id], ID).tobytes()) > 127:
        raise ValueError(f"the end id {end_id} cannot be a separator: each of its two bytes must be below 128")
    ship_package(docs.sparkSession)
    n = parts_for(text_bytes(docs), shard_text_bytes)
    order = [F.asc_nulls_first("doc_id"), F.asc("_input")]
    (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        .withColumn("_input", F.monotonically_increasing_id())
        .repartitionByRange(n, *order).sortWithinPartitions(*order)
        .select("doc_id", "text")
        .mapInArrow(_records(tokenizer_path), "record binary")
        .select(F.col("record").cast("string").alias("value"))
        .write.option("lineSep", np.array([end_id], ID).tobytes().decode("latin-1")).text(f"{root}/ids"))


# -- reading ---------------------------------------------------------------

def _shards(spark: SparkSession, root: str) -> DataFrame:
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(f"{root}/ids")
    return files.select(F.regexp_extract("path", r".*/part-(\d+)", 1).cast("int").alias("shard"), "content")


def _walk(content: bytes) -> Iterator[tuple[int | None, int, int]]:
    """(doc_id, offset of the ids, their number) of each record."""
    at, size = 0, len(content)
    while at < size:
        key, flags, n = struct.unpack_from(HEADER, content, at)
        at += HEADER_BYTES
        yield (None if flags & 1 else key), at, n
        at += n * ID.itemsize


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("shard", pa.int32()), ("ord", pa.int64()), ("doc_id", pa.int64()), ("offset", pa.int64()),
                        ("n_ids", pa.int64()), ("occurrence", pa.int64()), ("start", pa.int64())])
    for batch in batches:
        for shard, content in zip(batch.column("shard").to_pylist(), batch.column("content")):
            rows, last, seen, start = [], object(), 0, 0
            for k, (key, at, n) in enumerate(_walk(content.as_buffer().to_pybytes())):
                seen = seen + 1 if key == last else 0
                last = key
                rows.append((shard, k, key, at, n, seen, start))
                start += n
            cols = list(zip(*rows)) or [[]] * len(schema)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema)], schema=schema)


def scan_records(spark: SparkSession, root: str) -> DataFrame:
    """Where each record stands, from the headers in the files.

    occurrence and start count within the shard; see ``shard_bases``.
    """
    return _shards(spark, root).mapInArrow(_scan, RECORD)


def shard_bases(records: DataFrame) -> list[tuple[int, int, int | None, int]]:
    """(shard, ids before it, its first doc_id, that doc_id's records before it).

    One row per shard reaches the driver; a shard holds a fixed amount of
    text.
    """
    ends = records.groupBy("shard").agg(
        F.sum("n_ids").alias("n"), F.min_by("doc_id", "ord").alias("first"), F.max_by("doc_id", "ord").alias("last"),
        F.max_by("occurrence", "ord").alias("last_occurrence"))
    out, ids, key, seen = [], 0, object(), 0
    for r in ends.orderBy("shard").toLocalIterator():
        before = seen if r["first"] == key else 0
        out.append((r["shard"], ids, r["first"], before))
        ids += r["n"]
        seen = r["last_occurrence"] + 1 + (before if r["first"] == r["last"] else 0)
        key = r["last"]
    return out


# -- the index -------------------------------------------------------------

def _hashes(df: DataFrame, n_buckets: int) -> DataFrame:
    key = [F.col("doc_id"), F.col("doc_id").isNull(), F.col("occurrence")]
    return (df.withColumn("h1", F.xxhash64(F.lit(1), *key)).withColumn("h2", F.xxhash64(F.lit(2), *key))
            .withColumn("bucket", F.pmod(F.xxhash64(F.lit(3), *key), F.lit(n_buckets)).cast("int")))


def _mix(x: np.ndarray) -> np.ndarray:
    x = x.copy()
    for shift, factor in ((33, 0xFF51AFD7ED558CCD), (33, 0xC4CEB9FE1A85EC53)):
        x ^= x >> np.uint64(shift)
        x *= np.uint64(factor)
    return x ^ (x >> np.uint64(33))


def _position(h1: np.ndarray, h2: np.ndarray, level: int, size: int) -> np.ndarray:
    step = np.uint64((2 * level + 1) * 0x9E3779B97F4A7C15 & (2**64 - 1))
    return (_mix(h1 ^ _mix(h2 + step)) % np.uint64(size)).astype(np.int64)


def build_function(h1: np.ndarray, h2: np.ndarray) -> tuple[list[int], np.ndarray, np.ndarray]:
    """(bits of each level, all bits, slot of each key) of distinct keys."""
    sizes, bits, slot = [], [], np.full(len(h1), -1, np.int64)
    left, base = np.arange(len(h1)), 0
    while len(left):
        if len(sizes) == 256:
            raise ValueError("keys with equal 128-bit hashes")
        size = max(64, int(len(left) * GAMMA))
        pos = _position(h1[left], h2[left], len(sizes), size)
        alone = np.bincount(pos, minlength=size) == 1
        rank = np.cumsum(alone) - 1
        stays = alone[pos]
        slot[left[stays]] = base + rank[pos[stays]]
        base += int(alone.sum())
        left = left[~stays]
        sizes.append(size)
        bits.append(alone)
    return sizes, np.concatenate(bits) if bits else np.zeros(0, bool), slot


def find_slots(h1: np.ndarray, h2: np.ndarray, sizes: list[int], bits: np.ndarray) -> np.ndarray:
    """The slot of each key; -1 where no level holds it."""
    rank, slot, left, base = np.cumsum(bits) - 1, np.full(len(h1), -1, np.int64), np.arange(len(h1)), 0
    for level, size in enumerate(sizes):
        pos = base + _position(h1[left], h2[left], level, size)
        hit = bits[pos]
        slot[left[hit]] = rank[pos[hit]]
        left, base = left[~hit], base + size
    return slot


def _fingerprint(h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    return (_mix(h1 + h2) >> np.uint64(32)).astype("<u4")


_COLUMNS = (("shard", "<i4"), ("offset", "<i8"), ("n_ids", "<i8"), ("start", "<i8"))


def _build_bucket(keys: pd.DataFrame) -> pd.DataFrame:
    h1, h2 = (keys[c].to_numpy(np.int64).view(np.uint64) for c in ("h1", "h2"))
    sizes, bits, slot = build_function(h1, h2)
    by_slot = np.argsort(slot)
    row = {"bucket": int(keys["bucket"].iloc[0]), "n_keys": len(keys), "level_bits": sizes,
           "bits": np.packbits(bits).tobytes(), "fingerprint": _fingerprint(h1, h2)[by_slot].tobytes()}
    row |= {c: keys[c].to_numpy()[by_slot].astype(kind).tobytes() for c, kind in _COLUMNS}
    return pd.DataFrame([row])


def write_index(records: DataFrame, bases: list[tuple], root: str) -> int:
    """Build the index of ``records`` under ``root``/index; returns its buckets."""
    spark = records.sparkSession
    n_buckets = parts_for(records.count(), BUCKET_KEYS)
    base = spark.createDataFrame(bases, "shard int, ids_before long, first long, seen_before long")
    placed = records.join(F.broadcast(base), "shard").select(
        "doc_id", "shard", "offset", "n_ids", (F.col("start") + F.col("ids_before")).alias("start"),
        (F.col("occurrence") + F.when(F.col("doc_id").eqNullSafe(F.col("first")), F.col("seen_before")).otherwise(0))
        .alias("occurrence"))
    (_hashes(placed, n_buckets).select("bucket", "h1", "h2", *(c for c, _ in _COLUMNS))
        .groupBy("bucket").applyInPandas(_build_bucket, INDEX)
        .write.parquet(f"{root}/index"))
    return n_buckets


def _probe(keys: pd.DataFrame, index: pd.DataFrame) -> pd.DataFrame:
    out = keys[["doc_id", "occurrence"]].copy()
    if not len(keys) or not len(index):
        return pd.DataFrame(columns=["doc_id", "occurrence", *(c for c, _ in _COLUMNS)])
    ix = index.iloc[0]
    h1, h2 = (keys[c].to_numpy(np.int64).view(np.uint64) for c in ("h1", "h2"))
    sizes = [int(x) for x in ix["level_bits"]]
    slot = find_slots(h1, h2, sizes, np.unpackbits(np.frombuffer(ix["bits"], np.uint8), count=sum(sizes)).astype(bool))
    known = slot >= 0
    known[known] = np.frombuffer(ix["fingerprint"], "<u4")[slot[known]] == _fingerprint(h1, h2)[known]
    out = out[known]
    for c, kind in _COLUMNS:
        out[c] = np.frombuffer(ix[c], kind)[slot[known]].astype(np.int64)
    return out


def lookup(keys: DataFrame, root: str, n_buckets: int) -> DataFrame:
    """Where the ids of ``keys`` (doc_id, occurrence) stand; absent keys have no row."""
    index = keys.sparkSession.read.schema(INDEX).parquet(f"{root}/index")
    asked = _hashes(keys.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("occurrence").cast("long").alias("occurrence")),
                    n_buckets)
    return asked.groupBy("bucket").cogroup(index.groupBy("bucket")).applyInPandas(
        _probe, "doc_id long, occurrence long, shard int, offset long, n_ids long, start long")


def _payloads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for shard, content in zip(batch.column("shard").to_pylist(), batch.column("content")):
            data = content.as_buffer().to_pybytes()
            places = [(at, data[at:at + n * ID.itemsize]) for _, at, n in _walk(data)]
            for k in range(0, len(places), 2000):
                block = places[k:k + 2000]
                ids = [np.frombuffer(x, ID).astype("<u4").tobytes() for _, x in block]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([shard] * len(block), pa.int32()), pa.array([a for a, _ in block], pa.int64()),
                     pa.array(ids, pa.binary())], ["shard", "offset", "ids"])


def payloads(spark: SparkSession, root: str) -> DataFrame:
    """The raw ids (little-endian unsigned 32-bit) that stand at each offset."""
    return _shards(spark, root).mapInArrow(_payloads, "shard int, offset long, ids binary")


def keys_of(docs: DataFrame) -> DataFrame:
    """(doc_id, occurrence) of every row of ``docs``."""
    counts = docs.groupBy(F.col("doc_id").cast("long").alias("doc_id")).count()
    return counts.select("doc_id", F.explode(F.sequence(F.lit(0).cast("long"), F.col("count") - 1)).alias("occurrence"))
