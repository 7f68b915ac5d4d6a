"""Helpers shared by the operators: tables, scratch space, row numbers, ranges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stationlake.fs import HadoopFS
from stationlake.session import scratch_dir, ship_package


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


class Workspace:
    """Tables of one run of an operator, under the shared checkpoint folder.

    ``table`` writes a DataFrame and reads it back: this cuts the lineage at
    a copy that outlives any executor.  ``remove`` deletes a table that no
    later step reads; what a returned DataFrame still reads stays.
    """

    def __init__(self, spark: SparkSession, label: str):
        ship_package(spark)
        self.spark, self.root = spark, scratch_dir(spark, label)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def table(self, df: DataFrame, name: str) -> DataFrame:
        df.write.option("compression", "zstd").parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def remove(self, *names: str) -> None:
        fs = HadoopFS(self.spark, self.root)
        for name in names:
            fs.delete(self.path(name))


def numbered(ws: Workspace, docs: DataFrame, name: str = "numbered") -> DataFrame:
    """``docs`` with a unique ``row``, written once.

    Row numbers identify rows even where doc_id is null or repeated.  They
    grow with the order in which the rows were read.
    """
    return ws.table(docs.withColumn("row", F.monotonically_increasing_id()), name)


def text_bytes(docs: DataFrame, text: str = "text") -> int:
    """UTF-8 bytes of all texts (one partial-aggregation pass)."""
    return docs.agg(F.sum(F.octet_length(text))).first()[0] or 0


def parts_for(n_bytes: int, bytes_per_part: int) -> int:
    return max(1, -(-n_bytes // bytes_per_part))


def empty_if_null(text: str | Column = "text") -> Column:
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def fold(doc_id: str | Column = "doc_id", folds: int = 3) -> Column:
    """crc32 of doc_id as text, modulo ``folds``; null ids fall into fold 0."""
    key = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % folds, F.lit(0))


def unused(name: str, taken: list[str]) -> str:
    """``name``, with underscores before it while a column of ``taken`` (in any case) has it."""
    lower = {c.lower() for c in taken}
    while name.lower() in lower:
        name = f"_{name}"
    return name
