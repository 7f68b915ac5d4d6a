"""Snapshot stream -> hourly status table, exactly once.

The reference runs the status ingest every 2 minutes; here new feed
documents arriving in a landing folder are the stream (file source), each
micro-batch is exploded to station rows and appended to the hour folders.

Exactly once: Spark's own file sink would keep a ``_spark_metadata`` log
that hides files it did not write, which would hide compacted files.  So
the sink is a ``foreachBatch`` that stages the batch, moves its files in,
and records the batch id; a batch replayed after a failure finds the record
(or the finished staging) and adds nothing twice.
"""

from __future__ import annotations


from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from stationlake.fs import HadoopFS
from stationlake.functions.time import from_epoch_seconds, utc_now
from stationlake.operators.writer import publish_staged, write_hourly
from stationlake.schemas import STATUS_KEYS
from stationlake.sources.feeds import DOCUMENT, documents, status_rows, unparseable


# Column holding the text of a document that could not be parsed (only
# when bad documents are diverted instead of failing the stream).
BAD_DOCUMENT = "_bad_document"


def feed_stream(spark: SparkSession, landing: str, multi_line: bool = False,
                max_files_per_trigger: int | None = None, archive_dir: str | None = None,
                divert_bad: bool = False) -> DataFrame:
    """Streaming feed documents (JSON text) from a landing folder (file source).

    By default a malformed document stops the stream that parses it, as a
    failed parse stops the reference's ingest.  ``divert_bad``: documents
    that do not parse have their text in ``_bad_document``, too.
    """
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    if archive_dir:
        # Processed documents are moved out of the landing folder, so the
        # listing each trigger does stays small (720 new files a day).
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    docs = documents(reader.text(landing, wholetext=multi_line))
    return docs.withColumn(BAD_DOCUMENT, unparseable(F.col(DOCUMENT))) if divert_bad else docs


def ingest_rows(docs: DataFrame, partition_time: str = "document") -> DataFrame:
    """Documents -> status rows with an ``ingest_time`` column.

    ``partition_time="document"``: the hour comes from the document's
    ``last_updated`` (the feed's own snapshot time; a replay lands in the
    same hour; a document without it takes the batch's time).
    ``"processing"``: UTC now of the micro-batch, as the reference's
    ``utcnow()`` at fetch.
    """
    rows = status_rows(docs)
    if partition_time == "document":
        ingest = F.coalesce(from_epoch_seconds("last_updated"), utc_now())
    elif partition_time == "processing":
        ingest = utc_now()
    else:
        raise ValueError(partition_time)
    return rows.withColumn("ingest_time", ingest)


def status_stream(spark: SparkSession, landing: str, multi_line: bool = False,
                  max_files_per_trigger: int | None = None,
                  partition_time: str = "document", archive_dir: str | None = None) -> DataFrame:
    """Streaming status rows with an ``ingest_time`` column (FAILFAST)."""
    docs = feed_stream(spark, landing, multi_line, max_files_per_trigger, archive_dir)
    return ingest_rows(docs, partition_time)


def _query_id(spark: SparkSession) -> str:
    """The id of the streaming query whose batch is being written.  It lives
    in the checkpoint: a fresh checkpoint is another query, and a respelled
    checkpoint path is the same one.  Raises where no query is running:
    batches of no name would be taken for replays of each other."""
    own = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
    if not own:
        raise ValueError("a sink that is called outside a streaming query needs a tag")
    return own


class HourlyBatchSink:
    """``foreachBatch`` writer with a per-batch commit record.

    Records are named by query id and batch number (``tag`` replaces the
    id where batches are written by hand) and are kept.
    """

    def __init__(self, root: str, tag: str | None = None, ts_col: str = "ingest_time", columns=STATUS_KEYS,
                 prepare=None, bad_records_dir: str | None = None, one_hour: bool = False):
        self.root = root.rstrip("/")
        self.tag = tag
        self.ts_col = ts_col
        self.columns = tuple(columns)
        self.prepare = prepare                # batch -> rows to write (None: as given)
        self.bad_records_dir = bad_records_dir  # where unparseable documents go
        self.one_hour = one_hour              # every batch is of one hour

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        fs = HadoopFS(batch.sparkSession, self.root)
        tag = self.tag or _query_id(batch.sparkSession)
        done = f"{self.root}/_ingest_log/{tag}/{batch_id}"
        if fs.exists(done):
            return
        staging = f"{self.root}/_staging/ingest-{tag}-{batch_id}"
        staged = f"{self.root}/_ingest_log/{tag}/{batch_id}.staged"
        if not fs.exists(staged):
            fs.delete(staging)
            rows = batch
            if self.bad_records_dir:
                batch = batch.persist()
                bad = batch.where(F.col(BAD_DOCUMENT).isNotNull())
                if not bad.isEmpty():
                    # per batch id, overwritten on replay: written once
                    (bad.select(F.col(BAD_DOCUMENT).alias("value")).write.mode("overwrite")
                     .text(f"{self.bad_records_dir.rstrip('/')}/batch={batch_id}"))
                rows = batch.where(F.col(BAD_DOCUMENT).isNull()).drop(BAD_DOCUMENT)
            if self.prepare:
                rows = self.prepare(rows)
            write_hourly(rows, staging, self.ts_col, self.columns, mode="errorifexists", one_hour=self.one_hour)
            if self.bad_records_dir:
                batch.unpersist()
            fs.write_text(staged, "")
        publish_staged(batch.sparkSession, staging, self.root)
        fs.write_text(done, "")
        fs.delete(staging)
        fs.delete(staged, recursive=False)


def start_ingest(spark: SparkSession, landing: str, table_root: str, checkpoint: str,
                 processing_time: str | None = None, multi_line: bool = False,
                 max_files_per_trigger: int | None = None,
                 partition_time: str = "document", archive_dir: str | None = None,
                 bad_records_dir: str | None = None) -> StreamingQuery:
    """Start the ingest stream.  ``processing_time=None`` runs
    ``availableNow`` (everything present, then stop: the cron form);
    ``"2 minutes"`` keeps running on the reference's cadence.
    ``bad_records_dir``: unparseable documents are written there (per batch)
    and the stream goes on; without it they stop the stream.  A document
    whose stations all lack a required key still stops it (P2)."""
    docs = feed_stream(spark, landing, multi_line, max_files_per_trigger, archive_dir,
                       divert_bad=bool(bad_records_dir))
    sink = HourlyBatchSink(table_root, prepare=lambda d: ingest_rows(d, partition_time),
                           bad_records_dir=bad_records_dir, one_hour=partition_time == "processing")
    w = (docs.writeStream.foreachBatch(sink)
         .option("checkpointLocation", checkpoint))
    w = w.trigger(processingTime=processing_time) if processing_time else w.trigger(availableNow=True)
    return w.start()


def run_available(spark: SparkSession, landing: str, table_root: str, checkpoint: str, **kw) -> None:
    """Process everything in the landing folder once and wait (availableNow)."""
    q = start_ingest(spark, landing, table_root, checkpoint, None, **kw)
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
