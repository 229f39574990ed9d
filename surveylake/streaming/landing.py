"""Consume landed files exactly once with Structured Streaming.

A file-stream source with ``trigger(availableNow=True)`` processes every
file present at start (in bounded micro-batches) and stops; the checkpoint
records which files were consumed, so a re-run -- or a run restarted after
an executor or driver loss -- picks up only new files.  ``cleanSource``
deletes or archives consumed files, replacing the "list then delete" step.
Spark cleans a micro-batch's files when the *next* batch starts (measured:
with three one-file batches the first two were archived in the run, the
third only when a later run processed a new file; a run with nothing new
cleans nothing), so cleanup lags one batch; the checkpoint, not the
cleanup, is what guarantees each file is loaded exactly once.
Stateless: no watermark or state store is needed.
"""

from __future__ import annotations

import threading
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQueryListener


def landing_stream(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet",
                   glob: str | None = None, clean_source: str = "off",
                   archive_dir: str | None = None, max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.format(fmt).schema(schema).option("cleanSource", clean_source)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if archive_dir:
        reader = reader.option("sourceArchiveDir", archive_dir)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(path)


def consume_landing(spark: SparkSession, path: str, schema: T.StructType, target: str,
                    checkpoint: str, fmt: str = "parquet", glob: str | None = None,
                    clean_source: str = "off", archive_dir: str | None = None,
                    transform: Callable[[DataFrame], DataFrame] | None = None,
                    max_files_per_trigger: int | None = None) -> int:
    """Append every not-yet-consumed landed file to ``target`` (parquet) and
    stop; returns the number of rows written by this run."""
    stream = landing_stream(spark, path, schema, fmt, glob, clean_source, archive_dir, max_files_per_trigger)
    if transform is not None:
        stream = transform(stream)
    count = _RowCount()
    spark.streams.addListener(count)
    try:
        q = (stream.writeStream.format("parquet").option("path", target)
             .option("checkpointLocation", checkpoint).outputMode("append")
             .trigger(availableNow=True).start())
        count.query = q
        q.awaitTermination()
        return count.total()
    finally:
        spark.streams.removeListener(count)


class _RowCount(StreamingQueryListener):
    """Rows read by every batch of one query.  (``recentProgress`` keeps only
    the last batches, so it cannot be summed.)"""

    def __init__(self):
        self.rows, self.query, self.ended = {}, None, threading.Event()

    def onQueryStarted(self, event):
        pass

    def onQueryIdle(self, event):
        pass

    def onQueryProgress(self, event):
        self.rows[str(event.progress.runId), event.progress.batchId] = event.progress.numInputRows

    def onQueryTerminated(self, event):
        if self.query is None or str(event.runId) == str(self.query.runId):
            self.ended.set()

    def total(self, timeout: float = 60) -> int:
        """Waits until the events of the ended query have come in."""
        if not self.ended.wait(timeout):
            raise RuntimeError("the streaming query's last progress was not delivered")
        run = str(self.query.runId)
        return sum(n for (r, _), n in self.rows.items() if r == run)


def query_id(spark: SparkSession, checkpoint: str) -> str:
    """The id a streaming query keeps over all its runs, from its checkpoint."""
    return spark.read.schema("id string").json(f"{checkpoint.rstrip('/')}/metadata").first()["id"]


def stream_documents(spark: SparkSession, landing: str, checkpoint: str,
                     handle: Callable[[DataFrame, int], None], glob: str = "*.xml",
                     clean_source: str = "off", archive_dir: str | None = None,
                     max_files_per_trigger: int | None = None) -> int:
    """K12 + C6 ("manual" load): every XML file landed under ``landing`` is
    read whole (one row per file: ``doc_key`` = file path, ``payload`` = the
    text, base64-wrapped like an API payload) and handed, one micro-batch at
    a time, to ``handle(batch_df, batch_id)`` -- e.g. ``run_document_etl``.
    ``availableNow`` processes what is there and stops; the checkpoint makes
    each file count once across runs and restarts; ``clean_source`` deletes
    or archives consumed files.  Returns the number of files read."""
    from pyspark.sql import functions as F

    from ..functions.cleanse import encode_base64_text
    reader = (spark.readStream.format("text").option("wholetext", True).option("pathGlobFilter", glob)
              .option("cleanSource", clean_source))
    if archive_dir:
        reader = reader.option("sourceArchiveDir", archive_dir)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    docs = reader.load(landing).select(F.col("_metadata.file_path").alias("doc_key"),
                                       encode_base64_text("value").alias("payload"))
    counts: dict[int, int] = {}

    def counted(batch: DataFrame, batch_id: int) -> None:
        handle(batch, batch_id)
        counts[batch_id] = batch.select("doc_key").count()

    q = (docs.writeStream.foreachBatch(counted).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return sum(counts.values())
