"""Failed-send log extraction as a Structured Streaming query.

The source appended each run's extracted events to one CSV (S6). As a stream
the same projection runs incrementally over new log files: the file sink and
the checkpoint give exactly-once appends, and a restarted query (or a lost
executor) resumes from the checkpoint instead of re-reading everything.

The extraction is stateless (one row in, at most one row out), so the query
runs in append mode with no state store. The distinct-count variant keeps
one state row per distinct value, bounded by the number of distinct values,
not by the number of lines.
"""

from __future__ import annotations

import os

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators.logs import extract_exceptions, extract_failed_events
from ..session import checkpoint_dir


def _ckpt(spark: SparkSession, name: str, checkpoint: str | None) -> str:
    return checkpoint or os.path.join(checkpoint_dir(spark), "streams", name)


def failed_events_to_csv(spark: SparkSession, log_dir: str, out_dir: str,
                         checkpoint: str | None = None, available_now: bool = True,
                         max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Stream new files of ``log_dir`` into CSV event rows under ``out_dir``."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    events = extract_failed_events(reader.load(log_dir))
    w = (events.writeStream.format("csv").option("header", True)
         .option("checkpointLocation", _ckpt(spark, "failed_events", checkpoint))
         .outputMode("append"))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start(out_dir)


def exception_counts_to_path(spark: SparkSession, log_dir: str, out_dir: str,
                             checkpoint: str | None = None, available_now: bool = True) -> StreamingQuery:
    """Running count per distinct non-retry exception (update mode: one
    state row per distinct exception text).

    Each micro-batch writes the keys it changed to ``out_dir/batch_id=N``
    (overwrite, so a retried batch rewrites the same folder: idempotent).
    ``latest_exception_counts`` reads the current totals back.
    """
    lines = spark.readStream.format("text").load(log_dir)
    counts = extract_exceptions(lines).groupBy("exception").count()

    def write_batch(batch, epoch_id):
        batch.write.mode("overwrite").parquet(os.path.join(out_dir, f"batch_id={epoch_id}"))

    w = (counts.writeStream.outputMode("update").foreachBatch(write_batch)
         .option("checkpointLocation", _ckpt(spark, "exception_counts", checkpoint)))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def latest_exception_counts(spark: SparkSession, out_dir: str):
    """Current total per exception: the row of its latest batch."""
    from pyspark.sql import functions as F

    df = spark.read.parquet(out_dir)
    return df.groupBy("exception").agg(F.max_by("count", "batch_id").alias("count"))
