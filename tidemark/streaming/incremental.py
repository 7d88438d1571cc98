"""Incremental normalisation with Structured Streaming.

The batch job normalises the newest landed run (or backfills all of them). This
stream instead picks up exactly the runs published since its last run: a file source over the
landing's manifest tells them, and each micro-batch reads those runs' current folders, normalises
them and replaces exactly their partitions of the snapshot table. A retried batch, or a run that is
landed again, therefore never duplicates rows, a landing that isn't published is never seen, and
the stream and the batch job share one snapshot table.

``Trigger.AvailableNow`` turns it into a scheduled batch: process everything
new (in bounded micro-batches), then stop.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark import schemas as S
from tidemark.operators.normalize import NORMALIZERS
from tidemark.sources.landing import MANIFEST, MANIFEST_SCHEMA, read_landed
from tidemark.sources.snapshots import write_snapshots


def published_stream(spark: SparkSession, raw_root: str, max_files_per_trigger: int = 1000) -> DataFrame:
    """Newly published runs as a streaming DataFrame of manifest rows; a file is a landing."""
    return (spark.readStream.schema(MANIFEST_SCHEMA)
            .option("maxFilesPerTrigger", max_files_per_trigger)
            .option("mode", "FAILFAST")
            .json(f"{raw_root}/{MANIFEST}"))


def _normalize_runs(raw_root: str, output_root: str, feed: str):
    """A micro-batch writer: the runs that were published (their stamps reach the driver) are written anew, whole."""
    def write(batch: DataFrame, _: int) -> None:
        stamps = sorted(r[0] for r in batch.where(F.col("record_count") > 0).select(S.STAMP).distinct().collect())
        if stamps:
            landed = read_landed(batch.sparkSession, raw_root, feed, stamps)
            write_snapshots(NORMALIZERS[feed](landed), output_root, many_runs=len(stamps) > 1)
    return write


def start_incremental_normalize(
    spark: SparkSession,
    raw_root: str,
    output_root: str,
    checkpoint: str,
    feed: str,
    available_now: bool = True,
    processing_time: str | None = None,
    max_files_per_trigger: int = 1000,
) -> StreamingQuery:
    """Start the stream; with ``available_now`` it stops once caught up."""
    writer = (published_stream(spark, raw_root, max_files_per_trigger)
              .writeStream.outputMode("append")
              .option("checkpointLocation", checkpoint)
              .foreachBatch(_normalize_runs(raw_root, output_root, feed)))
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()


def catch_up(spark: SparkSession, raw_root: str, output_root: str, checkpoint: str, feed: str) -> None:
    """Normalise everything landed since the previous call, then return."""
    query = start_incremental_normalize(spark, raw_root, output_root, checkpoint, feed, available_now=True)
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
