"""Chunks as they arrive: windowed counts and incremental extraction decisions over streams."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import ingest


def windowed_counts(events: DataFrame, time: str, key: str, size: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """(start, key, n): events by tumbling window and key; later ones than the watermark are left out."""
    return (
        events.withColumn(time, F.col(time).cast("timestamp"))
        .withWatermark(time, late)
        .groupBy(F.window(time, size).alias("w"), key)
        .agg(F.count("*").alias("n"))
        .select(F.col("w.start").alias("start"), key, "n")
    )


def first_seen(chunks: DataFrame, time: str, late: str = "1 day") -> DataFrame:
    """Chunks whose signature did not arrive before, within the watermark."""
    return chunks.withWatermark(time, late).dropDuplicatesWithinWatermark(["signature"])


def run_incremental(chunks: DataFrame, manifest: Callable[[], DataFrame], sink: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """For each batch of a stream of chunks (id, signature), decide against the manifest and hand on what to regenerate.

    The sink gets a batch at least once, with its number, and should write by it.
    """

    def batch(df: DataFrame, epoch: int) -> None:
        decided = ingest.actions(df, manifest())
        sink(decided.where("action = 'regenerate'"), epoch)

    return chunks.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
