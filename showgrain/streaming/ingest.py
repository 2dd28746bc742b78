"""The relation as a stream: windows with late data, and batches merged as they arrive."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def windowed_counts(stream: DataFrame, time: str = "ts", key: str = "event_type", size: str = "6 hours", late: str = "1 hour", slide: str | None = None) -> DataFrame:
    """Count and sum of ``value`` per window and key; rows later than ``late`` are left out."""
    w = F.window("t", size, slide) if slide else F.window("t", size)
    out = stream.withColumn("t", F.col(time).cast("timestamp")).withWatermark("t", late).groupBy(w, key).agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    return out.select(key, F.col("window.start").alias("window_start"), "n", "total")


def new_rows(stream: DataFrame, keys: list[str], time: str, late: str = "2 days") -> DataFrame:
    """Each key once within the watermark."""
    return stream.withColumn("_t", F.col(time).cast("timestamp")).withWatermark("_t", late).dropDuplicatesWithinWatermark(keys).drop("_t")


def merged_batches(stream: DataFrame, add: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Hand every arrived batch with its number to ``add`` until none is left.

    A batch may be handed over again after a failure, under its old number; ``add`` tells by it.
    """

    def each(batch: DataFrame, number: int) -> None:
        if batch.limit(1).count():
            add(batch, number)

    return stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
