"""Streaming forms of the feed operators: each gives on a bounded input what its batch form gives."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql import functions as F


def deduplicate(stream: DataFrame, key: list[str], event_time: str, delay: str = "30 days") -> DataFrame:
    """One row a key within the collection window; state older than the window is dropped."""
    return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(key)


def window_counts(stream: DataFrame, event_time: str, key: str, width: str = "1 hour", delay: str = "2 hours") -> DataFrame:
    """Counts a tumbling window; rows later than the delay are left out."""
    return stream.withWatermark(event_time, delay).groupBy(F.window(event_time, width).alias("w"), key).agg(F.count(F.lit(1)).alias("n"))


def with_expiry(stream: DataFrame, event_time: str, days: int = 90) -> DataFrame:
    return stream.withColumn("expires_at", F.col(event_time) + F.make_dt_interval(F.lit(days)))


def write_once(stream: DataFrame, target: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Each micro-batch as a folder of its own, named by its number and written over: one that is run again after a failure
    replaces what it left, so every row is there once."""

    def save(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{target}/batch={number}")

    return stream.writeStream.foreachBatch(save).option("checkpointLocation", checkpoint).trigger(**trigger or {"availableNow": True}).start()
