"""Streaming forms of the log operators: sessions, windowed counts, deduplication, latest-per-key, all bounded by a watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def event_stream(spark: SparkSession, path: str, schema: str, files_per_trigger: int = 1) -> DataFrame:
    """A folder of Parquet files as a stream."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def sessions(events: DataFrame, key: str, time: str, gap: str = "5 minutes", late: str = "10 minutes") -> DataFrame:
    """key, start, end, n of runs of events whose distance is under the gap; emitted once the watermark has passed them."""
    return events.withWatermark(time, late).groupBy(key, F.session_window(time, gap).alias("w")).agg(F.count(F.lit(1)).alias("n")).select(key, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")


def windowed_counts(events: DataFrame, key: str, time: str, size: str, slide: str | None = None, late: str = "10 minutes") -> DataFrame:
    w = F.window(time, size, slide) if slide else F.window(time, size)
    return events.withWatermark(time, late).groupBy(w.alias("w"), key).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("start"), key, "n")


def distinct_events(events: DataFrame, keys: list[str], time: str, late: str = "10 minutes") -> DataFrame:
    """The first event of each key; state is dropped once the watermark has passed it."""
    return events.withWatermark(time, late).dropDuplicatesWithinWatermark(keys)


def latest_state(events: DataFrame, keys: list[str], order: list[str], columns: list[str], time: str, late: str = "10 minutes", size: str = "1 day") -> DataFrame:
    """keys, start and the last record of each key in each window of `size` (update mode). State lives until the watermark has passed its window; the last record of
    all is the one of the last window, an aggregation of what is stored (reconcile.latest_per_key)."""
    events = events.withWatermark(time, late)
    got = events.groupBy(*keys, F.window(time, size).alias("w")).agg(F.max_by(F.struct(*columns), F.struct(*order)).alias("r"))
    return got.select(*keys, F.col("w.start").alias("start"), "r.*")


def append_batches(stream: DataFrame, path: str, checkpoint: str):
    """Exactly-once append: every micro-batch is written under its number, so that a repeated batch overwrites itself."""

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
