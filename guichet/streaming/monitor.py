"""Windowed class counts over a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery


def class_distribution_stream(events: DataFrame, ts: str, label: str, window: str = "1 hour", delay: str = "10 minutes") -> DataFrame:
    """Rows per window and class. Rows later than ``delay`` are dropped and closed windows leave the state.

    The state is one counter per open window and class, combined before the shuffle.
    """
    timed = events.withColumn("__ts", F.col(ts).cast("timestamp")).withWatermark("__ts", delay)
    return timed.groupBy(F.window("__ts", window).alias("w"), label).agg(F.count("*").alias("n")).select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), label, "n")


def with_window_share(counts: DataFrame, window_start: str = "window_start") -> DataFrame:
    """Class percentage within each finished window."""
    totals = counts.groupBy(window_start).agg(F.sum("n").alias("total"))
    return counts.join(totals, window_start).withColumn("pct", F.col("n") * 100.0 / F.col("total")).drop("total")


def write_closed_windows(counts: DataFrame, out_path: str, checkpoint: str, once: bool = False) -> StreamingQuery:
    """Append each window once the watermark has passed its end."""
    writer = counts.writeStream.format("parquet").outputMode("append").option("path", out_path).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start() if once else writer.start()


def write_windows(counts: DataFrame, out_path: str, checkpoint: str, once: bool = False) -> StreamingQuery:
    """Store the windows that changed in each batch, open ones included, with the batch's number.

    A late correction is a later row of its window; :func:`latest_windows` reads the last one. A batch that is
    run again replaces its own folder, so nothing counts twice.
    """

    def store(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out_path}/batch={number}")

    writer = counts.writeStream.foreachBatch(store).outputMode("update").option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start() if once else writer.start()


def latest_windows(stored: DataFrame, label: str) -> DataFrame:
    """One row per window and class: the last that :func:`write_windows` stored."""
    last = F.max_by("n", "batch").alias("n")
    return stored.groupBy("window_start", "window_end", label).agg(last)
