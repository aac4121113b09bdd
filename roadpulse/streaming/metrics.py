"""Windowed throughput and latency of a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def stream_throughput(
    stream: DataFrame, window: str = "5 minutes", slide: str | None = None, delay: str = "10 minutes",
    time: str = "processed_time", latency: str = "end_to_end_latency_ms",
) -> DataFrame:
    """Rows, rows per second and latency figures of each time window, tumbling or sliding.

    Rows later than ``delay`` behind the newest time are dropped, which lets finished windows leave
    the state. Works on a stream and, with the same result, on a table.
    """
    rows = stream.withColumn("_t", F.col(time).cast("timestamp"))
    if stream.isStreaming:
        rows = rows.withWatermark("_t", delay)
    span = F.window("_t", window, slide) if slide else F.window("_t", window)
    out = rows.groupBy(span).agg(
        F.count("*").alias("event_count"), F.avg(latency).alias("avg_latency_ms"), F.max(latency).alias("max_latency_ms"),
    )
    seconds = (F.unix_micros("window.end") - F.unix_micros("window.start")) / 1_000_000
    return out.select(
        F.col("window.start").cast("timestamp_ntz").alias("window_start"),
        F.col("window.end").cast("timestamp_ntz").alias("window_end"), "event_count",
        F.round(F.col("event_count") / seconds, 4).alias("events_per_second"), "avg_latency_ms", "max_latency_ms",
    )
