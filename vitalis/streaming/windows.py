"""Sliding windows on streams.

Row frames (``ROWS n PRECEDING``) have no streaming form; the stream version
of a rolling average is an event-time sliding window of a fixed length and
slide, finalised by the watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def stream_sliding_avg(stream: DataFrame, key: str, ts: str, value: str, length: str = "10 minutes",
                       slide: str = "1 minute", watermark: str = "30 minutes") -> DataFrame:
    s = stream.withColumn("_et", F.col(ts).cast("timestamp")).withWatermark("_et", watermark)
    g = s.groupBy(key, F.window("_et", length, slide).alias("w")).agg(F.avg(value).alias("avg_value"), F.count(F.lit(1)).alias("n"))
    return g.select(key, F.col("w.start").cast("timestamp_ntz").alias("window_start"),
                    F.col("w.end").cast("timestamp_ntz").alias("window_end"), "avg_value", "n")
