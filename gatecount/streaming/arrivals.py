"""Arrivals as a stream: counts of windows of fifteen minutes, with a watermark for late rows.

An addition to the batch arrival curve, for gates that report as people enter.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def windowed_arrivals(stream: DataFrame, *, width: str = "15 minutes", late: str = "30 minutes") -> DataFrame:
    """window_start, event_type, n, total of (ts, event_type, value); rows later than ``late`` are left out."""
    timed = stream.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late)
    counts = timed.groupBy(F.window("ts", width), "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))
    return counts.select(F.col("window.start").alias("window_start"), "event_type", "n", "total")
