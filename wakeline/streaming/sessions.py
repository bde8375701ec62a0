"""Streaming editions: tumbling archive buckets and gap-only segments as session windows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def stream_segments(points: DataFrame, gap: str = "900 seconds", late: str = "10 minutes", least: int = 15) -> DataFrame:
    """Segments of a stream (hex, time) closed by silence; late points within ``late`` still count."""
    grouped = points.withWatermark("time", late).groupBy("hex", F.session_window("time", gap).alias("w"))
    return grouped.agg(F.count("*").alias("n_points"), F.min("time").alias("t_start"), F.max("time").alias("t_end")).where(F.col("n_points") >= least).select("hex", "n_points", "t_start", "t_end")


def stream_buckets(points: DataFrame, width: str = "5 minutes", late: str = "10 minutes") -> DataFrame:
    """Points and entities of each five-minute bucket."""
    return points.withWatermark("time", late).groupBy(F.window("time", width).alias("w")).agg(F.count("*").alias("n"), F.approx_count_distinct("hex").alias("entities")).select(F.col("w.start").alias("bucket"), "n", "entities")
