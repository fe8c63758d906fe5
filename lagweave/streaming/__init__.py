"""An extension: incremental profiles over a stream of measurements."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def windowed_profiles(events: DataFrame, width: str = "1 day", late: str = "2 days") -> DataFrame:
    """window, gene, n, value: counts and means of measurements (ts, gene, value) by tumbling windows; works on a stream or a table."""
    dated = events.withWatermark("ts", late) if events.isStreaming else events
    return dated.groupBy(F.window("ts", width).alias("w"), "gene").agg(F.count("*").alias("n"), F.round(F.avg("value"), 6).alias("value")).select(F.col("w.start").alias("start"), "gene", "n", "value")
