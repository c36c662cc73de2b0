"""Streams of requests: windowed counts with a watermark for late rows, the time-based part of rate limiting."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def request_counts(events: DataFrame, length: str = "1 minute", slide: str = "10 seconds", late: str = "10 minutes", ts: str = "ts", key: str = "event_type") -> DataFrame:
    """Requests of each key in each sliding window; batch frames and streams alike."""
    w = F.window(ts, length, slide)
    return events.withWatermark(ts, late).groupBy(w.alias("w"), key).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), key, "n")


def over_limit(counts: DataFrame, limit: int) -> DataFrame:
    return counts.filter(F.col("n") > limit)
