"""Incremental forms: metrics over a stream of count events. An extension; no batch result depends on it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _timed(events: DataFrame) -> DataFrame:
    """Watermarks need an instant: timestamps without a zone are taken in the session's."""
    return events.withColumn("ts", F.col("ts").cast("timestamp"))


def windowed_totals(events: DataFrame, *, late: str = "10 minutes", window: str = "1 hour") -> DataFrame:
    """events (ts, event_type, value) -> count and sum of each type in each window, with a watermark so that state stays bounded."""
    return _timed(events).withWatermark("ts", late).groupBy(F.window("ts", window), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("window.start").alias("start"), "event_type", "n", "total")


def sessions(events: DataFrame, *, late: str = "10 minutes", gap: str = "30 minutes") -> DataFrame:
    """Events of a user with no gap as one session."""
    return _timed(events).withWatermark("ts", late).groupBy(F.session_window("ts", gap), "user_id").agg(F.count("*").alias("n")).select(F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), "user_id", "n")


def first_seen(events: DataFrame, key: str, *, late: str = "10 minutes") -> DataFrame:
    """Each key once within the watermark."""
    return _timed(events).withWatermark("ts", late).dropDuplicatesWithinWatermark([key])
