"""Streaming forms of batch rules; extras beside the batch engine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fresh_counts(events: DataFrame, ts: str, by: str, late: str = "36 hours", window: str = "1 day") -> DataFrame:
    """Counts by window and column; rows later than the freshness bound are dropped."""
    return events.withWatermark(ts, late).groupBy(F.window(ts, window), by).agg(F.count("*").alias("n"))


def unique_within(events: DataFrame, ts: str, key: str, late: str = "36 hours") -> DataFrame:
    return events.withWatermark(ts, late).dropDuplicatesWithinWatermark([key])


def near_in_time(left: DataFrame, right: DataFrame, key: str, hours: int = 168) -> DataFrame:
    """Interval join of two streams: left_ts and right_ts at most `hours` apart."""
    a, b = left.withWatermark("left_ts", f"{hours} hours"), right.withWatermark("right_ts", f"{hours} hours")
    gap = F.expr(f"INTERVAL {hours} HOURS")
    return a.join(b, (a[key] == b[key]) & (a["left_ts"] >= b["right_ts"] - gap) & (a["left_ts"] <= b["right_ts"] + gap))
