"""Repeated changes of an at-least-once feed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def drop_repeats(events: DataFrame) -> DataFrame:
    """One row per feed position; repeats are combined before the shuffle."""
    return events.dropDuplicates(["seq"])


def drop_repeats_within(events: DataFrame, delay: str) -> DataFrame:
    """The same on a stream: a position that comes again within ``delay`` of its arrival goes.

    The watermark runs on arrival, not on the time of the change: a change may be as old as it
    likes and is kept if its position is new.
    """
    arrived = events.withColumn("_arrived", F.current_timestamp()).withWatermark("_arrived", delay)
    return arrived.dropDuplicatesWithinWatermark(["seq"]).drop("_arrived")
