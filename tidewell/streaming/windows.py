"""Counts in event-time windows, with and without a watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.functions.clock import instant_to_wall, wall_to_instant


def window_counts(
    events: DataFrame,
    key: str = "word",
    *,
    time: str = "time",
    width: str = "10 seconds",
    slide: str = "5 seconds",
    watermark: str | None = None,
    ordered: bool = False,
) -> DataFrame:
    """Count per window and key: (window_start, window_end, key, count).

    With ``watermark`` rows later than that are dropped and closed windows leave
    the state. ``ordered`` sorts by window, ascending (streams: complete mode). Wall-clock times
    (TIMESTAMP_NTZ) have wall-clock windows, which no zone's clock change touches.
    """
    wall = dict(events.dtypes)[time] == "timestamp_ntz" and watermark is not None
    if wall:
        # Only watermarks need TIMESTAMP.
        events = events.withColumn(time, wall_to_instant(time))
    if watermark is not None:
        events = events.withWatermark(time, watermark)
    counts = events.groupBy(F.window(time, width, slide), key).agg(
        F.count(F.lit(1)).alias("count")
    )
    if ordered:
        counts = counts.orderBy("window")
    ends = [F.col("window.start"), F.col("window.end")]
    start, end = map(instant_to_wall, ends) if wall else ends
    return counts.select(start.alias("window_start"), end.alias("window_end"), key, "count")


def local_times(frame: DataFrame, *columns: str) -> DataFrame:
    """Turn TIMESTAMP columns into wall-clock times of the session zone."""
    return frame.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})
