"""Tumbling-window statistics, for batch and streaming input alike."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import rows_within


def _window_stats(
    df: DataFrame, key: str, stats: dict[str, Column], time_col: str, window: str, watermark: str
) -> DataFrame:
    # Partial aggregation runs before the shuffle in both modes, so a title or
    # device that holds much of the input sends one row per window and task. A
    # watermark has no effect on batch input.
    return (
        df.withWatermark(time_col, watermark)
        .groupBy(F.window(time_col, window), key)
        .agg(*[stat.alias(name) for name, stat in stats.items()])
        .select(
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            key,
            *stats,
        )
    )


def movie_window_stats(
    df: DataFrame,
    *,
    time_col: str = "processing_timestamp",
    window: str = "1 minute",
    watermark: str = "1 minute",
) -> DataFrame:
    """Views with a known user, total and mean watch time per window and movie."""
    stats = {
        "view_count": F.count("user_id"),
        "total_watch_time": F.sum("duration_seconds"),
        "avg_watch_time": F.avg("duration_seconds"),
    }
    return _window_stats(df, "movie_id", stats, time_col, window, watermark)


def device_window_stats(
    df: DataFrame,
    *,
    time_col: str = "processing_timestamp",
    window: str = "1 minute",
    watermark: str = "1 minute",
) -> DataFrame:
    """Views with a known user and mean watch time per window and device."""
    stats = {
        "view_count": F.count("user_id"),
        "avg_watch_time": F.avg("duration_seconds"),
    }
    return _window_stats(df, "device", stats, time_col, window, watermark)


def views_by_device(
    df: DataFrame,
    *,
    as_of=None,
    interval: str = "24 hours",
    grain: str = "hour",
    time_col: str = "processing_timestamp",
) -> DataFrame:
    """Chart series: rows per time step and device over the last interval."""
    return (
        rows_within(df, time_col, interval, as_of)
        .groupBy(F.date_trunc(grain, time_col).alias("period"), "device")
        .agg(F.count("*").alias("views"))
    )
