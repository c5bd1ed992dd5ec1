"""Retention per day over a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.metrics import retention_rate


def retention_stream(
    enriched: DataFrame, *, watermark: str = "1 minute", time_col: str = "original_timestamp"
) -> DataFrame:
    """The batch retention of each closed day, for append mode.

    A day is given out once the watermark has passed its end. Events without a
    readable time belong to no day.
    """
    per_user = (
        enriched.where(F.col("event_type") == "start")
        .withWatermark(time_col, watermark)
        .groupBy(F.window(time_col, "1 day").alias("day"), "user_id")
        .agg(F.count("*").alias("daily_starts"))
    )
    return retention_rate(per_user.groupBy("day")).select(
        F.to_date("day.start").alias("event_date"),
        "daily_active_users",
        "retained_users",
        "retention_rate",
    )
