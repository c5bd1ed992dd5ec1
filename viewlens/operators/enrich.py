"""Event enrichment and the column sets of the processed and fact tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import as_of_column, event_hash, event_time, is_valid_view, to_flag, watch_category
from ..schemas import USER_VIEWS_FACT, USER_VIEWS_PROCESSED


def enrich_events(events: DataFrame, *, processing_time=None) -> DataFrame:
    """Typed times, category, validity and hash for each view event.

    Works on batch and streaming input alike. ``processing_time`` is a column, a
    time or None for now (one value per query or micro-batch).
    """
    return events.withColumns(
        {
            "original_timestamp": event_time("timestamp"),
            "processing_timestamp": as_of_column(processing_time),
            "watch_category": watch_category(),
            "is_valid": is_valid_view(),
            "session_id": event_hash(),
        }
    ).withColumn("event_date", F.to_date("original_timestamp"))


def processed_columns(enriched: DataFrame) -> DataFrame:
    """The projection stored as ``user_views_processed``."""
    return enriched.select(*USER_VIEWS_PROCESSED.fieldNames())


def fact_columns(enriched: DataFrame, *, keep: Sequence[str] = ()) -> DataFrame:
    """The projection stored as ``user_views_fact``: renamed time, 0/1 validity."""
    return (
        enriched.withColumnsRenamed({"original_timestamp": "event_timestamp"})
        .withColumn("is_valid", to_flag("is_valid"))
        .select(*USER_VIEWS_FACT.fieldNames(), *keep)
    )


def category_counts(enriched: DataFrame) -> DataFrame:
    """Rows per watch category."""
    return enriched.groupBy("watch_category").agg(F.count("*").alias("n"))
