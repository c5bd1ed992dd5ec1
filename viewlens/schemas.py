"""Declared schemas of the event messages and of every table the jobs fill."""

from __future__ import annotations

from pyspark.sql.types import (
    BinaryType,
    BooleanType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

_TYPES = {
    "string": StringType(),
    "int": IntegerType(),
    "long": LongType(),
    "double": DoubleType(),
    "timestamp": TimestampType(),
    "date": DateType(),
    "boolean": BooleanType(),
    "binary": BinaryType(),
}


def schema_of(**columns: str) -> StructType:
    """A schema of nullable columns by name and kind; needs no session."""
    return StructType([StructField(name, _TYPES[kind]) for name, kind in columns.items()])


# -- messages -----------------------------------------------------------------

VIEW_EVENT = schema_of(
    user_id="string",
    movie_id="string",
    duration_seconds="int",
    event_type="string",
    device="string",
    timestamp="string",
)

VIEW_EVENT_EXT = StructType(
    VIEW_EVENT.fields
    + schema_of(user_region="string", content_type="string", bitrate="int").fields
)

SIMPLE_EVENT = schema_of(
    user_id="string",
    movie_id="string",
    duration="int",
    event_type="string",
    timestamp="string",
)

# -- tables -------------------------------------------------------------------

USER_VIEWS = schema_of(
    user_id="string",
    movie_id="string",
    duration_seconds="int",
    event_type="string",
    event_timestamp="timestamp",
    created_at="timestamp",
)

# Longest text each column of USER_VIEWS takes (fixed values).
USER_VIEWS_MAX_LENGTH = {"user_id": 50, "movie_id": 50, "event_type": 20}

MOVIE_STATS = schema_of(
    movie_id="string",
    total_views="int",
    total_watch_time="int",
    unique_users="int",
    last_updated="timestamp",
)

USER_VIEWS_PROCESSED = schema_of(
    user_id="string",
    movie_id="string",
    duration_seconds="int",
    event_type="string",
    device="string",
    original_timestamp="timestamp",
    watch_category="string",
    processing_timestamp="timestamp",
)

MOVIE_STATS_REALTIME = schema_of(
    window_start="timestamp",
    window_end="timestamp",
    movie_id="string",
    view_count="long",
    total_watch_time="long",
    avg_watch_time="double",
)

DEVICE_STATS_REALTIME = schema_of(
    window_start="timestamp",
    window_end="timestamp",
    device="string",
    view_count="long",
    avg_watch_time="double",
)

USER_VIEWS_FACT = schema_of(
    user_id="string",
    movie_id="string",
    duration_seconds="int",
    event_type="string",
    device="string",
    watch_category="string",
    event_date="date",
    event_timestamp="timestamp",
    session_id="string",
    is_valid="int",
)

DAILY_METRICS = schema_of(
    metric_date="date",
    total_views="long",
    unique_users="long",
    total_watch_time="long",
    avg_watch_time="double",
)

MOVIE_POPULARITY = schema_of(
    movie_id="string",
    total_views="long",
    unique_users="long",
    avg_watch_time="double",
    last_updated="timestamp",
)

BUSINESS_METRICS = schema_of(
    metric_date="date",
    total_views="long",
    unique_users="long",
    total_watch_time="long",
    popular_movie="string",
    avg_session_duration="double",
    calculated_at="timestamp",
)

KPI_METRICS = schema_of(metric_name="string", metric_value="double", calculated_at="timestamp")

ALERTS = schema_of(
    alert_type="string", message="string", severity="string", created_at="timestamp"
)

LAKE_CHANGES = schema_of(processing_date="date", event_date="date", n_rows="long")

#: Views of a movie on a day; ``users`` is a HyperLogLog sketch of its users.
MOVIE_DAILY = schema_of(
    event_date="date",
    movie_id="string",
    total_views="long",
    total_watch_time="long",
    n_watched="long",
    users="binary",
)

#: Rows of a movie by the date they arrived.
MOVIE_ARRIVALS = schema_of(processing_date="date", movie_id="string", views="long")

#: Where each user of a session stream stands.
SESSION_USERS = schema_of(
    bucket="int", user_id="string", last_time="timestamp", last_seq="long"
)

TABLES = {
    "user_views": USER_VIEWS,
    "movie_stats": MOVIE_STATS,
    "user_views_processed": USER_VIEWS_PROCESSED,
    "movie_stats_realtime": MOVIE_STATS_REALTIME,
    "device_stats_realtime": DEVICE_STATS_REALTIME,
    "user_views_fact": USER_VIEWS_FACT,
    "daily_metrics": DAILY_METRICS,
    "movie_popularity": MOVIE_POPULARITY,
    "business_metrics": BUSINESS_METRICS,
    "kpi_metrics": KPI_METRICS,
    "alerts": ALERTS,
}
