"""Scalar column expressions. All are built-ins, so they stay in generated code."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def col(value: ColumnOrName) -> Column:
    return F.col(value) if isinstance(value, str) else value


def as_of_column(as_of: Column | datetime | str | None = None) -> Column:
    """The reference time of a query; now when not given.

    A datetime or text without a zone is read in the session time zone.
    """
    if as_of is None:
        return F.current_timestamp()
    if isinstance(as_of, Column):
        return as_of
    text = as_of.isoformat() if isinstance(as_of, datetime) else as_of
    return F.lit(text).cast("timestamp")


def watch_category(duration: ColumnOrName = "duration_seconds") -> Column:
    """short below 5 minutes, medium below 30, else long; NULL counts as long."""
    d = col(duration)
    return F.when(d < 300, "short").when(d < 1800, "medium").otherwise("long")


def event_time(text: ColumnOrName = "timestamp") -> Column:
    """Timestamp of an ISO-8601 text; NULL when it cannot be read."""
    return F.try_to_timestamp(col(text))


def event_hash(
    user: ColumnOrName = "user_id",
    movie: ColumnOrName = "movie_id",
    timestamp: ColumnOrName = "timestamp",
) -> Column:
    """md5 of ``user_movie_timestamp``; a missing part reads ``None``."""
    parts = [F.coalesce(col(c), F.lit("None")) for c in (user, movie, timestamp)]
    return F.md5(F.concat_ws("_", *parts))


def is_valid_view(
    duration: ColumnOrName = "duration_seconds",
    user: ColumnOrName = "user_id",
    movie: ColumnOrName = "movie_id",
    max_seconds: int = 86400,
) -> Column:
    """Duration within (0, max_seconds] and both ids present.

    A NULL duration gives NULL unless an id is missing, which gives false.
    """
    d = col(duration)
    return (d > 0) & (d <= max_seconds) & col(user).isNotNull() & col(movie).isNotNull()


def seconds_between(later: ColumnOrName, earlier: ColumnOrName) -> Column:
    """Difference of the two whole epoch seconds."""
    return F.unix_timestamp(col(later)) - F.unix_timestamp(col(earlier))


def micros_between(later: ColumnOrName, earlier: ColumnOrName) -> Column:
    return F.unix_micros(col(later)) - F.unix_micros(col(earlier))


def latency_seconds(
    processed: ColumnOrName = "processing_timestamp",
    original: ColumnOrName = "original_timestamp",
) -> Column:
    """Time from event to processing in seconds, with fractions."""
    return micros_between(processed, original) / F.lit(1e6)


def percent_or_zero(part: ColumnOrName, whole: ColumnOrName) -> Column:
    """part / whole * 100, or 0 when whole is not positive."""
    return F.when(col(whole) > 0, col(part) / col(whole) * 100).otherwise(F.lit(0.0))


def percent_or_null(part: ColumnOrName, whole: ColumnOrName) -> Column:
    """part / whole * 100, or NULL when whole is 0."""
    return col(part) / F.nullif(col(whole), F.lit(0)) * 100


def to_flag(condition: ColumnOrName) -> Column:
    """Boolean as 0/1; NULL stays NULL."""
    return col(condition).cast("int")
