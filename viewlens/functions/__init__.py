from .columns import (
    as_of_column,
    event_hash,
    event_time,
    is_valid_view,
    latency_seconds,
    micros_between,
    percent_or_null,
    percent_or_zero,
    seconds_between,
    to_flag,
    watch_category,
)
from .timefilters import (
    ARRIVAL_DATE,
    ARRIVAL_TIME,
    last_days,
    rows_of_day,
    rows_since_previous_midnight,
    rows_within,
    same_day,
    since_previous_midnight,
    with_arrival_date,
    within,
)

__all__ = [
    "ARRIVAL_DATE",
    "ARRIVAL_TIME",
    "as_of_column",
    "event_hash",
    "event_time",
    "is_valid_view",
    "last_days",
    "latency_seconds",
    "micros_between",
    "percent_or_null",
    "percent_or_zero",
    "rows_of_day",
    "rows_since_previous_midnight",
    "rows_within",
    "same_day",
    "seconds_between",
    "since_previous_midnight",
    "to_flag",
    "watch_category",
    "with_arrival_date",
    "within",
]
