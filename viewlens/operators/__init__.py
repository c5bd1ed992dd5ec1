from .enrich import category_counts, enrich_events, fact_columns, processed_columns
from .metrics import (
    business_metrics,
    daily_metrics,
    daily_metrics_of_days,
    headline_metrics,
    kpi_rows,
    latest_business_metrics,
    latest_retention,
    movie_days,
    movie_popularity,
    popular_movie,
    popularity_of_days,
    recent_retention,
    recent_stats,
    retention,
    row_count,
)
from .profile import column_statistics, column_types, first_rows
from .quality import (
    alerts,
    hourly_summary,
    latency_check,
    load_summary,
    monitor_checks,
    null_id_check,
    require_tables,
    verify_tables,
    view_drop_check,
)
from .realtime import device_window_stats, movie_window_stats, views_by_device
from .reports import recent_events, report_document, top_movies, top_movies_chart
from .sessions import user_metrics, user_metrics_in_ranges

__all__ = [
    "alerts",
    "business_metrics",
    "category_counts",
    "column_statistics",
    "column_types",
    "daily_metrics",
    "daily_metrics_of_days",
    "device_window_stats",
    "enrich_events",
    "fact_columns",
    "first_rows",
    "headline_metrics",
    "hourly_summary",
    "kpi_rows",
    "latency_check",
    "latest_business_metrics",
    "latest_retention",
    "load_summary",
    "monitor_checks",
    "movie_days",
    "movie_popularity",
    "movie_window_stats",
    "null_id_check",
    "popular_movie",
    "popularity_of_days",
    "processed_columns",
    "recent_events",
    "recent_retention",
    "recent_stats",
    "report_document",
    "require_tables",
    "retention",
    "row_count",
    "top_movies",
    "top_movies_chart",
    "user_metrics",
    "user_metrics_in_ranges",
    "verify_tables",
    "view_drop_check",
]
