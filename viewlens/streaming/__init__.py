from .queries import (
    await_any,
    run_to_end,
    start,
    start_console,
    start_event_tables,
    statistics_table,
    stop_all,
)
from .retention import retention_stream
from .sessions import (
    flush_user_metrics,
    user_metrics_result,
    user_metrics_totals,
    user_metrics_writer,
)
from .windowstats import WindowTotals, retention_of, start_totals

__all__ = [
    "WindowTotals",
    "await_any",
    "flush_user_metrics",
    "retention_of",
    "retention_stream",
    "run_to_end",
    "start",
    "start_console",
    "start_event_tables",
    "start_totals",
    "statistics_table",
    "stop_all",
    "user_metrics_result",
    "user_metrics_totals",
    "user_metrics_writer",
]
