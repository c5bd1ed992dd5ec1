from .batches import (
    change_table,
    fact_writer,
    fan_out,
    lake_writer,
    layered_writer,
    processed_writer,
    read_arrivals,
    update_log_writer,
)
from .database import database_writer, merge_statements
from .kafka import producer_options, publish
from .layered import LayeredTable, event_table
from .report import save_report
from .tables import (
    append_run,
    conform,
    create_table,
    latest_rows,
    read_top,
    refresh,
    replace_partitions,
    with_created_at,
)
from .views import classify_views, load_views, loaded_views, rejected_views

__all__ = [
    "LayeredTable",
    "append_run",
    "change_table",
    "classify_views",
    "conform",
    "create_table",
    "database_writer",
    "event_table",
    "fact_writer",
    "fan_out",
    "lake_writer",
    "latest_rows",
    "layered_writer",
    "load_views",
    "loaded_views",
    "merge_statements",
    "processed_writer",
    "producer_options",
    "publish",
    "refresh",
    "read_arrivals",
    "read_top",
    "rejected_views",
    "replace_partitions",
    "save_report",
    "update_log_writer",
    "with_created_at",
]
