"""Starting, combining and stopping the streaming queries."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..operators import (
    device_window_stats,
    enrich_events,
    movie_window_stats,
    processed_columns,
)
from ..schemas import DEVICE_STATS_REALTIME, MOVIE_STATS_REALTIME
from ..sinks.batches import (
    BatchWriter,
    fact_writer,
    fan_out,
    lake_writer,
    layered_writer,
    processed_writer,
    update_log_writer,
)
from ..sinks.database import database_writer
from ..sinks.layered import LayeredTable
from .retention import retention_stream
from .sessions import user_metrics_writer
from .windowstats import WindowTotals, start_totals

EVENT_TABLES = {
    "lake": lake_writer,
    "user_views_processed": processed_writer,
    "user_views_fact": fact_writer,
}
STATISTICS = {
    "movie_stats_realtime": (MOVIE_STATS_REALTIME, "movie_id"),
    "device_stats_realtime": (DEVICE_STATS_REALTIME, "device"),
}
AVAILABLE_NOW = {"availableNow": True}


def statistics_table(path: str, name: str) -> LayeredTable:
    """The window statistics of this name at a path, by day of the window's start."""
    schema, key = STATISTICS[name]
    keys = ("day", "window_start", "window_end", key)
    return LayeredTable(path, StructType([*schema.fields]).add("day", "date"), keys, "day")


def start(
    df: DataFrame,
    writer: BatchWriter,
    *,
    checkpoint: str,
    mode: str = "append",
    name: str | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Starts one query that hands its micro-batches to writer.

    ``trigger`` holds the keywords of ``DataStreamWriter.trigger``; without it a
    new batch starts as soon as the last one is done.
    """
    stream = df.writeStream.foreachBatch(writer).outputMode(mode)
    stream = stream.option("checkpointLocation", checkpoint)
    if name:
        stream = stream.queryName(name)
    if trigger:
        stream = stream.trigger(**trigger)
    return stream.start()


def start_console(
    df: DataFrame,
    *,
    mode: str = "append",
    rows: int = 10,
    checkpoint: str | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Prints micro-batches: ``append`` for events, ``update`` for statistics."""
    stream = df.writeStream.format("console").outputMode(mode)
    stream = stream.options(truncate="false", numRows=rows)
    if checkpoint:
        stream = stream.option("checkpointLocation", checkpoint)
    if trigger:
        stream = stream.trigger(**trigger)
    return stream.start()


def run_to_end(df: DataFrame, writer: BatchWriter, *, checkpoint: str, mode: str = "append") -> None:
    """Processes what the source holds now and stops."""
    start(df, writer, checkpoint=checkpoint, mode=mode, trigger=AVAILABLE_NOW).awaitTermination()


def start_event_tables(
    events: DataFrame,
    *,
    tables: str,
    checkpoints: str,
    trigger: dict | None = None,
    event_tables: Sequence[str] = ("lake", "user_views_processed"),
    sessions: bool = False,
    retention: bool = False,
    corrections: bool = False,
    compact_every: int = 50,
    database: dict[str, str] | None = None,
) -> list[StreamingQuery]:
    """Raw view events to event tables and to both statistics tables.

    The event tables share one read of the source. Add ``user_views_fact`` only
    where no rollup job fills that table. Lake and processed events are read through
    ``read_arrivals``, statistics through ``statistics_table``. ``sessions`` and ``retention`` add the tables
    user_metrics and retention. ``corrections`` adds movie_totals, device_totals and
    start_totals, which keep late rows (see ``WindowTotals``). With ``database``, JDBC options without a table
    name, processed events and statistics also go to tables of these names there,
    each batch once.
    """
    enriched = enrich_events(events)

    def also_stored(writer: BatchWriter, table: str, keys=(), transform=None) -> BatchWriter:
        if database is None:
            return writer
        return fan_out(writer, database_writer(database, table, keys=keys, transform=transform))

    write_events = fan_out(
        *[EVENT_TABLES[t](f"{tables}/{t}", compact_every=compact_every) for t in event_tables]
    )
    write_events = also_stored(
        write_events, "user_views_processed", transform=processed_columns
    )

    def begin(df: DataFrame, writer: BatchWriter, name: str, mode: str) -> StreamingQuery:
        checkpoint = f"{checkpoints}/{name}"
        return start(df, writer, checkpoint=checkpoint, mode=mode, name=name, trigger=trigger)

    def updates(name: str) -> BatchWriter:
        table = statistics_table(f"{tables}/{name}", name)
        keys = [k for k in table.keys if k != table.partition]
        return also_stored(layered_writer(table, compact_every=compact_every), name, keys)

    movies, devices = movie_window_stats(enriched), device_window_stats(enriched)
    queries = [
        begin(enriched, write_events, "event_tables", "append"),
        begin(movies, updates("movie_stats_realtime"), "movie_stats", "update"),
        begin(devices, updates("device_stats_realtime"), "device_stats", "update"),
    ]
    if corrections:
        totals = [
            WindowTotals(f"{tables}/movie_totals", "movie_id"),
            WindowTotals(f"{tables}/device_totals", "device"),
            start_totals(f"{tables}/start_totals"),
        ]
        writer = fan_out(*[t.writer(compact_every) for t in totals])
        queries.append(begin(enriched, writer, "window_totals", "append"))
    if sessions:
        writer = user_metrics_writer(f"{tables}/user_metrics", compact_every=compact_every)
        queries.append(begin(enriched, writer, "user_metrics", "append"))
    if retention:
        writer = update_log_writer(f"{tables}/retention")
        queries.append(begin(retention_stream(enriched), writer, "retention", "append"))
    return queries


def await_any(spark: SparkSession, timeout: float | None = None) -> bool | None:
    """Waits until any query ends or fails."""
    return spark.streams.awaitAnyTermination(timeout)


def stop_all(queries: Iterable[StreamingQuery], *, finish: bool = False) -> None:
    """Stops the queries; with ``finish`` after all input at hand is processed."""
    for query in queries:
        if finish and query.isActive:
            query.processAllAvailable()
        query.stop()
