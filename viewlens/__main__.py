"""Command line for spark-submit: ``python -m viewlens COMMAND --tables PATH``.

Tables live under one folder: lake, user_views, user_views_processed,
user_views_fact, movie_stats_realtime, device_stats_realtime, daily_metrics,
movie_daily, movie_popularity, movie_arrivals, business_metrics, kpi_metrics, alerts,
reports, and on request user_metrics, retention, movie_totals, device_totals and start_totals.
"""

from __future__ import annotations

import argparse
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession

from .functions import ARRIVAL_DATE
from .operators import hourly_summary, load_summary, recent_events, require_tables
from .plans import jobs
from .schemas import VIEW_EVENT, VIEW_EVENT_EXT
from .session import build_session
from .sinks import change_table, event_table, load_views, loaded_views, read_arrivals
from .sources import decode_events, kafka_stream, stream_json_lines
from .streaming import (
    WindowTotals,
    await_any,
    flush_user_metrics,
    start_event_tables,
    start_totals,
    statistics_table,
    stop_all,
)

KEPT_TABLES = {
    "user_views_processed": "processing_timestamp",
    "movie_stats_realtime": "window_end",
    "device_stats_realtime": "window_end",
}
STATISTICS = ("movie_stats_realtime", "device_stats_realtime")


def stream(spark: SparkSession, args: argparse.Namespace) -> None:
    schema = VIEW_EVENT_EXT if args.extended else VIEW_EVENT
    if args.files:
        events = stream_json_lines(spark, args.files, schema)
    else:
        events = decode_events(
            kafka_stream(
                spark,
                args.servers,
                topic=args.topic,
                starting_offsets=args.starting_offsets,
                max_offsets_per_trigger=args.max_offsets,
            ),
            schema,
        )
    trigger = {"availableNow": True} if args.once else {"processingTime": args.interval}
    queries = start_event_tables(
        events,
        tables=args.tables,
        checkpoints=args.checkpoints,
        trigger=trigger,
        sessions=args.sessions,
        retention=args.retention,
        corrections=args.corrections,
        database={"url": args.database} if args.database else None,
    )
    try:
        if args.once:
            for query in queries:
                query.awaitTermination()
        else:
            await_any(spark)
    finally:
        stop_all(queries)
    if args.sessions and args.flush:
        flush_user_metrics(spark, f"{args.tables}/user_metrics")


def compact(spark: SparkSession, args: argparse.Namespace) -> None:
    """Folds what streams have added to their tables; for streams that are stopped."""
    tables = {name: statistics_table(f"{args.tables}/{name}", name) for name in STATISTICS}
    for name in ("lake", "user_views_processed"):
        tables[name] = event_table(spark, f"{args.tables}/{name}", ARRIVAL_DATE)
    tables["lake changes"] = change_table(f"{args.tables}/lake")
    for name, table in tables.items():
        print(name, "folded" if table.compact(spark) else "has no updates")
        table.vacuum(spark)


def correct(spark: SparkSession, args: argparse.Namespace) -> None:
    """Merges late rows into their windows."""
    totals = [
        WindowTotals(f"{args.tables}/movie_totals", "movie_id"),
        WindowTotals(f"{args.tables}/device_totals", "device"),
        start_totals(f"{args.tables}/start_totals"),
    ]
    for total in totals:
        print(total.key, total.correct(spark), "batches with late rows")


def load(spark: SparkSession, args: argparse.Namespace) -> None:
    table = f"{args.tables}/user_views"
    print(load_views(spark, args.source, table, load_id=args.run_id, as_of=args.as_of))
    views = loaded_views(spark, table)
    load_summary(views).show()
    recent_events(views, time_col="event_timestamp", tie_col="movie_id").show(truncate=False)


def rollup(spark: SparkSession, args: argparse.Namespace) -> None:
    done = jobs.daily_rollup(
        _events(spark, args, "lake"),
        tables=args.tables,
        as_of=args.as_of,
        exact=not args.approximate,
        changes=change_table(f"{args.tables}/lake").read(spark),
    )
    print("rollup done" if done else "no recent events")


def metrics(spark: SparkSession, args: argparse.Namespace) -> None:
    processed = _events(spark, args, "user_views_processed")
    path = f"{args.tables}/business_metrics"
    arrivals = f"{args.tables}/movie_arrivals"
    jobs.update_business_metrics(processed, path, as_of=args.as_of, arrivals=arrivals)
    jobs.append_kpis(
        processed, f"{args.tables}/kpi_metrics", run_id=args.run_id, as_of=args.as_of
    )


def report(spark: SparkSession, args: argparse.Namespace) -> None:
    processed = _events(spark, args, "user_views_processed")
    jobs.daily_report(processed, f"{args.tables}/reports/{args.run_id}", as_of=args.as_of)


def monitor(spark: SparkSession, args: argparse.Namespace) -> None:
    processed = _events(spark, args, "user_views_processed")
    jobs.monitor_once(processed, f"{args.tables}/alerts", run_id=args.run_id, as_of=args.as_of)


def verify(spark: SparkSession, args: argparse.Namespace) -> None:
    tables = {"user_views_processed": _events(spark, args, "user_views_processed")}
    for name in STATISTICS:
        tables[name] = statistics_table(f"{args.tables}/{name}", name).read(spark)
    require_tables(tables, time_cols=KEPT_TABLES).show(truncate=False)
    hourly_summary(tables["user_views_processed"], as_of=args.as_of).show()


def _events(spark: SparkSession, args: argparse.Namespace, name: str) -> DataFrame:
    return read_arrivals(spark, f"{args.tables}/{name}")


COMMANDS = {
    f.__name__: f
    for f in (stream, compact, correct, load, rollup, metrics, report, monitor, verify)
}


def main(argv: list[str] | None = None) -> None:
    now = datetime.now(UTC)
    common = argparse.ArgumentParser(add_help=False)
    common.add_argument("--tables", required=True, help="folder of the tables")
    common.add_argument("--as-of", default=now, help="reference time, default now")
    common.add_argument("--run-id", default=now.strftime("%Y%m%dT%H%M%S"))

    parser = argparse.ArgumentParser(prog="viewlens")
    commands = parser.add_subparsers(dest="command", required=True)
    added = {name: commands.add_parser(name, parents=[common]) for name in COMMANDS}
    added["load"].add_argument("--source", required=True, help="JSON-lines path")
    added["rollup"].add_argument("--approximate", action="store_true")
    streaming = added["stream"]
    source = streaming.add_mutually_exclusive_group(required=True)
    source.add_argument("--servers", help="Kafka bootstrap servers")
    source.add_argument("--files", help="folder of JSON-lines files")
    streaming.add_argument("--topic", default="user_views_topic")
    streaming.add_argument("--starting-offsets", default="latest")
    streaming.add_argument("--max-offsets", type=int)
    streaming.add_argument("--checkpoints", required=True)
    streaming.add_argument("--interval", default="1 minute")
    streaming.add_argument("--extended", action="store_true", help="events with nine fields")
    streaming.add_argument("--sessions", action="store_true", help="also fill user_metrics")
    streaming.add_argument("--retention", action="store_true", help="also fill retention")
    streaming.add_argument("--corrections", action="store_true", help="also keep late rows")
    streaming.add_argument(
        "--flush", action="store_true", help="at the end give out the events that wait"
    )
    streaming.add_argument("--database", help="JDBC URL of a database to append to as well")
    streaming.add_argument("--once", action="store_true", help="stop at the end of the input")

    args = parser.parse_args(argv)
    COMMANDS[args.command](build_session(f"viewlens-{args.command}"), args)


if __name__ == "__main__":
    main()
