"""The registered queries: every operator, source and sink over the events table."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from .. import fixtures, streaming
from .. import operators as ops
from ..schemas import SIMPLE_EVENT, USER_VIEWS, VIEW_EVENT, VIEW_EVENT_EXT
from ..session import scratch_dir
from ..sinks import (
    LayeredTable,
    change_table,
    classify_views,
    conform,
    create_table,
    fact_writer,
    lake_writer,
    latest_rows,
    layered_writer,
    load_views,
    loaded_views,
    processed_writer,
    read_arrivals,
    read_top,
    rejected_views,
    update_log_writer,
    with_created_at,
)
from ..sources import (
    consumed_events,
    decode_events,
    encode_events,
    read_json_lines,
    recent_processed_views,
    sample_json_lines,
)
from ..streaming import (
    WindowTotals,
    flush_user_metrics,
    retention_of,
    run_to_end,
    start_totals,
    statistics_table,
    user_metrics_result,
    user_metrics_totals,
    user_metrics_writer,
)
from . import jobs

ALL_FIRE = {"null_ids": 0, "latency": 0, "view_drop": 0}


@dataclass
class Source:
    """The view events of one data folder, as a table and as a stream."""

    spark: SparkSession
    sf_dir: str

    @cached_property
    def raw(self) -> DataFrame:
        return fixtures.view_events(fixtures.read_events(self.spark, self.sf_dir))

    @cached_property
    def views(self) -> DataFrame:
        return fixtures.load_views(self.spark, self.sf_dir)

    @cached_property
    def now(self) -> Column:
        return fixtures.as_of(self.views)

    @property
    def past(self) -> Column:
        """Ten days before the newest row."""
        return self.now - F.expr("INTERVAL 10 DAYS")

    def run_stream(self, root: str, transform, writer, mode: str = "append", late=False) -> None:
        """Runs a stream over the events, one micro-batch and restart for each time range.

        Where the table is in order of time, few tasks read a range, so its rows are dealt to
        as many files as tasks can run.
        """
        arrived = f"{root}/arrived"
        files = self.spark.sparkContext.defaultParallelism
        for events in fixtures.event_slices(self.spark, self.sf_dir, late=late):
            events.repartition(files).write.mode("append").parquet(arrived)
            views = fixtures.enriched_views(fixtures.stream_events(self.spark, arrived))
            run_to_end(transform(views), writer, checkpoint=f"{root}/checkpoint", mode=mode)

    def messages(self, *extra: Column) -> DataFrame:
        return encode_events(self.raw.select(*VIEW_EVENT.fieldNames(), *extra))

    def scratch(self, name: str) -> str:
        return scratch_dir(self.spark, name)

    def read(self, path: str) -> DataFrame:
        return self.spark.read.parquet(path)

    def stream_to(self, transform, make_writer, mode: str = "append") -> str:
        """Runs a stream into a new table and returns its path."""
        root = self.scratch("stream")
        self.run_stream(root, transform, make_writer(f"{root}/table"), mode)
        return f"{root}/table"

    def json_lines(self, *, broken: bool = False) -> str:
        """The events as JSON-lines files; with broken, some lines are cut off."""
        path = self.scratch("json-lines")
        fields = [F.col(c) for c in SIMPLE_EVENT.fieldNames() if c != "duration"]
        event = F.struct(*fields, F.col("duration_seconds").alias("duration"))
        line = F.to_json(event)
        if broken:
            cut = F.col("event_id") % 333 == 5
            line = F.when(cut, F.substring(line, 1, 20)).otherwise(line)
        self.raw.select(line.alias("value")).write.text(path)
        return path


_queries: dict[str, Callable[[Source], DataFrame]] = {}


def _query(function: Callable[[Source], DataFrame]) -> Callable[[Source], DataFrame]:
    _queries[function.__name__] = function
    return function


def _plain_times(df: DataFrame) -> DataFrame:
    """Timestamps without a zone, which is what the comparison side returns."""
    times = [f.name for f in df.schema.fields if isinstance(f.dataType, TimestampType)]
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in times})


def _runner(function: Callable[[Source], DataFrame]):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        # Expressions take the zone when they are made, so the caller's can be put back.
        zone = spark.conf.get("spark.sql.session.timeZone")
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        try:
            return _plain_times(function(Source(spark, sf_dir)))
        finally:
            spark.conf.set("spark.sql.session.timeZone", zone)

    run.__name__ = function.__name__
    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _runner(function) for name, function in _queries.items()}


# -- sources and enrichment ---------------------------------------------------


@_query
def processed_events(s: Source) -> DataFrame:
    return s.views


@_query
def processed_table(s: Source) -> DataFrame:
    return ops.processed_columns(s.views)


@_query
def decoded_events(s: Source) -> DataFrame:
    return decode_events(s.messages())


def _extended_fields() -> dict[str, Column]:
    number = F.col("event_id")
    return {
        "user_region": F.when(number % 3 == 0, "eu").when(number % 3 == 1, "us").otherwise("asia"),
        "content_type": F.when(number % 2 == 0, "movie").otherwise("series"),
        "bitrate": (1000 + number % 5000).cast("int"),
    }


@_query
def decoded_events_ext(s: Source) -> DataFrame:
    extra = [column.alias(name) for name, column in _extended_fields().items()]
    return decode_events(s.messages(*extra), VIEW_EVENT_EXT)


@_query
def consumed_fields(s: Source) -> DataFrame:
    return consumed_events(s.messages())


@_query
def json_lines_events(s: Source) -> DataFrame:
    return read_json_lines(s.spark, s.json_lines())


@_query
def json_lines_sample(s: Source) -> DataFrame:
    return ops.row_count(sample_json_lines(s.spark, s.json_lines()))


@_query
def load_json_lines(s: Source) -> DataFrame:
    table = s.scratch("user_views")
    load_views(s.spark, s.json_lines(broken=True), table, load_id=1, as_of=s.now)
    return loaded_views(s.spark, table)


@_query
def load_two_files(s: Source) -> DataFrame:
    """Two loads into one table, one of them repeated."""
    table, path = s.scratch("user_views"), s.json_lines(broken=True)
    for load_id in (1, 2, 2):
        load_views(s.spark, path, table, load_id=load_id, as_of=s.now)
    return loaded_views(s.spark, table)


@_query
def rejected_lines(s: Source) -> DataFrame:
    table = s.scratch("user_views")
    load_views(s.spark, s.json_lines(broken=True), table, load_id=1, as_of=s.now)
    return rejected_views(s.spark, table)


@_query
def load_counts(s: Source) -> DataFrame:
    lines = read_json_lines(s.spark, s.json_lines(broken=True), keep_bad=True)
    return classify_views(lines).groupBy("status").agg(F.count("*").alias("n"))


@_query
def category_counts(s: Source) -> DataFrame:
    return ops.category_counts(s.views)


# -- window statistics --------------------------------------------------------


@_query
def movie_stats_1m(s: Source) -> DataFrame:
    return ops.movie_window_stats(s.views)


@_query
def movie_stats_1h(s: Source) -> DataFrame:
    return ops.movie_window_stats(s.views, window="1 hour")


@_query
def movie_stats_1d(s: Source) -> DataFrame:
    return ops.movie_window_stats(s.views, window="1 day")


@_query
def device_stats_1m(s: Source) -> DataFrame:
    return ops.device_window_stats(s.views)


@_query
def device_stats_1h(s: Source) -> DataFrame:
    return ops.device_window_stats(s.views, window="1 hour")


#: Processing times lag event times by up to 15 minutes, so no row comes later than this.
ON_TIME = "20 minutes"


def _stored_statistics(s: Source, name: str, stats, window: str) -> LayeredTable:
    """Statistics of a stream in their table, folded after every second micro-batch."""
    root = s.scratch("stream")
    table = statistics_table(f"{root}/table", name)
    s.run_stream(
        root,
        lambda views: stats(views, window=window, watermark=ON_TIME),
        layered_writer(table, compact_every=2),
        mode="update",
    )
    return table


@_query
def movie_stats_stream(s: Source) -> DataFrame:
    table = _stored_statistics(s, "movie_stats_realtime", ops.movie_window_stats, "1 minute")
    return table.read(s.spark).drop("day")


@_query
def device_stats_stream(s: Source) -> DataFrame:
    table = _stored_statistics(s, "device_stats_realtime", ops.device_window_stats, "1 hour")
    return table.read(s.spark).drop("day")


@_query
def movie_stats_log(s: Source) -> DataFrame:
    """The same through a log of updates that is never folded."""
    log = s.stream_to(
        lambda views: ops.movie_window_stats(views, window="1 day", watermark=ON_TIME),
        update_log_writer,
        mode="update",
    )
    return latest_rows(s.read(log), ["window_start", "window_end", "movie_id"])


def _window_totals(s: Source, totals: WindowTotals, *, late: bool = True) -> WindowTotals:
    """Totals of a stream in which some rows come two micro-batches late, corrected twice."""
    s.run_stream(totals.root, lambda views: views, totals.writer(compact_every=4), late=late)
    totals.correct(s.spark)
    totals.compact(s.spark)
    totals.correct(s.spark)
    return totals


@_query
def movie_stats_on_time(s: Source) -> DataFrame:
    """Window statistics without the rows that came late, as a stateful query shows them."""
    totals = _window_totals(s, WindowTotals(s.scratch("totals"), "movie_id"))
    return totals.statistics(s.spark, corrected=False)


@_query
def movie_stats_corrected(s: Source) -> DataFrame:
    """The same with late rows merged into their windows."""
    totals = _window_totals(s, WindowTotals(s.scratch("totals"), "movie_id"))
    return totals.statistics(s.spark)


@_query
def device_stats_corrected(s: Source) -> DataFrame:
    totals = WindowTotals(s.scratch("totals"), "device", window="1 hour")
    return _window_totals(s, totals).statistics(s.spark).drop("total_watch_time")


@_query
def late_rows(s: Source) -> DataFrame:
    """The side table of the rows that came after their window was closed."""
    totals = _window_totals(s, WindowTotals(s.scratch("totals"), "movie_id"))
    return totals.late_rows(s.spark).select("event_id", "movie_id", "processing_timestamp", "batch_id")


@_query
def retention_corrected(s: Source) -> DataFrame:
    """Retention from starts per day and user, late ones included."""
    totals = _window_totals(s, start_totals(s.scratch("totals")))
    return retention_of(totals.totals(s.spark))


# -- event tables filled by a stream ------------------------------------------


def _same(views: DataFrame) -> DataFrame:
    return views


def _lake(path: str):
    return lake_writer(path, compact_every=2)


@_query
def lake_stream(s: Source) -> DataFrame:
    lake = read_arrivals(s.spark, s.stream_to(_same, _lake))
    return lake.select(*VIEW_EVENT.fieldNames(), "original_timestamp", "session_id")


@_query
def lake_stream_ext(s: Source) -> DataFrame:
    """Events with nine fields, all columns of the lake."""
    path = s.stream_to(lambda views: views.withColumns(_extended_fields()), _lake)
    return read_arrivals(s.spark, path).drop("processing_date")


@_query
def lake_changes(s: Source) -> DataFrame:
    """Which arrival dates of the lake hold rows of which event dates."""
    return change_table(s.stream_to(_same, _lake)).read(s.spark)


@_query
def processed_stream(s: Source) -> DataFrame:
    path = s.stream_to(_same, lambda path: processed_writer(path, compact_every=2))
    return read_arrivals(s.spark, path).drop("processing_date")


@_query
def fact_stream(s: Source) -> DataFrame:
    return s.read(s.stream_to(_same, fact_writer)).drop("batch_id")


# -- sessions and retention ---------------------------------------------------

SESSION_COLUMNS = [
    "event_id",
    "user_id",
    "original_timestamp",
    "prev_event_time",
    "time_since_last_event",
    "is_new_session",
    "session_seq_number",
]


def _session_events(views: DataFrame) -> DataFrame:
    """The columns session metrics need; place orders equal times without ties."""
    place = F.concat("session_id", F.lpad(F.col("event_id").cast("string"), 20, "0"))
    return views.select("event_id", "user_id", "original_timestamp", place.alias("place"))


@_query
def user_metrics(s: Source) -> DataFrame:
    metrics = ops.user_metrics(_session_events(s.views), tie_col="place")
    return metrics.select(*SESSION_COLUMNS)


@_query
def user_metrics_split(s: Source) -> DataFrame:
    """The same with time slices of a second, for each user."""
    metrics = ops.user_metrics(
        _session_events(s.views), tie_col="place", slice_seconds=1, whole_rows=0
    )
    return metrics.select(*SESSION_COLUMNS)


@_query
def user_metrics_ranges(s: Source) -> DataFrame:
    """The same over sorted ranges of the events."""
    events = _session_events(s.views)
    metrics = ops.user_metrics_in_ranges(events, s.scratch("sessions"), tie_col="place")
    return metrics.select(*SESSION_COLUMNS)


def _session_stream(s: Source, *, late: bool = False) -> str:
    """Session metrics of a stream that has ended and given out what waited."""
    root = s.scratch("user-metrics")
    writer = user_metrics_writer(root, tie_col="place", compact_every=2)
    s.run_stream(root, _session_events, writer, late=late)
    flush_user_metrics(s.spark, root, tie_col="place")
    return root


@_query
def user_metrics_stream(s: Source) -> DataFrame:
    return user_metrics_result(s.spark, _session_stream(s)).select(*SESSION_COLUMNS)


@_query
def user_metrics_stream_late(s: Source) -> DataFrame:
    """The same where some events come too late; those get no session."""
    return user_metrics_result(s.spark, _session_stream(s, late=True)).select(*SESSION_COLUMNS)


@_query
def user_metrics_stream_totals(s: Source) -> DataFrame:
    return user_metrics_totals(s.spark, _session_stream(s, late=True))


@_query
def retention(s: Source) -> DataFrame:
    return ops.retention(s.views)


@_query
def retention_stream(s: Source) -> DataFrame:
    return s.read(s.stream_to(streaming.retention_stream, update_log_writer)).drop("batch_id")


@_query
def retention_7d(s: Source) -> DataFrame:
    return ops.recent_retention(ops.retention(s.views), as_of=s.now)


@_query
def latest_retention(s: Source) -> DataFrame:
    return ops.latest_retention(ops.retention(s.views), as_of=s.now)


# -- facts and rollups --------------------------------------------------------


@_query
def fact_last_day(s: Source) -> DataFrame:
    recent = recent_processed_views(s.views, as_of=s.now)
    return ops.fact_columns(recent.withColumn("event_date", F.to_date("original_timestamp")))


@_query
def fact_load(s: Source) -> DataFrame:
    """The last day's event dates from the lake, loaded twice."""
    tables, path = s.scratch("facts"), s.stream_to(_same, _lake)
    lake = read_arrivals(s.spark, path)
    affected = jobs.affected_dates(lake, as_of=s.now)
    for _ in range(2):
        jobs.load_facts(lake, tables, affected, change_table(path).read(s.spark))
    return jobs.read_facts(s.spark, tables, undated=True)


@_query
def daily_metrics(s: Source) -> DataFrame:
    return ops.daily_metrics(s.views)


@_query
def daily_metrics_table(s: Source) -> DataFrame:
    tables = s.scratch("rollup")
    jobs.daily_rollup(s.views, tables=tables, as_of=s.now)
    return s.read(f"{tables}/daily_metrics")


@_query
def movie_popularity(s: Source) -> DataFrame:
    return ops.movie_popularity(s.views, as_of=s.now)


@_query
def movie_popularity_table(s: Source) -> DataFrame:
    tables = s.scratch("rollup")
    jobs.daily_rollup(s.views, tables=tables, as_of=s.now)
    return s.read(f"{tables}/movie_popularity")


@_query
def popularity_top(s: Source) -> DataFrame:
    """The ten movies at the head of the stored table, which is kept in order."""
    tables = s.scratch("rollup")
    jobs.daily_rollup(s.views, tables=tables, as_of=s.now)
    return read_top(s.spark, f"{tables}/movie_popularity", "total_views", 10, "movie_id")


#: Sketches may be off by a fifth, four times their stated standard error, or by one.
def _users_within_error(sketched: DataFrame, exact: DataFrame, key: str) -> DataFrame:
    exact = exact.select(F.col(key).alias("_key"), F.col("unique_users").alias("exact_users"))
    off = F.abs(F.col("unique_users") - F.col("exact_users"))
    return sketched.join(exact, F.col(key).eqNullSafe(F.col("_key"))).select(
        key, "total_views", "exact_users",
        (off <= F.greatest(F.lit(1.0), 0.2 * F.col("exact_users"))).alias("within_error"),
    )


@_query
def approx_daily_users(s: Source) -> DataFrame:
    daily = ops.daily_metrics(s.views, exact=False)
    return _users_within_error(daily, ops.daily_metrics(s.views), "metric_date")


@_query
def approx_movie_users(s: Source) -> DataFrame:
    popularity = ops.movie_popularity(s.views, as_of=s.now, exact=False)
    exact = ops.movie_popularity(s.views, as_of=s.now)
    return _users_within_error(popularity, exact, "movie_id")


def _rollup_of_sketches(s: Source) -> str:
    tables = s.scratch("rollup")
    jobs.daily_rollup(s.views, tables=tables, as_of=s.now, exact=False)
    return tables


@_query
def rollup_daily_users(s: Source) -> DataFrame:
    """Daily users from the sketches stored by movie and date."""
    daily = s.read(f"{_rollup_of_sketches(s)}/daily_metrics")
    return _users_within_error(daily, ops.daily_metrics(s.views), "metric_date")


@_query
def rollup_movie_users(s: Source) -> DataFrame:
    """Users of a movie over several dates, from the same sketches."""
    popularity = s.read(f"{_rollup_of_sketches(s)}/movie_popularity")
    now = fixtures.as_of(s.views)
    dates = jobs.affected_dates(s.views, as_of=now)
    exact = ops.movie_popularity(jobs.on_dates(s.views, dates), as_of=now)
    return _users_within_error(popularity, exact, "movie_id")


# -- the same at a past reference time ----------------------------------------


@_query
def past_hour_stats(s: Source) -> DataFrame:
    return ops.recent_stats(s.views, as_of=s.past)


@_query
def past_hourly_summary(s: Source) -> DataFrame:
    return ops.hourly_summary(s.views, as_of=s.past)


@_query
def past_last_day(s: Source) -> DataFrame:
    recent = recent_processed_views(s.views, as_of=s.past)
    return ops.fact_columns(recent.withColumn("event_date", F.to_date("original_timestamp")))


@_query
def past_popularity(s: Source) -> DataFrame:
    return ops.movie_popularity(s.views, as_of=s.past)


@_query
def past_top_movies(s: Source) -> DataFrame:
    return ops.top_movies(s.views, as_of=s.past)


@_query
def past_checks(s: Source) -> DataFrame:
    return ops.monitor_checks(s.views, as_of=s.past)


@_query
def past_views_by_device(s: Source) -> DataFrame:
    return ops.views_by_device(s.views, as_of=s.past)


@_query
def past_retention(s: Source) -> DataFrame:
    return ops.recent_retention(ops.retention(s.views), as_of=s.past)


@_query
def past_business_metrics(s: Source) -> DataFrame:
    return ops.business_metrics(s.views, as_of=s.past)


# -- metrics and reports ------------------------------------------------------


@_query
def business_metrics(s: Source) -> DataFrame:
    return ops.business_metrics(s.views, as_of=s.now)


@_query
def business_metrics_table(s: Source) -> DataFrame:
    """Metric rows of two days; the popular movie from counts by arrival date."""
    path, arrivals = s.scratch("business"), s.scratch("movie-arrivals")
    processed = read_arrivals(s.spark, s.stream_to(_same, processed_writer))
    for as_of in (s.now - F.expr("INTERVAL 1 DAY"), s.now, s.now):
        jobs.update_business_metrics(processed, path, as_of=as_of, arrivals=arrivals)
    return s.read(path)


@_query
def latest_business_metrics(s: Source) -> DataFrame:
    return ops.latest_business_metrics(business_metrics_table(s))


@_query
def popular_movie(s: Source) -> DataFrame:
    return ops.popular_movie(s.views)


@_query
def top_movies_day(s: Source) -> DataFrame:
    return ops.top_movies(s.views, as_of=s.now)


@_query
def report_document(s: Source) -> DataFrame:
    path = s.scratch("report")
    jobs.daily_report(s.views, path, as_of=s.now)
    schema = (
        "generated_at string, popular_movies array<struct<"
        "movie_id: string, views: long, avg_duration: double, unique_users: long>>"
    )
    return s.spark.read.schema(schema).json(path).select(F.inline("popular_movies"))


@_query
def last_hour_stats(s: Source) -> DataFrame:
    return ops.recent_stats(s.views, as_of=s.now)


@_query
def hourly_summary(s: Source) -> DataFrame:
    return ops.hourly_summary(s.views, as_of=s.now)


@_query
def load_summary(s: Source) -> DataFrame:
    return ops.load_summary(s.views)


@_query
def row_count(s: Source) -> DataFrame:
    return ops.row_count(s.views)


@_query
def headline_metrics(s: Source) -> DataFrame:
    return ops.headline_metrics(s.views)


@_query
def recent_events(s: Source) -> DataFrame:
    return ops.recent_events(s.views)


@_query
def kpi_rows(s: Source) -> DataFrame:
    return ops.kpi_rows(s.views)


@_query
def kpi_table(s: Source) -> DataFrame:
    path = s.scratch("kpis")
    jobs.append_kpis(s.views, path, run_id=1, as_of=s.now)
    return s.read(path).drop("run_id")


@_query
def views_by_device_24h(s: Source) -> DataFrame:
    return ops.views_by_device(s.views, as_of=s.now)


@_query
def top_movies_chart(s: Source) -> DataFrame:
    return ops.top_movies_chart(ops.movie_window_stats(s.views, window="1 hour"))


@_query
def top_movies_chart_stored(s: Source) -> DataFrame:
    """The chart over the stored log of a stream, through its latest rows."""
    return ops.top_movies_chart(movie_stats_stream(s))


# -- quality ------------------------------------------------------------------


@_query
def null_check(s: Source) -> DataFrame:
    return ops.null_id_check(s.views, as_of=s.now)


@_query
def latency_check(s: Source) -> DataFrame:
    return ops.latency_check(s.views, as_of=s.now)


@_query
def drop_check(s: Source) -> DataFrame:
    return ops.view_drop_check(s.views, as_of=s.now)


@_query
def monitor_checks(s: Source) -> DataFrame:
    return ops.monitor_checks(s.views, as_of=s.now)


@_query
def alerts(s: Source) -> DataFrame:
    return ops.alerts(s.views, as_of=s.now, thresholds=ALL_FIRE)


@_query
def alerts_table(s: Source) -> DataFrame:
    path = s.scratch("alerts")
    for _ in range(2):
        jobs.monitor_once(s.views, path, run_id="first", as_of=s.now, thresholds=ALL_FIRE)
    return s.read(path).drop("run_id")


@_query
def table_verification(s: Source) -> DataFrame:
    tables = {
        "user_views_processed": ops.processed_columns(s.views),
        "movie_stats_realtime": ops.movie_window_stats(s.views, window="1 hour"),
        "device_stats_realtime": ops.device_window_stats(s.views, window="1 hour"),
    }
    newest = {
        "user_views_processed": "processing_timestamp",
        "movie_stats_realtime": "window_end",
        "device_stats_realtime": "window_end",
    }
    return ops.verify_tables(tables, time_cols=newest)


@_query
def column_types(s: Source) -> DataFrame:
    return ops.column_types(s.views)


@_query
def column_statistics(s: Source) -> DataFrame:
    statistics = ops.column_statistics(s.views, ["duration_seconds"])
    return statistics.withColumns({c: F.round(c, 6) for c in ("mean", "std")})


def _rounded(statistics: DataFrame) -> DataFrame:
    return statistics.withColumns({c: F.round(c, 6) for c in ("mean", "std", "p25", "p50", "p75")})


@_query
def column_statistics_mixed(s: Source) -> DataFrame:
    """An integer column, a fractional one and one that is mostly NULL."""
    sometimes = F.when(F.col("event_id") % 7 == 0, F.col("value") * -1)
    events = fixtures.read_events(s.spark, s.sf_dir).withColumn("sometimes", sometimes)
    return _rounded(ops.column_statistics(events, ["user_id", "value", "sometimes"]))


@_query
def column_statistics_exact(s: Source) -> DataFrame:
    """Whole numbers that no double holds and decimals, beside a fractional column."""
    events = fixtures.read_events(s.spark, s.sf_dir).withColumns(
        {
            "large": F.col("event_id") % 1000 + F.lit(9007199254740993),
            "price": F.col("user_id").cast("decimal(20,4)") + F.lit("0.0001").cast("decimal(20,4)"),
        }
    )
    return _rounded(ops.column_statistics(events, ["large", "value", "price"]))


@_query
def declared_table(s: Source) -> DataFrame:
    path = s.scratch("declared")
    name = f"user_views_{path[-32:]}"
    create_table(s.spark, name, schema=USER_VIEWS, path=path)
    create_table(s.spark, name, schema=USER_VIEWS, path=path)
    views = s.views.withColumnRenamed("original_timestamp", "event_timestamp")
    conform(with_created_at(views, as_of=s.now), USER_VIEWS).write.insertInto(name)
    schema = s.spark.table(name).schema
    s.spark.sql(f"DROP TABLE {name}")  # the files stay, as the path is given
    return s.spark.read.schema(schema).parquet(path)
