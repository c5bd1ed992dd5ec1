"""Turns the ``events`` table into view events, with the odd rows it lacks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators.enrich import enrich_events

EVENT_TYPES = {"view": "start", "click": "pause", "signup": "resume"}
EVENTS = (
    "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, "
    "props string"
)
DEVICES = {0: "mobile", 1: "smart_tv", 2: "tablet"}


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet")


def stream_events(spark: SparkSession, path: str) -> DataFrame:
    """A folder of events as a file stream."""
    return spark.readStream.schema(EVENTS).parquet(path)


SLICES = 5


def event_slices(spark: SparkSession, sf_dir: str, *, late: bool = False) -> list[DataFrame]:
    """The table cut into time ranges of equal length, as a stream would bring it.

    With ``late`` every 50th event comes two ranges after its own.
    """
    events = read_events(spark, sf_dir)
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    first, last = events.agg(F.min(micros), F.max(micros)).first()
    if first is None:
        return [events] * SLICES
    number = F.expr(f"(unix_micros(cast(ts as timestamp)) - {first}) * {SLICES} div {last - first + 1}")
    if late:
        number = number + F.when(F.col("event_id") % 50 == 7, 2).otherwise(0)
    number = F.least(number, F.lit(SLICES - 1))
    return [events.where(number == i) for i in range(SLICES)]


def _one_of(column: Column, values: dict, default: str) -> Column:
    result = F.lit(default)
    for key, value in values.items():
        result = F.when(column == key, value).otherwise(result)
    return result


def view_events(events: DataFrame) -> DataFrame:
    """Raw view events plus event_id and the time each was processed."""
    number, kind = F.col("event_id"), F.col("event_type")
    is_error = kind == "error"
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    user = F.concat(F.lit("user_"), F.col("user_id").cast("string"))
    movie = F.concat(F.lit("movie_"), F.get_json_object("props", "$.k"))
    return events.select(
        "event_id",
        F.when(is_error & (number % 25 == 0), None).otherwise(user).alias("user_id"),
        F.when(is_error & (number % 10 == 0), None).otherwise(movie).alias("movie_id"),
        F.when(number % 200 == 7, None)
        .when(number % 500 == 3, 90000)
        .otherwise(F.floor(F.col("value") * 36).cast("int"))
        .alias("duration_seconds"),
        _one_of(kind, EVENT_TYPES, "stop").alias("event_type"),
        _one_of(number % 4, DEVICES, "desktop").alias("device"),
        F.when(number % 400 == 11, "not-a-timestamp").otherwise(iso).alias("timestamp"),
        F.timestamp_add("SECOND", (number % 900).cast("int"), F.col("ts").cast("timestamp")).alias(
            "processed_at"
        ),
    )


def enriched_views(events: DataFrame) -> DataFrame:
    """View events after enrichment; processing time is event time plus 0-899 s."""
    return enrich_events(
        view_events(events), processing_time=F.col("processed_at")
    ).drop("processed_at")


def load_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enriched_views(read_events(spark, sf_dir))


def as_of(views: DataFrame) -> Column:
    """The newest processing time, as a scalar subquery."""
    return views.agg(F.max("processing_timestamp")).scalar()
