"""Loading JSON-lines events into ``user_views`` with a quarantine."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions import event_time
from ..schemas import USER_VIEWS, USER_VIEWS_MAX_LENGTH
from ..sources.files import LINE, RAW_RECORD, read_json_lines
from .tables import with_created_at

LOADED, REJECTED = "loaded", "rejected"


def classify_views(lines: DataFrame, *, as_of=None) -> DataFrame:
    """Rows of ``user_views`` with ``status`` and, when rejected, the line byte for byte.

    ``lines`` comes from ``read_json_lines`` with ``keep_bad``.

    A row is rejected when its line does not fit the schema, its time is missing
    or cannot be read, or an id is longer than its column.
    """
    views = lines.withColumn("event_timestamp", event_time("timestamp")).withColumnRenamed(
        "duration", "duration_seconds"
    )
    too_long = [F.length(c) > n for c, n in USER_VIEWS_MAX_LENGTH.items()]
    problems = [F.col(RAW_RECORD).isNotNull(), F.col("event_timestamp").isNull(), *too_long]
    bad = F.coalesce(F.greatest(*problems), F.lit(False))
    return with_created_at(views, as_of=as_of).select(
        *USER_VIEWS.fieldNames(),
        F.when(bad, F.col(LINE)).alias(RAW_RECORD),
        F.when(bad, REJECTED).otherwise(LOADED).alias("status"),
    )


def load_views(
    spark: SparkSession, source: str, table: str, *, load_id: str | int, as_of=None
) -> dict[str, int]:
    """Loads a JSON-lines path and returns the number of rows of each status.

    Good and bad rows are written in one pass, as partitions of one table, so
    the text is parsed once. Loading the same id again replaces
    its rows, so each source needs an id of its own.
    """
    counts = Observation(f"load-{load_id}")
    rows = classify_views(read_json_lines(spark, source, keep_bad=True), as_of=as_of).observe(
        counts,
        F.count_if(F.col("status") == LOADED).alias(LOADED),
        F.count_if(F.col("status") == REJECTED).alias(REJECTED),
    )
    rows.write.mode("overwrite").partitionBy("status").parquet(f"{table}/load_id={load_id}")
    return counts.get


def _status(spark: SparkSession, table: str, status: str) -> DataFrame:
    schema = (
        "user_id string, movie_id string, duration_seconds int, event_type string, "
        "event_timestamp timestamp, created_at timestamp, raw_record string, "
        "load_id string, status string"
    )
    return spark.read.schema(schema).parquet(table).where(F.col("status") == status)


def loaded_views(spark: SparkSession, table: str) -> DataFrame:
    """The rows of ``user_views``; other statuses are not read."""
    return _status(spark, table, LOADED).select(*USER_VIEWS.fieldNames())


def rejected_views(spark: SparkSession, table: str) -> DataFrame:
    """The rejected lines as text."""
    return _status(spark, table, REJECTED).select(RAW_RECORD)
