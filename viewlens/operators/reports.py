"""Top lists, latest rows and the daily report document."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import as_of_column, rows_since_previous_midnight


def top_movies(
    df: DataFrame, *, as_of=None, n: int = 10, time_col: str = "processing_timestamp"
) -> DataFrame:
    """The n most viewed movies since midnight of the previous day.

    Ties go to the smaller movie id, a missing id last.
    """
    return (
        rows_since_previous_midnight(df, time_col, as_of)
        .groupBy("movie_id")
        .agg(
            F.count("*").alias("view_count"),
            F.avg("duration_seconds").alias("avg_duration"),
            F.count_distinct("user_id").alias("unique_users"),
        )
        .orderBy(F.col("view_count").desc(), F.col("movie_id").asc_nulls_last())
        .limit(n)
    )


def top_movies_chart(stats: DataFrame, *, n: int = 10) -> DataFrame:
    """The n movies with the largest total view_count over all windows."""
    return (
        stats.groupBy("movie_id")
        .agg(F.sum("view_count").alias("view_count"))
        .orderBy(F.col("view_count").desc(), F.col("movie_id").asc_nulls_last())
        .limit(n)
    )


def recent_events(
    df: DataFrame,
    *,
    n: int = 5,
    time_col: str = "original_timestamp",
    tie_col: str = "session_id",
) -> DataFrame:
    """The n newest events with a readable time, newest first."""
    return (
        df.where(F.col(time_col).isNotNull())
        .orderBy(F.col(time_col).desc(), F.col(tie_col))
        .limit(n)
        .select("user_id", "movie_id", "event_type", time_col)
    )


def report_document(top: DataFrame, *, as_of=None) -> DataFrame:
    """The top list as one JSON text in a column ``value``, best movie first."""
    # The list holds the n rows of a top-n query, so one group is fine here.
    ranked = F.sort_array(
        F.collect_list(
            F.struct(
                (-F.col("view_count")).alias("order"),
                F.col("movie_id").isNull().alias("unnamed"),
                "movie_id",
                F.col("view_count").alias("views"),
                "avg_duration",
                "unique_users",
            )
        )
    )
    movies = F.transform(
        ranked,
        lambda m: F.struct(
            m["movie_id"].alias("movie_id"),
            m["views"].alias("views"),
            m["avg_duration"].alias("avg_duration"),
            m["unique_users"].alias("unique_users"),
        ),
    )
    generated_at = F.date_format(as_of_column(as_of), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    document = F.struct(generated_at.alias("generated_at"), F.col("popular_movies"))
    return top.agg(movies.alias("popular_movies")).select(
        F.to_json(document, {"ignoreNullFields": "false"}).alias("value")
    )
