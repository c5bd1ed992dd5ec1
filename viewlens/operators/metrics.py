"""Retention, daily, popularity, business and headline metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import (
    as_of_column,
    last_days,
    percent_or_zero,
    rows_of_day,
    rows_within,
)


def _distinct(column: str, exact: bool) -> Column:
    # The exact count shuffles on (group, column), which spreads a large group;
    # the approximate one ships a fixed-size sketch per group and task.
    return F.count_distinct(column) if exact else F.approx_count_distinct(column)


def retention(df: DataFrame) -> DataFrame:
    """Per day: users with a start event and those with more than one."""
    return retention_rate(
        df.where(F.col("event_type") == "start")
        .groupBy("user_id", "event_date")
        .agg(F.count("*").alias("daily_starts"))
        .groupBy("event_date")
    )


def retention_rate(grouped) -> DataFrame:
    return grouped.agg(
        F.count("*").alias("daily_active_users"),
        F.sum(F.when(F.col("daily_starts") > 1, 1).otherwise(0)).alias("retained_users"),
    ).withColumn("retention_rate", percent_or_zero("retained_users", "daily_active_users"))


def recent_retention(rates: DataFrame, *, as_of=None, days: int = 7) -> DataFrame:
    """The retention series of the last days."""
    return rates.where(last_days("event_date", days, as_of))


def latest_retention(rates: DataFrame, *, as_of=None, days: int = 7) -> DataFrame:
    """The newest retention rate of the last days, one row."""
    return (
        recent_retention(rates, as_of=as_of, days=days)
        .orderBy(F.col("event_date").desc())
        .limit(1)
        .select("event_date", "retention_rate")
    )


def daily_metrics(facts: DataFrame, *, exact: bool = True) -> DataFrame:
    """Views, users and watch time per event date."""
    return (
        facts.groupBy("event_date")
        .agg(
            F.count("*").alias("total_views"),
            _distinct("user_id", exact).alias("unique_users"),
            F.sum("duration_seconds").alias("total_watch_time"),
            F.avg("duration_seconds").alias("avg_watch_time"),
        )
        .withColumnRenamed("event_date", "metric_date")
    )


def movie_popularity(
    facts: DataFrame, *, as_of=None, days: int = 7, exact: bool = True
) -> DataFrame:
    """Views, users and mean watch time per movie over the last days."""
    return (
        facts.where(last_days("event_date", days, as_of))
        .groupBy("movie_id")
        .agg(
            F.count("*").alias("total_views"),
            _distinct("user_id", exact).alias("unique_users"),
            F.avg("duration_seconds").alias("avg_watch_time"),
        )
        .withColumn("last_updated", as_of_column(as_of))
    )


def movie_days(facts: DataFrame) -> DataFrame:
    """Per event date and movie: views, watch time, and a sketch of the users.

    Sketches of several movies or dates unite without counting a user twice.
    """
    return facts.groupBy("event_date", "movie_id").agg(
        F.count("*").alias("total_views"),
        F.sum("duration_seconds").alias("total_watch_time"),
        F.count("duration_seconds").alias("n_watched"),
        F.hll_sketch_agg("user_id").alias("users"),
    )


def _united(days) -> DataFrame:
    """Sums and estimated users of grouped movie days."""
    return days.agg(
        F.sum("total_views").alias("total_views"),
        F.hll_sketch_estimate(F.hll_union_agg("users")).alias("unique_users"),
        F.sum("total_watch_time").alias("total_watch_time"),
        (F.sum("total_watch_time") / F.nullif(F.sum("n_watched"), F.lit(0))).alias("avg_watch_time"),
    )


def daily_metrics_of_days(days: DataFrame) -> DataFrame:
    """The columns of ``daily_metrics`` from movie days; users are estimates, within some 2 %."""
    return _united(days.groupBy("event_date")).withColumnRenamed("event_date", "metric_date")


def popularity_of_days(days: DataFrame, *, as_of=None, n_days: int = 7) -> DataFrame:
    """The columns of ``movie_popularity`` from the movie days of the last dates alone."""
    recent = days.where(last_days("event_date", n_days, as_of))
    united = _united(recent.groupBy("movie_id")).drop("total_watch_time")
    return united.withColumn("last_updated", as_of_column(as_of))


def popular_movie(df: DataFrame | None = None, *, arrivals: DataFrame | None = None) -> DataFrame:
    """The most frequent movie id of the whole table, one row.

    A NULL id can win. Ties go to the smallest id, NULL first. ``arrivals``, counts of
    rows in a column ``views``, stands for the table.
    """
    counted, views = (df, F.count("*")) if arrivals is None else (arrivals, F.sum("views"))
    return (
        counted.groupBy("movie_id")
        .agg(views.alias("views"))
        .orderBy(F.col("views").desc(), F.col("movie_id").asc_nulls_first())
        .limit(1)
        .select(F.col("movie_id").alias("popular_movie"))
    )


def business_metrics(
    df: DataFrame,
    *,
    as_of=None,
    time_col: str = "processing_timestamp",
    arrivals: DataFrame | None = None,
) -> DataFrame:
    """One row for the day of as_of; the popular movie is over all days.

    With ``arrivals``, rows counted by day and movie, only that day of ``df`` is read.
    """
    now = as_of_column(as_of)
    return (
        rows_of_day(df, time_col, now)
        .agg(
            F.count("*").alias("total_views"),
            F.count_distinct("user_id").alias("unique_users"),
            F.sum("duration_seconds").alias("total_watch_time"),
            F.avg("duration_seconds").alias("avg_session_duration"),
        )
        .select(
            F.to_date(now).alias("metric_date"),
            "total_views",
            "unique_users",
            "total_watch_time",
            popular_movie(df, arrivals=arrivals).scalar().alias("popular_movie"),
            "avg_session_duration",
            now.alias("calculated_at"),
        )
    )


def latest_business_metrics(metrics: DataFrame) -> DataFrame:
    """The newest stored metric row."""
    return metrics.orderBy(F.col("metric_date").desc()).limit(1)


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n_rows"))


def headline_metrics(df: DataFrame) -> DataFrame:
    """Rows, distinct users and mean duration (0 when there is none), one row."""
    return df.agg(
        F.count("*").cast("double").alias("total_views"),
        F.count_distinct("user_id").cast("double").alias("unique_users"),
        F.coalesce(F.avg("duration_seconds"), F.lit(0.0)).alias("avg_duration"),
    )


def kpi_rows(df: DataFrame) -> DataFrame:
    """The headline metrics as (metric_name, metric_value) rows."""
    names = ["total_views", "unique_users", "avg_duration"]
    return headline_metrics(df).unpivot([], names, "metric_name", "metric_value")


def recent_stats(
    df: DataFrame,
    *,
    as_of=None,
    interval: str = "1 hour",
    time_col: str = "processing_timestamp",
) -> DataFrame:
    """Rows, mean duration and distinct users of the last interval, one row."""
    return rows_within(df, time_col, interval, as_of).agg(
        F.count("*").alias("views"),
        F.avg("duration_seconds").alias("avg_duration"),
        F.count_distinct("user_id").alias("unique_users"),
    )
