"""The batch jobs: fact load with rollups, reports, metric rows and monitoring."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import ARRIVAL_DATE, ARRIVAL_TIME, rows_within, with_arrival_date
from ..operators import (
    alerts,
    business_metrics,
    daily_metrics,
    daily_metrics_of_days,
    fact_columns,
    kpi_rows,
    movie_days,
    movie_popularity,
    popularity_of_days,
    report_document,
    top_movies,
)
from ..schemas import (
    BUSINESS_METRICS,
    DAILY_METRICS,
    MOVIE_ARRIVALS,
    MOVIE_DAILY,
    MOVIE_POPULARITY,
    USER_VIEWS_FACT,
)
from ..session import scratch_dir
from ..sinks import (
    append_run,
    conform,
    refresh,
    replace_partitions,
    save_report,
    with_created_at,
)
from ..sinks.storage import folders

UNDATED = "user_views_undated"


def affected_dates(enriched: DataFrame, *, as_of=None, interval: str = "1 day") -> DataFrame:
    """(event_date, processing_date) of the rows processed in the last interval, once each.

    Rows without an event date are there with NULL.
    """
    recent = rows_within(enriched, ARRIVAL_TIME, interval, as_of)
    return recent.select("event_date", F.to_date(ARRIVAL_TIME).alias(ARRIVAL_DATE)).distinct()


def on_dates(df: DataFrame, dates: DataFrame) -> DataFrame:
    """Rows whose event date occurs in ``dates``; a scan partitioned by it reads no others."""
    known = dates.where(F.col("event_date") > F.lit("0001-01-01").cast("date"))
    return df.join(known.select("event_date").distinct(), "event_date", "left_semi")


def load_facts(
    enriched: DataFrame, tables: str, affected: DataFrame, changes: DataFrame | None = None
) -> None:
    """Replaces the facts of the affected event dates with their full rows.

    ``changes`` pairs event dates with arrival dates, as the lake's change table
    does; with it only those arrival dates of the lake are read. Rows without an event
    date have a table of their own, by arrival date, of which the affected days are replaced.
    A repeated load therefore leaves one copy of each row.
    """
    dated = enriched
    if changes is not None:
        holding = on_dates(changes, affected).where(F.col("n_rows") > 0)
        dated = enriched.join(holding.select(ARRIVAL_DATE).distinct(), ARRIVAL_DATE, "left_semi")
    replace_partitions(
        fact_columns(on_dates(dated, affected)), f"{tables}/user_views_fact", "event_date"
    )
    undated = enriched.where("event_date IS NULL")
    if ARRIVAL_DATE not in undated.columns:
        undated = with_arrival_date(undated)
    days = affected.where(f"event_date IS NULL AND {ARRIVAL_DATE} > date'0001-01-01'")
    undated = undated.join(days.select(ARRIVAL_DATE).distinct(), ARRIVAL_DATE, "left_semi")
    arrived = F.col(ARRIVAL_DATE)
    rows = fact_columns(undated.withColumn("_arrived", arrived), keep=("_arrived",))
    replace_partitions(
        rows.withColumnRenamed("_arrived", ARRIVAL_DATE), f"{tables}/{UNDATED}", ARRIVAL_DATE
    )


def read_facts(spark: SparkSession, tables: str, *, undated: bool = False) -> DataFrame:
    """The fact table; with ``undated`` also the rows without an event date."""
    facts = spark.read.schema(USER_VIEWS_FACT).parquet(f"{tables}/user_views_fact")
    if undated:
        more = spark.read.schema(USER_VIEWS_FACT).parquet(f"{tables}/{UNDATED}")
        facts = facts.unionByName(more.drop(ARRIVAL_DATE))
    return facts


def refresh_movie_days(facts: DataFrame, tables: str, affected: DataFrame) -> DataFrame:
    """Replaces the affected dates of ``movie_daily``; returns the table."""
    path = f"{tables}/movie_daily"
    rows = conform(movie_days(on_dates(facts, affected)), MOVIE_DAILY)
    replace_partitions(rows, path, "event_date")
    return facts.sparkSession.read.schema(MOVIE_DAILY).parquet(path)


def daily_rollup(
    enriched: DataFrame,
    *,
    tables: str,
    as_of=None,
    interval: str = "1 day",
    exact: bool = True,
    changes: DataFrame | None = None,
) -> bool:
    """Loads recent events into the fact table and refreshes both rollups.

    Returns False, with nothing written, when there are no recent events. The
    affected dates of ``movie_daily``, which keeps a sketch of the users of each movie
    and date, are refreshed as well. With ``exact`` off both rollups come from it,
    so no other facts are read.
    """
    spark = enriched.sparkSession
    path = scratch_dir(spark, "affected")
    affected = affected_dates(enriched, as_of=as_of, interval=interval)
    affected.write.mode("overwrite").parquet(path)
    affected = spark.read.schema(affected.schema).parquet(path)
    if affected.isEmpty():
        return False
    load_facts(enriched, tables, affected, changes)
    facts = read_facts(spark, tables)
    days = refresh_movie_days(facts, tables, affected)
    if exact:
        daily = daily_metrics(on_dates(facts, affected))
        popularity = movie_popularity(facts, as_of=as_of)
    else:
        daily = daily_metrics_of_days(on_dates(days, affected))
        popularity = popularity_of_days(days, as_of=as_of)
    replace_partitions(conform(daily, DAILY_METRICS), f"{tables}/daily_metrics", "metric_date")
    refresh(
        conform(popularity, MOVIE_POPULARITY), f"{tables}/movie_popularity", order_by="total_views"
    )
    return True


def refresh_movie_arrivals(processed: DataFrame, path: str) -> DataFrame:
    """Counts the rows of each movie by arrival date; returns (processing_date, movie_id, views).

    Only the last date counted before and later ones are counted again, as rows
    arrive at the present time. Give ``processed`` with its ``processing_date``.
    """
    spark = processed.sparkSession
    stored = None
    if folders(spark, path):
        stored = spark.read.schema(MOVIE_ARRIVALS).parquet(path)
        since = stored.agg(F.max(ARRIVAL_DATE)).first()[0]
        processed = processed.where(F.col(ARRIVAL_DATE) >= F.lit(since))
    counted = processed.groupBy(ARRIVAL_DATE, "movie_id").agg(F.count("*").alias("views"))
    replace_partitions(conform(counted, MOVIE_ARRIVALS), path, ARRIVAL_DATE)
    return spark.read.schema(MOVIE_ARRIVALS).parquet(path)


def update_business_metrics(
    processed: DataFrame, path: str, *, as_of=None, arrivals: str | None = None
) -> None:
    """Inserts or replaces the row of the day of as_of.

    With ``arrivals``, a path, the popular movie comes from counts kept there, so the
    history of ``processed`` is read once, not at every refresh.
    """
    counts = refresh_movie_arrivals(processed, arrivals) if arrivals else None
    row = conform(business_metrics(processed, as_of=as_of, arrivals=counts), BUSINESS_METRICS)
    replace_partitions(row, path, "metric_date")


def append_kpis(views: DataFrame, path: str, *, run_id: str | int, as_of=None) -> None:
    """Appends the three headline metrics of this run."""
    rows = with_created_at(kpi_rows(views), as_of=as_of, column="calculated_at")
    append_run(rows, path, run_id)


def daily_report(processed: DataFrame, path: str, *, as_of=None, n: int = 10) -> None:
    """Saves the top movies since the previous midnight as one JSON document."""
    save_report(report_document(top_movies(processed, as_of=as_of, n=n), as_of=as_of), path)


def monitor_once(
    processed: DataFrame,
    path: str,
    *,
    run_id: str | int,
    as_of=None,
    thresholds: dict[str, float] | None = None,
) -> None:
    """Runs the checks once and appends the alerts they raise."""
    append_run(alerts(processed, as_of=as_of, thresholds=thresholds), path, run_id)
