"""Quality checks, alerts and table verification."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import as_of_column, micros_between, percent_or_null, rows_within, within
from .metrics import recent_stats

TIME = "processing_timestamp"

# Threshold and time span of each check, and the alert it raises.
NULL_IDS, LATENCY, VIEW_DROP = "null_ids", "latency", "view_drop"
THRESHOLDS = {NULL_IDS: 10.0, LATENCY: 300.0, VIEW_DROP: 50.0}
SPANS = {NULL_IDS: "1 hour", LATENCY: "30 minutes", VIEW_DROP: "2 hours"}
ALERT_TYPES = {
    NULL_IDS: "Data Quality Alert",
    LATENCY: "Performance Alert",
    VIEW_DROP: "Business Alert",
}
MESSAGES = {
    NULL_IDS: "Found %.0f records with null values in the last hour",
    LATENCY: "High processing latency: %.2f seconds",
    VIEW_DROP: "Significant drop in views: %.1f%%",
}


def _check(name: str, value: Column, threshold: float) -> Column:
    value = value.cast("double")
    return F.struct(
        F.lit(name).alias("check"),
        value.alias("value"),
        F.lit(float(threshold)).alias("threshold"),
        F.coalesce(value > threshold, F.lit(False)).alias("fired"),
    )


def _missing_id() -> Column:
    return F.col("user_id").isNull() | F.col("movie_id").isNull()


def _mean_seconds(micros: Column) -> Column:
    # Whole microseconds add up exactly, whatever the order of the rows.
    return F.sum(micros) / F.lit(1e6) / F.count(micros)


def null_id_check(
    df: DataFrame,
    *,
    as_of=None,
    interval: str = SPANS[NULL_IDS],
    threshold: float = THRESHOLDS[NULL_IDS],
) -> DataFrame:
    """Recent rows without a user or a movie, one row (check, value, threshold, fired)."""
    counted = rows_within(df, TIME, interval, as_of).agg(F.count_if(_missing_id()).alias("v"))
    return counted.select(_check(NULL_IDS, F.col("v"), threshold).alias("c")).select("c.*")


def latency_check(
    df: DataFrame,
    *,
    as_of=None,
    interval: str = SPANS[LATENCY],
    threshold: float = THRESHOLDS[LATENCY],
) -> DataFrame:
    """Mean seconds from event to processing, one row."""
    micros = micros_between(TIME, "original_timestamp")
    mean = rows_within(df, TIME, interval, as_of).agg(_mean_seconds(micros).alias("v"))
    return mean.select(_check(LATENCY, F.col("v"), threshold).alias("c")).select("c.*")


def view_drop_check(
    df: DataFrame,
    *,
    as_of=None,
    interval: str = SPANS[VIEW_DROP],
    threshold: float = THRESHOLDS[VIEW_DROP],
) -> DataFrame:
    """Percentage between the largest and smallest hourly count, one row."""
    drop = (
        rows_within(df, TIME, interval, as_of)
        .groupBy(F.date_trunc("hour", TIME).alias("hour"))
        .agg(F.count("*").alias("n"))
        .agg(F.max("n").alias("most"), F.min("n").alias("least"))
        .select(percent_or_null(F.col("most") - F.col("least"), "most").alias("v"))
    )
    return drop.select(_check(VIEW_DROP, F.col("v"), threshold).alias("c")).select("c.*")


def monitor_checks(
    df: DataFrame, *, as_of=None, thresholds: dict[str, float] | None = None
) -> DataFrame:
    """All three checks from one scan of the last two hours, one row each."""
    limits = THRESHOLDS | (thresholds or {})
    now = as_of_column(as_of)
    micros = F.when(within(TIME, SPANS[LATENCY], now), micros_between(TIME, "original_timestamp"))
    totals = (
        rows_within(df, TIME, SPANS[VIEW_DROP], now)
        .withColumns(
            {
                "_missing": _missing_id() & within(TIME, SPANS[NULL_IDS], now),
                "_micros": micros,
            }
        )
        .groupBy(F.date_trunc("hour", TIME).alias("hour"))
        .agg(
            F.count("*").alias("n"),
            F.count_if("_missing").alias("missing"),
            F.sum("_micros").alias("micros"),
            F.count("_micros").alias("timed"),
        )
        .agg(
            F.coalesce(F.sum("missing"), F.lit(0)).alias("missing"),
            (F.sum("micros") / F.lit(1e6) / F.nullif(F.sum("timed"), F.lit(0))).alias("latency"),
            F.max("n").alias("most"),
            F.min("n").alias("least"),
        )
    )
    drop = percent_or_null(F.col("most") - F.col("least"), "most")
    return totals.select(
        F.inline(
            F.array(
                _check(NULL_IDS, F.col("missing"), limits[NULL_IDS]),
                _check(LATENCY, F.col("latency"), limits[LATENCY]),
                _check(VIEW_DROP, drop, limits[VIEW_DROP]),
            )
        )
    )


def alerts(
    df: DataFrame, *, as_of=None, thresholds: dict[str, float] | None = None
) -> DataFrame:
    """One row per fired check: alert_type, message, severity, created_at."""
    now = as_of_column(as_of)
    fired = monitor_checks(df, as_of=now, thresholds=thresholds).where("fired")

    def by_check(values: dict[str, Column]) -> Column:
        return F.coalesce(*[F.when(F.col("check") == k, v) for k, v in values.items()])

    return fired.select(
        by_check({k: F.lit(v) for k, v in ALERT_TYPES.items()}).alias("alert_type"),
        by_check({k: F.format_string(v, "value") for k, v in MESSAGES.items()}).alias("message"),
        F.lit("high").alias("severity"),
        now.alias("created_at"),
    )


def verify_tables(tables: dict[str, DataFrame], *, time_cols: dict[str, str]) -> DataFrame:
    """Row count, newest time and non-emptiness per table, one row each.

    A table without an entry in ``time_cols`` has no newest time.
    """

    def verify(name: str, df: DataFrame) -> DataFrame:
        newest = F.max(time_cols[name]) if name in time_cols else F.lit(None)
        return df.agg(
            F.lit(name).alias("table_name"),
            F.count("*").alias("n_rows"),
            newest.cast("timestamp").alias("latest"),
            (F.count("*") > 0).alias("ok"),
        )

    return reduce(DataFrame.unionByName, [verify(n, df) for n, df in tables.items()])


def require_tables(tables: dict[str, DataFrame], *, time_cols: dict[str, str]) -> DataFrame:
    """The rows of verify_tables, computed once; raises when a table is empty."""
    verified = verify_tables(tables, time_cols=time_cols)
    rows = verified.collect()  # one row a table
    empty = [r["table_name"] for r in rows if not r["ok"]]
    if empty:
        raise ValueError(f"empty tables: {', '.join(sorted(empty))}")
    return verified.sparkSession.createDataFrame(rows, verified.schema)


def load_summary(df: DataFrame) -> DataFrame:
    """Rows, distinct users and distinct movies in one pass, one row."""
    return df.agg(
        F.count("*").alias("total_records"),
        F.count_distinct("user_id").alias("unique_users"),
        F.count_distinct("movie_id").alias("unique_movies"),
    )


def hourly_summary(df: DataFrame, *, as_of=None, interval: str = "1 hour") -> DataFrame:
    """Total rows beside the count, mean duration and users of the last hour.

    The total needs no column, and the rest reads the last hour only.
    """
    total = df.agg(F.count("*")).scalar()
    return recent_stats(df, as_of=as_of, interval=interval).select(
        total.alias("total_rows"), "views", "avg_duration", "unique_users"
    )
