"""Time predicates.

Each compares the bare column with a value that does not depend on the row, so
the predicate reaches the scan as a pushed filter or prunes partitions. The
functions that take a DataFrame also bound its arrival date, by which stored
event tables are partitioned, so older days are not opened.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .columns import ColumnOrName, as_of_column, col


ARRIVAL_TIME = "processing_timestamp"
ARRIVAL_DATE = "processing_date"


def with_arrival_date(df: DataFrame) -> DataFrame:
    return df.withColumn(ARRIVAL_DATE, F.to_date(ARRIVAL_TIME))


def _bounded(
    df: DataFrame, time_col: str, predicate: Column, start: Column, end: Column
) -> DataFrame:
    if time_col == ARRIVAL_TIME and ARRIVAL_DATE in df.columns:
        df = df.where(F.col(ARRIVAL_DATE).between(F.to_date(start), F.to_date(end)))
    return df.where(predicate)


def within(time: ColumnOrName, interval: str, as_of=None) -> Column:
    """From as_of - interval to as_of, both included, e.g. ``within("ts", "30 minutes")``."""
    now = as_of_column(as_of)
    return (col(time) >= now - F.expr(f"INTERVAL {interval}")) & (col(time) <= now)


def since_previous_midnight(time: ColumnOrName, as_of=None) -> Column:
    """From the start of the day before as_of to as_of."""
    now = as_of_column(as_of)
    return (col(time) >= F.date_sub(F.to_date(now), 1).cast("timestamp")) & (col(time) <= now)


def same_day(time: ColumnOrName, as_of=None) -> Column:
    """On the calendar day of as_of, as a half-open range."""
    day = F.to_date(as_of_column(as_of))
    return (col(time) >= day.cast("timestamp")) & (
        col(time) < F.date_add(day, 1).cast("timestamp")
    )


def last_days(date: ColumnOrName, days: int, as_of=None) -> Column:
    """From the day of as_of - days to the day of as_of, over a date column."""
    today = F.to_date(as_of_column(as_of))
    return col(date).between(F.date_sub(today, days), today)


def rows_within(df: DataFrame, time_col: str, interval: str, as_of=None) -> DataFrame:
    now = as_of_column(as_of)
    start = now - F.expr(f"INTERVAL {interval}")
    return _bounded(df, time_col, within(time_col, interval, now), start, now)


def rows_since_previous_midnight(df: DataFrame, time_col: str, as_of=None) -> DataFrame:
    now = as_of_column(as_of)
    start = F.date_sub(F.to_date(now), 1)
    return _bounded(df, time_col, since_previous_midnight(time_col, now), start, now)


def rows_of_day(df: DataFrame, time_col: str, as_of=None) -> DataFrame:
    now = as_of_column(as_of)
    return _bounded(df, time_col, same_day(time_col, now), now, now)
