"""Database tables over JDBC."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..functions import rows_within
from ..schemas import USER_VIEWS_FACT


def jdbc_options(
    url: str, table: str, *, driver: str | None = None, user: str | None = None,
    password: str | None = None,
) -> dict[str, str]:
    given = {"url": url, "dbtable": table, "driver": driver, "user": user, "password": password}
    return {k: v for k, v in given.items() if v is not None}


def partition_options(column: str, lower: str, upper: str, partitions: int) -> dict[str, str]:
    """Splits a read into ranges of a numeric, date or timestamp column."""
    return {
        "partitionColumn": column,
        "lowerBound": lower,
        "upperBound": upper,
        "numPartitions": str(partitions),
    }


def jdbc_table(
    spark: SparkSession, connection: dict[str, str], partitions: dict[str, str] | None = None
) -> DataFrame:
    """A table as a DataFrame; filters and column choices run in the database.

    Without ``partitions`` the table is read by one task over one connection, so
    give them for anything large.
    """
    return spark.read.format("jdbc").options(**connection, **(partitions or {})).load()


def recent_processed_views(table: DataFrame, *, as_of=None, interval: str = "1 day") -> DataFrame:
    """The columns a fact load needs, from the last interval of processing."""
    source = {"event_timestamp": "original_timestamp"}
    columns = [source.get(c, c) for c in USER_VIEWS_FACT.fieldNames() if c != "event_date"]
    return rows_within(table, "processing_timestamp", interval, as_of).select(*columns)
