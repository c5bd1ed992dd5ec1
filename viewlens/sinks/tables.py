"""Parquet tables: keyed replace, appends that survive a replay, declarations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions import as_of_column
from ..schemas import TABLES


def replace_partitions(df: DataFrame, path: str, partition_by: str) -> None:
    """Overwrites the partitions present in df and leaves the others.

    df must hold all rows of those partitions and must not read from path. The
    rebalance splits a large partition over several files and tasks, and keeps
    small ones from being scattered over many.
    """
    (
        df.hint("rebalance", partition_by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition_by)
        .parquet(path)
    )


#: Hidden from readers of the table.
BOUNDS = "_bounds"


def refresh(df: DataFrame, path: str, order_by: str | None = None) -> None:
    """Replaces the whole table; df must not read from path.

    With ``order_by`` the files hold ranges of that column that do not overlap, the
    greatest first, each sorted. So a filter on the column skips files by their own
    statistics, and ``read_top`` skips them by the bounds that are stored beside.
    """
    if not order_by:
        df.write.mode("overwrite").parquet(path)
        return
    order = F.col(order_by).desc()
    df.repartitionByRange(order).sortWithinPartitions(order).write.mode("overwrite").parquet(path)
    bounds = (
        df.sparkSession.read.schema(df.schema).parquet(path)
        .groupBy(F.col("_metadata.file_path").alias("file"))
        .agg(F.min(order_by).alias("least"), F.max(order_by).alias("most"), F.count("*").alias("n"))
    )
    bounds.coalesce(1).write.mode("overwrite").parquet(f"{path}/{BOUNDS}")


def read_top(spark: SparkSession, path: str, order_by: str, n: int, *ties: str) -> DataFrame:
    """The n rows of an ordered table with the greatest values, in order; ties by ``ties``.

    Opens only files that can hold one of them. NULL counts as least.
    """
    bounds = spark.read.parquet(f"{path}/{BOUNDS}").collect()  # one row a file
    bounds.sort(key=lambda b: (b["most"] is not None, b["most"], b["least"]), reverse=True)
    files, rows, cutoff = [], 0, None
    for b in bounds:
        if rows >= n and (cutoff is not None and (b["most"] is None or b["most"] < cutoff)):
            break
        if rows < n:
            cutoff = b["least"]
        files.append(b["file"])
        rows += b["n"]
    schema = spark.read.parquet(path).schema
    found = spark.read.schema(schema).parquet(*files) if files else spark.createDataFrame([], schema)
    return found.orderBy(F.col(order_by).desc(), *ties).limit(n)


def append_run(df: DataFrame, path: str, run_id: str | int, key: str = "run_id") -> None:
    """Adds rows under ``key=run_id``; the same run again replaces its own rows."""
    df.write.mode("overwrite").parquet(f"{path}/{key}={run_id}")


def latest_rows(log: DataFrame, keys: Sequence[str], version: str = "batch_id") -> DataFrame:
    """The row of the greatest version per key, from a log of updates.

    Aggregated partially before the shuffle, so a key with many updates stays
    cheap; one aggregate per column lets numbers use a hash aggregate. A filter
    on a key column reaches the scan of the log.
    """
    values = [c for c in log.columns if c not in {*keys, version}]
    return log.groupBy(*keys).agg(*[F.max_by(c, version).alias(c) for c in values])


def create_table(
    spark: SparkSession,
    name: str,
    *,
    schema: StructType | None = None,
    path: str | None = None,
    partition_by: Sequence[str] = (),
) -> None:
    """Declares a Parquet table unless it exists; the schema defaults by name."""
    schema = schema or TABLES[name]
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    statement = f"CREATE TABLE IF NOT EXISTS {_quoted(name)} ({columns}) USING parquet"
    if partition_by:
        statement += f" PARTITIONED BY ({', '.join(map(_quoted, partition_by))})"
    if path:
        escaped = path.replace("\\", "\\\\").replace("'", "\\'")
        statement += f" LOCATION '{escaped}'"
    spark.sql(statement)


def _quoted(name: str) -> str:
    return ".".join(f"`{part.replace('`', '``')}`" for part in name.split("."))


def with_created_at(df: DataFrame, *, as_of=None, column: str = "created_at") -> DataFrame:
    """Fills the default time column of a table."""
    return df.withColumn(column, as_of_column(as_of))


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Columns in table order and of table type."""
    return df.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields])
