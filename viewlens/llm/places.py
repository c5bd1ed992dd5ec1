"""Written tables, and the place of each row in an order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: monotonically_increasing_id is the partition above these bits and the row below.
ROW_BITS = 33


def written(df: DataFrame, path: str) -> DataFrame:
    """The rows, read back from a table, so what follows does not make them again."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def sorted_parts(
    df: DataFrame, order: Sequence[str | Column], path: str, ranges: Sequence[Column] | None = None
) -> DataFrame:
    """The rows in order, null first, with the number of their part and of the row in it.

    ``ranges`` may name shorter columns of the same order to cut parts by, since the
    driver gets a sample of them; rows equal in these stay in one part.
    """
    number = F.col("number")
    ordered = df.repartitionByRange(*(ranges or order)).sortWithinPartitions(*order)
    placed = written(ordered.withColumn("number", F.monotonically_increasing_id()), path)
    row = number.bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    return placed.withColumns({"part": F.shiftright(number, ROW_BITS), "row": row}).drop("number")


def places(df: DataFrame, order: Sequence[str | Column], path: str, name: str) -> DataFrame:
    """Adds the place of each row, from 0. The order must tell all rows apart to be the same each time."""
    placed = sorted_parts(df, order, path)
    # One row for each part of the sort, so this window stays small.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy("part").agg(F.count("*").alias("n"))
    starts = starts.withColumn("start", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    joined = placed.join(starts, "part").withColumn(name, F.col("start") + F.col("row"))
    return joined.drop("part", "row", "start")
