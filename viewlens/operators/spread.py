"""Helpers that keep large groups spread over many tasks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: monotonically_increasing_id is the partition above these bits and the row below.
ROW_BITS = 33


def join_on(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on the keys where NULL matches NULL; keys are kept once."""
    renamed = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    condition = None
    for k in keys:
        part = F.col(k).eqNullSafe(F.col(f"_right_{k}"))
        condition = part if condition is None else condition & part
    joined = left.join(renamed, condition, how)
    if how in ("left_semi", "left_anti"):
        return joined
    return joined.select(*left.columns, *[c for c in right.columns if c not in keys])


def row_hash(columns: Sequence[str]) -> Column:
    """Hash of a row; a NULL in another column gives another hash."""
    return F.xxhash64(*columns, *[F.col(c).isNull() for c in columns])


def sum_before(
    df: DataFrame, group: Sequence[str], levels: Sequence[str], value: Column | str, name: str
) -> DataFrame:
    """Adds the sum of ``value`` over all earlier rows of the group.

    Rows are ordered by ``levels`` from left to right and must differ in them.
    Each window holds one value of all levels but the last, so no task gets a
    whole group: totals of the outer levels are carried in by a join.
    """
    outer = list(levels[:-1])
    ordered = (
        Window.partitionBy(*group, *outer)
        .orderBy(levels[-1])
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    inner = df.withColumn(name, F.coalesce(F.sum(value).over(ordered), F.lit(0)))
    if not outer:
        return inner
    base = f"_base_{len(outer)}"
    totals = df.groupBy(*group, *outer).agg(F.sum(value).alias("_total"))
    carried = sum_before(totals, group, outer, "_total", base).drop("_total")
    return (
        join_on(inner, carried, [*group, *outer])
        .withColumn(name, F.col(name) + F.col(base))
        .drop(base)
    )


def sorted_parts(df: DataFrame, order: Sequence[Column], path: str) -> DataFrame:
    """The rows in order, null first, as a written table with ``_part`` and ``_row`` in it.

    Parts are ranges of about equal size whatever values are frequent, as long as
    ``order`` tells rows apart.
    """
    ordered = df.repartitionByRange(*order).sortWithinPartitions(*order)
    numbered = ordered.withColumn("_number", F.monotonically_increasing_id())
    numbered.write.mode("overwrite").parquet(path)
    stored = df.sparkSession.read.schema(numbered.schema).parquet(path)
    number = F.col("_number")
    row = number.bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    return stored.withColumns({"_part": F.shiftright(number, ROW_BITS), "_row": row}).drop("_number")
