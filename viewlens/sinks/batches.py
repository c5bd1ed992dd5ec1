"""Writers for ``foreachBatch``.

Each returns a function of (batch, batch id). A writer to files puts a batch
under ``batch_id=N`` in overwrite mode, so a batch delivered again replaces
itself.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import ARRIVAL_DATE, with_arrival_date
from ..operators.enrich import fact_columns, processed_columns
from ..schemas import LAKE_CHANGES
from .layered import LayeredTable, event_table
from .tables import append_run

BatchWriter = Callable[[DataFrame, int], None]


@contextmanager
def kept(batch: DataFrame) -> Iterator[DataFrame]:
    """The batch, kept while it is used unless whoever hands it over does that."""
    if batch.is_cached:
        yield batch
        return
    batch.persist()
    try:
        yield batch
    finally:
        batch.unpersist()


def lake_writer(path: str, *, compact_every: int = 50) -> BatchWriter:
    """All columns of enriched events to the lake, by arrival date, and what changed by it.

    ``changes`` counts the rows of each pair of arrival and event date, so a load
    knows which days of the lake hold the events of a date.
    """
    write_events = event_writer(path, with_arrival_date, compact_every=compact_every)
    changes = change_table(path)

    def write(batch: DataFrame, batch_id: int) -> None:
        with kept(batch) as rows:
            pairs = with_arrival_date(rows).groupBy(ARRIVAL_DATE, "event_date")
            changes.append(pairs.agg(F.count("*").alias("n_rows")), batch_id)
            write_events(rows, batch_id)
        if (batch_id + 1) % compact_every == 0:
            changes.compact(batch.sparkSession)
            changes.vacuum(batch.sparkSession)

    return write


def change_table(lake: str) -> LayeredTable:
    """(processing_date, event_date, n_rows) of a lake; the event date may be NULL."""
    keys = (ARRIVAL_DATE, "event_date")
    return LayeredTable(f"{lake}/changes", LAKE_CHANGES, keys, ARRIVAL_DATE, {"n_rows": "sum"})


def processed_writer(path: str, *, compact_every: int = 50) -> BatchWriter:
    """Enriched events to ``user_views_processed``, by arrival date."""
    transform = lambda rows: with_arrival_date(processed_columns(rows))
    return event_writer(path, transform, compact_every=compact_every)


def event_writer(path: str, transform, *, compact_every: int = 50) -> BatchWriter:
    """Events to a layered table without keys, by arrival date; read it through ``read_arrivals``.

    The batch is kept while it is tested and written, so its source is read once.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        with kept(batch) as rows:
            if not rows.isEmpty():
                events = transform(rows)
                table = LayeredTable(path, events.schema, (), ARRIVAL_DATE)
                table.append(events, batch_id)
                if (batch_id + 1) % compact_every == 0:
                    table.compact(spark)
                    table.vacuum(spark)

    return write


def read_arrivals(spark: SparkSession, path: str) -> DataFrame:
    """All rows of a table of events, with their ``processing_date``."""
    return event_table(spark, path, ARRIVAL_DATE).read(spark)


def fact_writer(path: str, *, compact_every: int | None = None) -> BatchWriter:
    """Enriched events to ``user_views_fact``, by event date, a folder for each batch.

    A batch can hold many event dates, so rows are brought together by date
    first; large dates are split again. Rows may lack the date, so the table is
    not folded; an empty batch writes nothing. The batch is kept while it is
    tested and written, so its source is read once.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        with kept(batch) as rows:
            if not rows.isEmpty():
                facts = fact_columns(rows).hint("rebalance", "event_date")
                folder = f"{path}/batch_id={batch_id}"
                facts.write.mode("overwrite").partitionBy("event_date").parquet(folder)

    return write


def update_log_writer(path: str, *, rows_per_file: int = 1_000_000) -> BatchWriter:
    """Rows of a stateful query to a log; read it through ``latest_rows``.

    The batch holds one row per changed group. It is kept while it is tested and
    written, as evaluating it again would run its state update again. Stateful
    queries run without adaptive execution, so the number of files follows from
    the rows of the batch, up to one per shuffle partition.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        with kept(batch) as rows:
            n = rows.count()
            if n:
                most = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
                files = max(1, min(most, math.ceil(n / rows_per_file)))
                append_run(rows.repartition(files), path, batch_id, key="batch_id")

    return write


def layered_writer(
    table: LayeredTable, *, day_of: str = "window_start", rows_per_file: int = 1_000_000,
    compact_every: int = 50,
) -> BatchWriter:
    """Changed rows of a stateful query to a layered table partitioned by ``day``.

    The batch is kept while it is counted and written, as evaluating it again would
    run its state update again. After ``compact_every`` batches the updates are
    folded and folders out of date removed, so readers open days, not batches.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        with kept(batch) as rows:
            n = rows.count()
            if n:
                most = int(spark.conf.get("spark.sql.shuffle.partitions"))
                files = max(1, min(most, math.ceil(n / rows_per_file)))
                table.append(rows.withColumn("day", F.to_date(day_of)), batch_id, files)
        if (batch_id + 1) % compact_every == 0:
            table.compact(spark)
            table.vacuum(spark)

    return write


def fan_out(*writers: BatchWriter) -> BatchWriter:
    """Several writers over one read of the batch.

    The batch is kept for the writers, on disk where memory is short; lost parts
    are read again from the source.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        with kept(batch) as rows:
            for writer in writers:
                writer(rows, batch_id)

    return write
