"""Window statistics over a stream that lose no late row.

A stateful query drops rows that come after their window was closed, uncounted.
Here each micro-batch adds its own sums and counts per window and key to a layered
table, which merges them, so no state is kept and a batch delivered again
replaces its part. Rows behind the watermark are put in a side table by the
rule of a stateful query: their window had ended by the watermark of the batch before,
which is the latest time of the batches before that one, less the delay. A
correction pass merges them into the closed windows.

on_time            sums and counts by day, window and key
late/batch_id=N    the late rows of batch N, all columns
corrections        sums and counts of late rows, as on_time
progress/N.json     the watermark that batch N leads to
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.metrics import retention_rate
from ..schemas import schema_of
from ..sinks.batches import BatchWriter, kept
from ..sinks.layered import LayeredTable
from ..sinks.storage import complete_numbers, note_numbers, read_note, write_note
from ..sinks.tables import append_run

SUMS = {"n_rows": "sum", "view_count": "sum", "total_watch_time": "sum", "n_watched": "sum"}


@dataclass(frozen=True)
class WindowTotals:
    """Sums and counts per window and ``key``; rows without a time belong to no window."""

    root: str
    key: str
    window: str = "1 minute"
    delay: str = "1 minute"
    time_col: str = "processing_timestamp"
    where: str = "true"

    @property
    def on_time(self) -> LayeredTable:
        return self._table("on_time")

    @property
    def corrections(self) -> LayeredTable:
        return self._table("corrections")

    def _table(self, name: str) -> LayeredTable:
        keys = ("day", "window_start", "window_end", self.key)
        types = {"day": "date", "window_start": "timestamp", "window_end": "timestamp"}
        schema = schema_of(**types, **{self.key: "string"}, **dict.fromkeys(SUMS, "long"))
        return LayeredTable(f"{self.root}/{name}", schema, keys, "day", SUMS)

    def writer(self, compact_every: int = 50) -> BatchWriter:
        """A foreachBatch writer of enriched events."""

        def write(batch: DataFrame, batch_id: int) -> None:
            spark = batch.sparkSession
            closed, passed = self._watermarks(spark, batch_id)
            with kept(batch) as rows:
                rows = rows.where(self.where)
                placed = rows.withColumn("_window", F.window(self.time_col, self.window))
                late = F.lit(False) if closed is None else F.col("_window.end") <= _time(closed)
                reached, late_rows = placed.agg(
                    F.unix_micros(F.max(self.time_col) - F.expr(f"INTERVAL {self.delay}")),
                    F.count_if(late),
                ).first()
                self.on_time.append(self._totals(placed.where(~late)), batch_id)
                if late_rows:
                    side = placed.where(late).drop("_window")
                    append_run(side, f"{self.root}/late", batch_id, key="batch_id")
            known = [t for t in (passed, reached) if t is not None]
            note = {"watermark_micros": max(known, default=None), "late_rows": late_rows}
            write_note(spark, f"{self.root}/progress", batch_id, note)
            if (batch_id + 1) % compact_every == 0:
                self.on_time.compact(spark)
                self.on_time.vacuum(spark)

        return write

    def correct(self, spark: SparkSession) -> int:
        """Merges late rows into their windows; returns how many batches had new ones.

        Each batch of late rows is taken once, also when a pass is made again after a failure.
        """
        now = self.corrections.snapshot(spark)
        done = now.batches[-1] if now.batches else now.through
        found = complete_numbers(spark, f"{self.root}/late", "batch_id")
        new = [n for n in found if n > done]
        if new:
            rows = self._late(spark, new)
            placed = rows.withColumn("_window", F.window(self.time_col, self.window))
            self.corrections.append(self._totals(placed), new[-1])
        return len(new)

    def late_rows(self, spark: SparkSession) -> DataFrame:
        """All rows that came too late, with their batch_id; there must have been one."""
        return self._late(spark, complete_numbers(spark, f"{self.root}/late", "batch_id"))

    def totals(self, spark: SparkSession, *, corrected: bool = True) -> DataFrame:
        """One row per window and key; without ``corrected`` as a stateful query would show."""
        rows = self.on_time.read(spark)
        if corrected:
            rows = rows.unionByName(self.corrections.read(spark))
            sums = [F.sum(c).alias(c) for c in SUMS]
            rows = rows.groupBy("day", "window_start", "window_end", self.key).agg(*sums)
        return rows

    def statistics(self, spark: SparkSession, *, corrected: bool = True) -> DataFrame:
        """The columns of ``movie_window_stats``, for the key of these totals."""
        mean = F.col("total_watch_time") / F.nullif("n_watched", F.lit(0))
        return self.totals(spark, corrected=corrected).select(
            "window_start", "window_end", self.key, "view_count", "total_watch_time",
            mean.alias("avg_watch_time"),
        )

    def compact(self, spark: SparkSession) -> None:
        """Folds both tables and removes their folders that are out of date."""
        for table in (self.on_time, self.corrections):
            table.compact(spark)
            table.vacuum(spark)

    def _late(self, spark: SparkSession, batches: list[int]) -> DataFrame:
        root = f"{self.root}/late"
        paths = [f"{root}/batch_id={n}" for n in batches]
        return spark.read.option("basePath", root).parquet(*paths)

    def _watermarks(self, spark: SparkSession, batch_id: int) -> tuple[int | None, int | None]:
        """The watermarks that the two batches before lead to, the earlier first."""
        folder = f"{self.root}/progress"
        before = [n for n in note_numbers(spark, folder) if n < batch_id][-2:]
        notes = [read_note(spark, folder, n)["watermark_micros"] for n in before]
        return (None, None, *notes)[-2:]

    def _totals(self, placed: DataFrame) -> DataFrame:
        return (
            placed.where("_window is not null")
            .groupBy("_window", self.key)
            .agg(
                F.count("*").alias("n_rows"),
                F.count("user_id").alias("view_count"),
                F.sum("duration_seconds").alias("total_watch_time"),
                F.count("duration_seconds").alias("n_watched"),
            )
            .select(
                F.to_date("_window.start").alias("day"),
                F.col("_window.start").alias("window_start"),
                F.col("_window.end").alias("window_end"),
                self.key,
                *SUMS,
            )
        )


def start_totals(root: str, **options) -> WindowTotals:
    """Start events per day and user, from which retention follows."""
    return WindowTotals(
        root, "user_id", window="1 day", time_col="original_timestamp",
        where="event_type = 'start'", **options,
    )


def retention_of(starts: DataFrame) -> DataFrame:
    """The columns of ``retention`` from totals per day and user."""
    per_day = starts.select(F.col("day").alias("event_date"), F.col("n_rows").alias("daily_starts"))
    return retention_rate(per_day.groupBy("event_date"))


def _time(micros: int) -> Column:
    return F.timestamp_micros(F.lit(micros).cast("long"))
