"""Per-user session metrics over a stream.

A user's events must be taken in time order, so an event is only given out once
the stream has moved past it by a delay. The state between micro-batches is kept
in tables instead of a keyed operator: a keyed operator would put all events of
one user into one task, while here each step is an ordinary batch plan that
shuffles events by user and time slice.

Work is counted in steps: batch N is step 2N, and a flush after it, which gives
out all that waits, step 2N + 1. Tables under the given root, each written so that
a step made again replaces its own output:

waiting/slot=N%2   events not given out yet, plus those of batch N
metrics/step=S     the result
users              last time and session number per user, a layered table in hashed
                   buckets, of which a step reads those of its users
apart/step=S       events without a time and late ones, with the reason
progress/S.json    the time up to which events are given out
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.sessions import event_counts, user_metrics
from ..schemas import SESSION_USERS
from ..sinks.batches import BatchWriter, kept
from ..sinks.layered import LayeredTable
from ..sinks.storage import note_numbers, read_note, write_note
from ..sinks.tables import append_run

#: Fixed for a root: a user's bucket must stay the same.
BUCKETS = 64
STEP = "step"


def session_users(root: str) -> LayeredTable:
    """Where each user of the stream stands."""
    merge = {"last_time": "max", "last_seq": "max"}
    return LayeredTable(f"{root}/users", SESSION_USERS, ("bucket", "user_id"), "bucket", merge)


def with_bucket(df: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    return df.withColumn("bucket", F.pmod(F.xxhash64("user_id"), F.lit(buckets)).cast("int"))


def user_metrics_writer(
    root: str,
    *,
    delay: str = "1 minute",
    gap_seconds: int = 3600,
    time_col: str = "original_timestamp",
    tie_col: str = "session_id",
    compact_every: int = 50,
) -> BatchWriter:
    """A foreachBatch writer that adds the columns of ``user_metrics``.

    Events without a time, and events older than what was given out, get no
    session; they are kept apart and counted. ``root`` belongs to one checkpoint.
    After ``compact_every`` batches the users' states are folded, and folders out
    of date removed.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        passed = _horizon(spark, root, 2 * batch_id)
        horizon, late_rows, untimed_rows = _store_waiting(spark, batch, batch_id, passed)
        waiting = _waiting(spark, root, batch_id, batch.schema)
        _give_out(
            waiting.where(F.col(time_col) <= _time(horizon)), root, 2 * batch_id,
            gap_seconds=gap_seconds, time_col=time_col, tie_col=tie_col,
        )
        counts = {"late_rows": late_rows, "untimed_rows": untimed_rows}
        write_note(spark, f"{root}/progress", 2 * batch_id, {"horizon_micros": horizon} | counts)
        if (batch_id + 1) % compact_every == 0:
            session_users(root).compact(spark, before=2 * batch_id)
            session_users(root).vacuum(spark)

    def _store_waiting(spark, batch, batch_id, passed):
        """Stores the open events and those apart; returns the new horizon and counts."""
        kept = batch.persist()
        seen = Observation(f"batch-{batch_id}")
        time = F.col(time_col)
        is_late = F.lit(False) if passed is None else F.coalesce(time <= _time(passed), F.lit(False))
        try:
            reason = F.when(time.isNull(), "untimed").when(is_late, "late")
            apart = kept.withColumn("reason", reason).where("reason is not null")
            append_run(apart, f"{root}/apart", 2 * batch_id, key=STEP)
            fresh = kept.observe(
                seen,
                F.unix_micros(F.max(time) - F.expr(f"INTERVAL {delay}")).alias("reached"),
                F.count_if(is_late).alias("late_rows"),
                F.count_if(time.isNull()).alias("untimed_rows"),
            ).where(time.isNotNull() & ~is_late)
            if batch_id > 0:
                before = _waiting(spark, root, batch_id - 1, batch.schema)
                if passed is not None:
                    before = before.where(time > _time(passed))
                fresh = before.unionByName(fresh)
            fresh.write.mode("overwrite").parquet(f"{root}/waiting/slot={batch_id % 2}")
        finally:
            kept.unpersist()
        reached = [t for t in (passed, seen.get["reached"]) if t is not None]
        return max(reached, default=None), seen.get["late_rows"], seen.get["untimed_rows"]

    return write


def flush_user_metrics(
    spark: SparkSession,
    root: str,
    *,
    gap_seconds: int = 3600,
    time_col: str = "original_timestamp",
    tie_col: str = "session_id",
) -> bool:
    """Gives out the events that still wait after the stream has stopped.

    Takes the settings of the writer. False when nothing has run or nothing waits. A
    flush made again changes nothing. The stream may go on afterwards: what comes
    in then and is not newer than the flushed events counts as late.
    """
    steps = note_numbers(spark, f"{root}/progress")
    if not steps or steps[-1] % 2:
        return False
    last = steps[-1]
    waiting = spark.read.parquet(f"{root}/waiting/slot={last // 2 % 2}")
    passed = _horizon(spark, root, last + 1)
    if passed is not None:
        waiting = waiting.where(F.col(time_col) > _time(passed))
    reached = waiting.agg(F.unix_micros(F.max(time_col))).first()[0]
    if reached is None:
        return False
    _give_out(
        waiting, root, last + 1, gap_seconds=gap_seconds, time_col=time_col, tie_col=tie_col
    )
    write_note(spark, f"{root}/progress", last + 1, {"horizon_micros": reached})
    return True


def user_metrics_result(spark: SparkSession, root: str) -> DataFrame:
    """All rows given out so far."""
    return spark.read.parquet(f"{root}/metrics").drop(STEP)


def user_metrics_totals(spark: SparkSession, root: str) -> DataFrame:
    """Where the events of a stopped stream are: (part, n) for given_out, waiting, untimed, late.

    The numbers add up to the events read.
    """
    last = note_numbers(spark, f"{root}/progress")[-1]
    metrics = spark.read.parquet(f"{root}/metrics")
    waiting = 0
    if last % 2 == 0:
        waiting = spark.read.parquet(f"{root}/waiting/slot={last // 2 % 2}").count()
        waiting -= metrics.where(F.col(STEP) == last).count()
    apart = spark.read.parquet(f"{root}/apart").groupBy("reason").agg(F.count("*").alias("n"))
    return metrics.agg(F.lit("given_out").alias("part"), F.count("*").alias("n")).unionByName(
        spark.createDataFrame([("waiting", waiting)], "part string, n long")
    ).unionByName(apart.withColumnRenamed("reason", "part"))


def _give_out(ready: DataFrame, root: str, step: int, **options) -> None:
    """Writes the metrics of a step's events and where their users now stand."""
    spark, users = ready.sparkSession, session_users(root)
    with kept(event_counts(ready)) as counts:
        known = users.read_partitions(spark, with_bucket(counts), before=step).drop("bucket")
        metrics = user_metrics(ready, earlier=known, users=counts, **options)
        append_run(metrics, f"{root}/metrics", step, key=STEP)
    written = spark.read.schema(metrics.schema).parquet(f"{root}/metrics/{STEP}={step}")
    seen = written.groupBy("user_id").agg(
        F.max(options["time_col"]).alias("last_time"), F.max("session_seq_number").alias("last_seq")
    )
    users.append(with_bucket(seen), step)


def _time(micros: int | None) -> Column:
    return F.timestamp_micros(F.lit(micros).cast("long"))


def _waiting(spark: SparkSession, root: str, batch_id: int, schema: StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(f"{root}/waiting/slot={batch_id % 2}")


def _horizon(spark: SparkSession, root: str, step: int) -> int | None:
    """The one value stored by the last step before; None when no event had a time yet."""
    before = [s for s in note_numbers(spark, f"{root}/progress") if s < step]
    return read_note(spark, f"{root}/progress", before[-1])["horizon_micros"] if before else None
