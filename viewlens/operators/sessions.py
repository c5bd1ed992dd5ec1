"""Per-user event order: previous event, gap and running session number."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import seconds_between
from .spread import join_on, row_hash, sorted_parts

SLICE_SECONDS = 60
#: Users with at most this many events are not cut into slices.
WHOLE_ROWS = 10_000
DAY_SECONDS = 86_400
#: Day of events without a time, before all others.
NO_DAY = -(1 << 40)
#: A sort compares the leading hash before it opens rows.
SLICE = ["_key", "_who", "_day", "_slot"]


def user_metrics(
    events: DataFrame,
    *,
    gap_seconds: int = 3600,
    time_col: str = "original_timestamp",
    tie_col: str = "session_id",
    slice_seconds: int = SLICE_SECONDS,
    whole_rows: int = WHOLE_ROWS,
    earlier: DataFrame | None = None,
    users: DataFrame | None = None,
) -> DataFrame:
    """Adds prev_event_time, time_since_last_event, is_new_session and
    session_seq_number, over each user's events in time order.

    An event opens a session when the user has no earlier timed event or the gap
    exceeds ``gap_seconds`` whole seconds. Events without a time come first and
    each opens a session; they are ordered by the md5 of ``tie_col``. Equal times
    are ordered by the text in ``tie_col``. Further ties go by a hash of the row,
    so the result does not depend on the input order. ``earlier`` (user_id,
    last_time, last_seq) tells where users stood before these events. ``users`` is
    ``event_counts`` of the events, where the caller has it already.

    Events are shuffled once, by user and time slice; those without a time by user
    and the start of their md5. Users with up to ``whole_rows`` events have one slice.
    For others, such as the NULL user, a slice is no longer than the session gap, so
    only its first event can open a session. So session numbers follow from one
    summary row for each slice, and no task gets all events of a large user.
    """
    time, tie_hash = F.col(time_col), _tie_hash(tie_col)
    users = event_counts(events) if users is None else users
    placed = with_slices(
        events, users, gap_seconds=gap_seconds, time_col=time_col, tie_col=tie_col,
        slice_seconds=slice_seconds, whole_rows=whole_rows,
    )
    in_slice = Window.partitionBy(*SLICE).orderBy(
        time_col, F.when(time.isNull(), tie_hash), tie_col, "_hash"
    )
    numbered = placed.withColumns(
        {"_previous": F.lag(time_col).over(in_slice), "_place": F.row_number().over(in_slice)}
    )
    so_far = in_slice.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inner = F.count_if(seconds_between(time_col, "_previous") > gap_seconds).over(so_far)
    numbered = numbered.withColumn("_inner", inner)
    if earlier is not None:
        earlier = join_on(earlier, users, ["user_id"], "left_semi")
    slices = _slice_starts(placed, time_col, gap_seconds, earlier)
    previous = F.when(time.isNotNull(), F.coalesce("_previous", "_carried"))
    gap = F.col("time_since_last_event")
    within = F.when(time.isNull(), F.col("_place")).otherwise(F.col("_opened") + F.col("_inner"))
    return (
        numbered.join(slices, SLICE)
        .withColumn("prev_event_time", previous)
        .withColumn("time_since_last_event", seconds_between(time_col, "prev_event_time"))
        .withColumn("is_new_session", _opens_session(gap, F.col("prev_event_time"), gap_seconds))
        .withColumn("session_seq_number", F.col("_sessions") + within)
        .select(
            *[F.col(f"`{c}`") for c in events.columns],
            "prev_event_time",
            "time_since_last_event",
            "is_new_session",
            "session_seq_number",
        )
    )


def event_counts(events: DataFrame) -> DataFrame:
    """(user_id, n_events) of the users of these events."""
    return events.groupBy("user_id").agg(F.count("*").alias("n_events"))


def with_slices(
    events: DataFrame,
    users: DataFrame,
    *,
    gap_seconds: int,
    time_col: str,
    tie_col: str,
    slice_seconds: int = SLICE_SECONDS,
    whole_rows: int = WHOLE_ROWS,
) -> DataFrame:
    """The events with the columns of their slice and a hash; ``users`` are their counts."""
    length = max(1, min(slice_seconds, gap_seconds))
    time, seconds = F.col(time_col), F.unix_timestamp(time_col)
    part = F.conv(F.substring(_tie_hash(tie_col), 1, 4), 16, 10).cast("long")
    # A struct equals itself with a NULL inside too, so plain joins keep the NULL user.
    placed = events.withColumns(
        {
            "_key": F.xxhash64("user_id"),
            "_who": F.struct("user_id"),
            "_hash": row_hash(events.columns),
        }
    )
    whole = F.lit(False)
    if whole_rows > 0:
        large = users.where(F.col("n_events") > whole_rows).select(
            F.struct("user_id").alias("_who"), F.lit(True).alias("_large")
        )
        # The list is shorter than the events by that factor, so it can be broadcast.
        placed = placed.join(F.broadcast(large), ["_who"], "left")
        whole = F.col("_large").isNull()
    return placed.withColumns(
        {
            "_day": F.when(time.isNull(), NO_DAY)
            .when(whole, 0)
            .otherwise(F.floor(seconds / DAY_SECONDS)),
            "_slot": F.when(time.isNull(), part)
            .when(whole, 0)
            .otherwise(F.floor(seconds / length)),
        }
    )


def _tie_hash(tie_col: str) -> Column:
    return F.md5(F.coalesce(F.col(tie_col).cast("string"), F.lit("")))


def user_metrics_in_ranges(
    events: DataFrame,
    scratch: str,
    *,
    gap_seconds: int = 3600,
    time_col: str = "original_timestamp",
    tie_col: str = "session_id",
    earlier: DataFrame | None = None,
) -> DataFrame:
    """The result of ``user_metrics`` for users with very many events in one minute.

    The source is read once: its rows are sorted by user, time and tie into ranges of about
    equal size, a table in ``scratch``. A range tells for each of its users the first
    and last time and the sessions opened after the first; what a range inherits follows
    from those summaries, of which a user has no more than there are ranges. So even a
    user with all events in one second is spread.
    """
    time = F.col(time_col)
    tie = F.coalesce(F.col(tie_col).cast("string"), F.lit(""))
    placed = events.withColumns({"_who": F.struct("user_id"), "_hash": row_hash(events.columns)})
    order = [F.col("_who"), time, F.when(time.isNull(), F.md5(tie)), F.col(tie_col), F.col("_hash")]
    rows = sorted_parts(placed, order, f"{scratch}/sorted")
    in_part = Window.partitionBy("_part", "_who").orderBy("_row")
    rows = rows.withColumn("_previous", F.lag(time_col).over(in_part))
    gap = seconds_between(time_col, "_previous")
    inner = F.col("_previous").isNotNull() & (gap > gap_seconds)
    summary = rows.groupBy("_who", "_part").agg(
        F.min(time_col).alias("_first"),
        F.max(time_col).alias("_last"),
        F.count_if(time.isNull() | inner).alias("_inner"),
    )
    if earlier is not None:
        users = placed.select("user_id").distinct()
        before = join_on(earlier, users, ["user_id"], "left_semi").select(
            F.struct("user_id").alias("_who"),
            F.lit(-1).cast("long").alias("_part"),
            F.lit(None).cast("timestamp").alias("_first"),
            F.col("last_time").alias("_last"),
            F.col("last_seq").alias("_inner"),
        )
        summary = summary.unionByName(before)
    over_parts = (
        Window.partitionBy("_who").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    )
    carried = F.col("_carried")
    opens = _opens_session(seconds_between("_first", "_carried"), carried, gap_seconds)
    first = F.when(F.col("_first").isNotNull() & opens, 1).otherwise(0)
    parts = (
        summary.withColumn("_carried", F.max("_last").over(over_parts))
        .withColumn("_opened", F.col("_inner") + first)
        .withColumn("_sessions", F.coalesce(F.sum("_opened").over(over_parts), F.lit(0)))
        .select("_who", "_part", "_carried", "_sessions")
    )
    previous = F.when(time.isNotNull(), F.coalesce("_previous", "_carried"))
    opened = F.sum(F.col("is_new_session").cast("long")).over(in_part)
    return (
        rows.join(parts, ["_who", "_part"])
        .withColumn("prev_event_time", previous)
        .withColumn("time_since_last_event", seconds_between(time_col, "prev_event_time"))
        .withColumn(
            "is_new_session",
            _opens_session(F.col("time_since_last_event"), F.col("prev_event_time"), gap_seconds),
        )
        .withColumn("session_seq_number", F.col("_sessions") + opened)
        .select(
            *[F.col(f"`{c}`") for c in events.columns],
            "prev_event_time",
            "time_since_last_event",
            "is_new_session",
            "session_seq_number",
        )
    )


def _opens_session(gap: Column, previous: Column, gap_seconds: int) -> Column:
    return (gap > gap_seconds) | previous.isNull()


def _slice_starts(
    placed: DataFrame, time_col: str, gap_seconds: int, earlier: DataFrame | None
) -> DataFrame:
    """For each slice the time before it, whether it opens a session, and sessions before it.

    The summary has one row per user and slice with events, made by a partial
    aggregate. Its window holds the slices of a user, no more than the time covered has
    slices, however many the events. A user's only timed slice may open further
    sessions; none comes after it that would count them.
    """
    summary = placed.groupBy(*SLICE).agg(
        F.min(time_col).alias("_first"),
        F.max(time_col).alias("_last"),
        F.count("*").alias("_rows"),
    )
    if earlier is not None:
        # Where a user stood is a slice before all others that holds no event.
        summary = summary.unionByName(
            earlier.select(
                F.xxhash64("user_id").alias("_key"),
                F.struct("user_id").alias("_who"),
                F.lit(NO_DAY).cast("long").alias("_day"),
                F.lit(-1).cast("long").alias("_slot"),
                F.lit(None).cast("timestamp").alias("_first"),
                F.col("last_time").alias("_last"),
                F.col("last_seq").alias("_rows"),
            )
        )
    before = (
        Window.partitionBy("_key", "_who")
        .orderBy("_day", "_slot")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    carried = summary.withColumn("_carried", F.max("_last").over(before))
    opens = _opens_session(seconds_between("_first", "_carried"), F.col("_carried"), gap_seconds)
    opened = F.when(F.col("_first").isNull(), F.col("_rows")).otherwise(opens.cast("long"))
    return (
        carried.withColumn("_opened", opened)
        .withColumn("_sessions", F.coalesce(F.sum("_opened").over(before), F.lit(0)))
        .select(*SLICE, "_carried", "_opened", "_sessions")
    )
