"""Streams over several small files, compared with the batch result."""

import json
import random
from datetime import datetime, timedelta

import pytest
from helpers import frame
from pyspark.sql import functions as F

from viewlens import operators as ops
from viewlens import streaming
from viewlens.plans.catalogue import Source
from viewlens.schemas import VIEW_EVENT
from viewlens.sinks import lake_writer, latest_rows, read_arrivals, update_log_writer
from viewlens.sinks.storage import read_note
from viewlens.sources import stream_json_lines

START = datetime(2024, 1, 1)


def event(user, minutes, movie="m1", kind="start", seconds=600, device="mobile"):
    time = (START + timedelta(minutes=minutes)).isoformat(timespec="microseconds")
    return {"user_id": user, "movie_id": movie, "duration_seconds": seconds,
            "event_type": kind, "device": device, "timestamp": time}


@pytest.fixture
def folder(tmp_path):
    """Writes each list of events as one file; later files are later batches."""
    source = tmp_path / "in"
    source.mkdir()

    def put(*batches):
        import os

        for batch in batches:
            number = len(list(source.iterdir()))
            path = source / f"{number:04}.json"
            path.write_text("\n".join(json.dumps(e) for e in batch))
            os.utime(path, (1_700_000_000 + number, 1_700_000_000 + number))
        return str(source)

    return put


def enriched(df):
    return ops.enrich_events(df, processing_time=F.col("timestamp").try_cast("timestamp"))


def batch_of(spark, path):
    return enriched(spark.read.schema(VIEW_EVENT).json(path))


def stream_of(spark, path):
    return enriched(stream_json_lines(spark, path, VIEW_EVENT, max_files_per_trigger=1))


def random_batches(seed, batches=5, size=40):
    rng = random.Random(seed)
    users, movies = ["hot", "hot", "a", "b", None], ["m1", "m1", "m2", None]
    return [
        [
            event(rng.choice(users), 400 * b + rng.uniform(0, 400), rng.choice(movies),
                  rng.choice(["start", "start", "stop"]), rng.choice([None, 10, 4000]),
                  rng.choice(["mobile", "tablet"]))
            for _ in range(size)
        ]
        for b in range(batches)
    ]


@pytest.mark.parametrize("window", ["1 minute", "1 hour", "1 day"])
def test_window_statistics_equal_batch(spark, folder, tmp_path, window):
    path = folder(*random_batches(1))
    for name, stats, keys in [
        ("movie", ops.movie_window_stats, ["window_start", "window_end", "movie_id"]),
        ("device", ops.device_window_stats, ["window_start", "window_end", "device"]),
    ]:
        log = str(tmp_path / name)
        streaming.run_to_end(
            stats(stream_of(spark, path), window=window),
            update_log_writer(log),
            checkpoint=str(tmp_path / f"{name}-checkpoint"),
            mode="update",
        )
        stored = spark.read.parquet(log)
        expected = stats(batch_of(spark, path), window=window)
        assert frame(latest_rows(stored, keys)) == frame(expected)
        if window == "1 day":
            assert stored.count() > expected.count()


def test_late_rows_are_left_out(spark, folder, tmp_path):
    late = event("late", 0)
    path = folder(
        [event("a", 0)], [event("a", 200)], [event("a", 201)], [late, event("a", 202)]
    )
    log = str(tmp_path / "log")
    streaming.run_to_end(
        ops.movie_window_stats(stream_of(spark, path)),
        update_log_writer(log),
        checkpoint=str(tmp_path / "checkpoint"),
        mode="update",
    )
    keys = ["window_start", "window_end", "movie_id"]
    latest = latest_rows(spark.read.parquet(log), keys)
    assert latest.where("window_start = timestamp'2024-01-01'").first()["view_count"] == 1
    assert latest.agg(F.sum("view_count")).first()[0] == 4


def test_retention_gives_closed_days(spark, folder, tmp_path):
    path = folder(*random_batches(2, batches=8, size=30))
    out = str(tmp_path / "out")
    streaming.run_to_end(
        streaming.retention_stream(stream_of(spark, path), watermark="450 minutes"),
        update_log_writer(out),
        checkpoint=str(tmp_path / "checkpoint"),
    )
    closed = ops.retention(batch_of(spark, path)).where("event_date < date'2024-01-02'")
    assert closed.count() == 1
    stored = spark.read.parquet(out).drop("batch_id").where("event_date < date'2024-01-02'")
    assert frame(stored) == frame(closed)


# -- session metrics ----------------------------------------------------------

COLUMNS = ["user_id", "original_timestamp", "session_id", "duration_seconds"]


def run_sessions(spark, path, root, **options):
    writer = streaming.user_metrics_writer(root, delay="30 minutes", **options)
    events = stream_of(spark, path).select(*COLUMNS)
    streaming.run_to_end(events, writer, checkpoint=f"{root}/checkpoint")
    return streaming.user_metrics_result(spark, root)


def disorderly_batches(seed):
    """Batches that overlap by up to 25 minutes."""
    rng = random.Random(seed)
    return [
        [
            event(rng.choice(["hot", "hot", "a", "b", "c", None]),
                  100 * b + rng.choice([0, 5, rng.uniform(0, 125)]), rng.choice(["m1", "m2"]),
                  seconds=rng.randrange(5))
            for _ in range(30)
        ]
        + [event("a", 100 * b + 125)]
        for b in range(5)
    ]


@pytest.mark.parametrize("options", [{}, {"compact_every": 2}])
def test_sessions_equal_batch(spark, folder, tmp_path, options):
    bad = event("a", 1) | {"timestamp": "soon"}
    batches = disorderly_batches(3)
    path = folder([*batches[0], bad], *batches[1:])
    result = run_sessions(spark, path, str(tmp_path / "s"), **options)
    timed = batch_of(spark, path).where("original_timestamp is not null").select(*COLUMNS)
    last = timed.agg(F.max("original_timestamp")).scalar()
    expected = ops.user_metrics(timed).where(
        F.col("original_timestamp") <= last - F.expr("INTERVAL 30 MINUTES")
    )
    assert expected.count() > 90
    assert frame(result) == frame(expected)
    assert result.where("session_seq_number > 1").count() > 0


def test_sessions_continue_in_a_later_run(spark, folder, tmp_path):
    batches = disorderly_batches(4)
    root = str(tmp_path / "s")
    path = folder(*batches[:3])
    run_sessions(spark, path, root)
    folder(*batches[3:])
    result = run_sessions(spark, path, root)
    timed = batch_of(spark, path).select(*COLUMNS)
    last = timed.agg(F.max("original_timestamp")).scalar()
    expected = ops.user_metrics(timed).where(
        F.col("original_timestamp") <= last - F.expr("INTERVAL 30 MINUTES")
    )
    assert frame(result) == frame(expected)


def test_sessions_survive_a_replay_and_count_late_rows(spark, tmp_path):
    root = str(tmp_path / "s")
    write = streaming.user_metrics_writer(root, delay="0 seconds")

    def batch(*rows):
        times = [(u, START + timedelta(minutes=m) if m is not None else None, str(m))
                 for u, m in rows]
        return spark.createDataFrame(
            times, "user_id string, original_timestamp timestamp, session_id string"
        )

    none_yet = batch(("a", None))
    first, second = batch(("a", 0), ("b", 10)), batch(("a", 5), ("a", 70), ("a", 131))
    nothing = second.where("false")
    for number, rows in enumerate(
        [none_yet, none_yet, first, first, second, second, nothing, nothing]
    ):
        write(rows, number // 2)
    result = streaming.user_metrics_result(spark, root).orderBy("user_id", "original_timestamp")
    got = [
        (r["user_id"], r["session_id"], r["time_since_last_event"], r["session_seq_number"])
        for r in result.collect()
    ]
    assert got == [("a", "0", None, 1), ("a", "70", 4200, 2), ("a", "131", 3660, 3),
                   ("b", "10", None, 1)]
    progress = [read_note(spark, f"{root}/progress", n) for n in (0, 2, 4, 6)]
    assert [note["late_rows"] for note in progress] == [0, 0, 1, 0]


def test_flush_gives_out_the_rest_and_the_stream_goes_on(spark, folder, tmp_path):
    batches = disorderly_batches(6)
    root = str(tmp_path / "s")
    path = folder(*batches[:3])
    assert not streaming.flush_user_metrics(spark, root)
    run_sessions(spark, path, root, compact_every=2)
    before = streaming.user_metrics_result(spark, root).count()
    assert streaming.flush_user_metrics(spark, root)
    assert not streaming.flush_user_metrics(spark, root)
    result = streaming.user_metrics_result(spark, root)
    expected = ops.user_metrics(batch_of(spark, path).select(*COLUMNS))
    assert before < result.count() == expected.count() and frame(result) == frame(expected)
    totals = {r["part"]: r["n"] for r in streaming.user_metrics_totals(spark, root).collect()}
    assert totals == {"given_out": 93, "waiting": 0}

    # Rows older than the flushed ones are late now, newer ones continue the sessions.
    last = max(e["timestamp"] for b in batches[:3] for e in b)
    folder([e for e in batches[3] if e["timestamp"] > last] + [event("a", 0)], batches[4])
    result = run_sessions(spark, path, root, compact_every=2)
    streaming.flush_user_metrics(spark, root)
    result = streaming.user_metrics_result(spark, root)
    timely = batch_of(spark, path).where(
        (F.col("original_timestamp") > F.lit(START)) | (F.input_file_name().rlike("0000"))
    )
    assert frame(result) == frame(ops.user_metrics(timely.select(*COLUMNS)))
    totals = {r["part"]: r["n"] for r in streaming.user_metrics_totals(spark, root).collect()}
    assert totals["late"] == 1 and totals["waiting"] == 0


def test_state_is_read_by_bucket(spark, tmp_path):
    from viewlens.streaming.sessions import session_users, with_bucket

    users = session_users(str(tmp_path))
    many = spark.range(3000).selectExpr(
        "concat('u', id) as user_id", "timestamp'2024-01-01' as last_time", "id as last_seq"
    )
    for step in (0, 1):
        users.append(with_bucket(many), step)
        users.compact(spark)
    few = with_bucket(many.where("user_id = 'u7'"))
    state = users.read_partitions(spark, few)
    assert state.where("user_id = 'u7'").first()["last_seq"] == 7
    assert 1 < state.count() < 60
    from helpers import explain

    assert "dynamicpruning" in explain(state)


# -- late rows ----------------------------------------------------------------


def late_batches(seed):
    """Five batches; some rows come two batches after their time."""
    batches = [list(b) for b in random_batches(seed, batches=5)]
    for i in range(3):
        batches[i + 2] += batches[i][::7]
        del batches[i][::7]
    return batches


@pytest.mark.parametrize(
    ("window", "key"), [("1 minute", "movie_id"), ("1 hour", "device"), ("1 day", "movie_id")]
)
def test_statistics_and_late_rows_equal_batch(spark, folder, tmp_path, window, key):
    path = folder(*late_batches(7))
    keys = {"movie_id": ops.movie_window_stats, "device": ops.device_window_stats}
    stats = keys[key]
    totals = streaming.WindowTotals(str(tmp_path / key), key, window=window)
    stream = stream_of(spark, path)
    streaming.run_to_end(stream, totals.writer(compact_every=2), checkpoint=str(tmp_path / f"{key}-c"))
    expected = stats(batch_of(spark, path), window=window)
    on_time = totals.statistics(spark, corrected=False).select(*expected.columns)
    if window != "1 day":
        assert frame(on_time) != frame(expected)
        late = totals.late_rows(spark)
        assert late.count() + totals.on_time.read(spark).agg(F.sum("n_rows")).first()[0] == 200
        assert totals.correct(spark) > 0
    assert totals.correct(spark) == 0
    for _ in range(2):
        assert frame(totals.statistics(spark).select(*expected.columns)) == frame(expected)
        totals.compact(spark)

    # What a stateful query shows without its late rows is the same.
    log = str(tmp_path / f"{key}-log")
    streaming.run_to_end(
        stats(stream_of(spark, path), window=window), update_log_writer(log),
        checkpoint=str(tmp_path / f"{key}-c2"), mode="update",
    )
    latest = latest_rows(spark.read.parquet(log), ["window_start", "window_end", key])
    assert frame(latest) == frame(on_time)


def test_window_totals_survive_a_replay(spark, tmp_path):
    def batch(*minutes):
        rows = [event("a", m) for m in minutes]
        return enriched(spark.createDataFrame([tuple(r.values()) for r in rows], VIEW_EVENT))

    totals = streaming.WindowTotals(str(tmp_path), "movie_id")
    write = totals.writer(compact_every=2)
    for number, rows in enumerate([batch(0, 0), batch(50), batch(50), batch(0, 51), batch(1, 52)]):
        write(rows, number)
        write(rows, number)
        totals.correct(spark)
    assert totals.late_rows(spark).count() == 2
    found = totals.statistics(spark).orderBy("window_start").collect()
    assert [r["view_count"] for r in found] == [3, 1, 2, 1, 1]
    nothing = batch(0).where("false")
    write(nothing, 5)
    assert totals.statistics(spark).count() == 5


def test_retention_with_late_rows(spark, folder, tmp_path):
    path = folder(*late_batches(8))
    starts = streaming.start_totals(str(tmp_path / "t"))
    streaming.run_to_end(stream_of(spark, path), starts.writer(), checkpoint=str(tmp_path / "c"))
    starts.correct(spark)
    expected = ops.retention(batch_of(spark, path))
    assert frame(streaming.retention_of(starts.totals(spark))) == frame(expected)


# -- running queries ----------------------------------------------------------


def test_event_tables_and_restart(spark, folder, tmp_path):
    batches = random_batches(5, batches=4)
    path = folder(*batches[:2])
    tables, checkpoints = str(tmp_path / "tables"), str(tmp_path / "checkpoints")

    def run():
        events = stream_json_lines(spark, path, VIEW_EVENT, max_files_per_trigger=1)
        queries = streaming.start_event_tables(
            events, tables=tables, checkpoints=checkpoints, trigger={"availableNow": True},
            event_tables=["lake", "user_views_processed", "user_views_fact"],
        )
        for query in queries:
            query.awaitTermination()
            assert query.exception() is None

    run()
    assert spark.read.parquet(f"{tables}/user_views_fact").count() == 80
    folder(*batches[2:])
    run()
    for name in ("lake", "user_views_processed"):
        assert read_arrivals(spark, f"{tables}/{name}").count() == 160
    for name in ("movie_stats_realtime", "device_stats_realtime"):
        latest = streaming.statistics_table(f"{tables}/{name}", name).read(spark)
        with_user = sum(e["user_id"] is not None for b in batches for e in b)
        assert latest.agg(F.sum("view_count")).first()[0] == with_user


def test_console_and_stop(spark, folder, tmp_path):
    path = folder([event("a", 0)])
    stream = stream_of(spark, path)
    queries = [
        streaming.start_console(stream),
        streaming.start_console(
            ops.device_window_stats(stream), mode="update", rows=5,
            checkpoint=str(tmp_path / "checkpoint"),
        ),
    ]
    streaming.stop_all(queries, finish=True)
    assert not any(q.isActive for q in queries)
    spark.streams.resetTerminated()
    query = streaming.start(
        stream, lake_writer(str(tmp_path / "lake")), checkpoint=str(tmp_path / "c2"),
        name="lake", trigger={"availableNow": True},
    )
    assert streaming.await_any(spark, 60)
    assert query.name == "lake" and not query.isActive
    assert read_arrivals(spark, str(tmp_path / "lake")).count() == 1


def test_a_table_in_order_of_time_reaches_the_stream_in_many_files(spark, tmp_path):
    """Else one task decodes all of a micro-batch."""
    spark.sql(
        "SELECT id AS event_id, timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, id) AS ts, "
        "id % 9 AS user_id, 'view' AS event_type, 1D AS value, '{\"k\": 1}' AS props FROM range(1000)"
    ).coalesce(1).write.parquet(str(tmp_path / "events.parquet"))
    source = Source(spark, str(tmp_path))
    sizes = []
    root = str(tmp_path / "s")
    source.run_stream(root, lambda views: views, lambda batch, _: sizes.append(batch.count()))
    assert sizes == [200] * 5
    files = spark.read.parquet(f"{root}/arrived").groupBy(F.input_file_name()).count()
    assert files.count() == 5 * spark.sparkContext.defaultParallelism
