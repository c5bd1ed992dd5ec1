"""Session metrics against a plain loop."""

import hashlib
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from viewlens.operators import sessions, spread, user_metrics, user_metrics_in_ranges

START = datetime(2024, 1, 1)
SCHEMA = "user_id string, original_timestamp timestamp, session_id string, n int"


def by_loop(spark, rows, gap_seconds):
    """Expected (row, previous, gap, opens, number) for each row."""
    df = spark.createDataFrame(rows, SCHEMA)
    hashed = df.select("*", spread.row_hash(df.columns)).collect()
    row_hash = {tuple(r)[:4]: r[4] for r in hashed}
    result = []
    users = {r[0] for r in rows}
    for user in users:
        own = [r for r in rows if r[0] == user]
        tie_hash = lambda r: "" if r[1] else hashlib.md5(r[2].encode()).hexdigest()
        own.sort(key=lambda r: (r[1] is not None, r[1] or START, tie_hash(r), r[2], row_hash[r]))
        previous, number = None, 0
        for row in own:
            time = row[1]
            gap = None
            if time is not None and previous is not None:
                gap = int(time.replace(microsecond=0).timestamp()) - int(
                    previous.replace(microsecond=0).timestamp()
                )
            opens = previous is None or gap > gap_seconds
            number += opens
            result.append((*row, previous, gap, opens, number))
            previous = time
    return result


def by_spark(spark, rows, **options):
    df = spark.createDataFrame(rows, SCHEMA)
    return [tuple(r) for r in user_metrics(df, **options).collect()]


def assert_same(actual, expected):
    def ordered(rows):
        return sorted(rows, key=lambda r: [(v is None, str(v)) for v in r])

    assert ordered(actual) == ordered(expected)


def random_rows(seed, n=300):
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        user = rng.choice([None, None, "hot", "hot", "a", "b", "c"])
        time = rng.choice([None] + [START + timedelta(seconds=rng.choice(
            [0, 0, 0.25, 59, 60, 3600, 3601, 3600.5, 7300, rng.randrange(100_000)]
        ))] * 9)
        rows.append((user, time, rng.choice("xyz"), rng.choice([None, 1, 2, 3])))
    return rows + rows[:40] + [(None, None, "x", 1)] * 25


@pytest.mark.parametrize("gap", [3600, 60, 45, 1])
@pytest.mark.parametrize("length", [60, 1])
def test_random_rows(spark, gap, length):
    rows = random_rows(gap)
    actual = by_spark(spark, rows, gap_seconds=gap, slice_seconds=length)
    assert_same(actual, by_loop(spark, rows, gap))


@pytest.mark.parametrize("gap", [3600, 45])
@pytest.mark.parametrize("whole_rows", [0, 20, 40])
def test_sliced_and_whole_users_agree(spark, gap, whole_rows):
    rows = random_rows(gap)
    assert_same(by_spark(spark, rows, gap_seconds=gap, whole_rows=whole_rows), by_loop(spark, rows, gap))


def test_small_users_need_one_summary_row_each(spark):
    """Events far apart, so that slices of a minute would be as many as the events."""
    df = spark.range(4_000).selectExpr(
        "cast(id % 10 as string) as user_id", "timestamp_seconds(id * 300) as original_timestamp",
        "cast(id as string) as session_id",
    )

    def slots(**options):
        plan = user_metrics(df, **options)
        assert plan.agg(F.max("session_seq_number")).first()[0] == 1
        placed = sessions.with_slices(
            df, sessions.event_counts(df), gap_seconds=3600, time_col="original_timestamp",
            tie_col="session_id", **options,
        )
        return placed.select(*sessions.SLICE).distinct().count()

    assert slots() == 10
    assert slots(whole_rows=399) == 4_000
    assert slots(whole_rows=0) == 4_000


@pytest.mark.parametrize(
    ("seconds", "opens"), [(3600, False), (3600.5, False), (3601, True), (0, False)]
)
def test_gap_boundary(spark, seconds, opens):
    rows = [("u", START, "a", 0), ("u", START + timedelta(seconds=seconds), "b", 1)]
    second = max(by_spark(spark, rows), key=lambda r: r[2])
    assert second[6] is opens
    assert second[7] == 1 + opens


def test_many_copies(spark):
    rows = [(None, None, "x", 1)] * 50 + [("u", START, "y", 2)] * 30
    assert_same(by_spark(spark, rows), by_loop(spark, rows, 3600))


def test_other_columns_keep_their_values(spark):
    df = spark.sql(
        "SELECT 'u' AS user_id, timestamp'2024-01-01' AS original_timestamp, 's' AS session_id, "
        "-0.0D AS x, map('a', 1) AS m"
    ).drop("m")
    assert str(user_metrics(df).first()["x"]) == "-0.0"


def test_earlier_sessions_go_on(spark):
    rows = [("a", START, "x", 1), ("b", START, "x", 1), (None, START, "x", 1), ("new", START, "x", 1)]
    df = spark.createDataFrame(rows, SCHEMA)
    seen = [("a", START - timedelta(seconds=3600), 4), ("b", START - timedelta(seconds=3601), 4),
            (None, START - timedelta(days=3), 7), ("gone", START, 1)]
    earlier = spark.createDataFrame(seen, "user_id string, last_time timestamp, last_seq long")
    got = {r["user_id"]: (r["is_new_session"], r["session_seq_number"], r["prev_event_time"]) for r in user_metrics(df, earlier=earlier).collect()}
    assert got == {"a": (False, 4, seen[0][1]), "b": (True, 5, seen[1][1]),
                   None: (True, 8, seen[2][1]), "new": (True, 1, None)}


def test_empty_input(spark):
    assert by_spark(spark, []) == []


def test_row_hash_tells_nulls_apart(spark):
    df = spark.createDataFrame([("a", None), (None, "a")], "x string, y string")
    assert df.select(spread.row_hash(df.columns)).distinct().count() == 2


def test_sum_before(spark):
    rng = random.Random(5)
    rows = [(g, a, b, rng.randrange(9)) for g in (None, "p") for a in range(6) for b in range(7)]
    df = spark.createDataFrame(rows, "g string, a int, b int, v long")
    actual = spread.sum_before(df, ["g"], ["a", "b"], "v", "before").collect()
    for r in actual:
        before = [x[3] for x in rows if x[0] == r["g"] and (x[1], x[2]) < (r["a"], r["b"])]
        assert r["before"] == sum(before)
    assert len(actual) == len(rows)


# -- sorted ranges ------------------------------------------------------------


@pytest.fixture
def many_parts(spark):
    """Ranges stay as many as shuffle partitions, as in a large table."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


@pytest.mark.parametrize("seed", range(3))
def test_ranges_equal_the_loop(spark, tmp_path, many_parts, seed):
    rows = random_rows(seed, 200)
    df = spark.createDataFrame(rows, SCHEMA)
    result = user_metrics_in_ranges(df, str(tmp_path), gap_seconds=3600)
    assert_same([tuple(r) for r in result.collect()], by_loop(spark, rows, 3600))
    parts = spark.read.parquet(str(tmp_path / "sorted")).selectExpr("_number >> 33 as part")
    assert parts.distinct().count() == 4


def test_ranges_go_on_from_earlier_state(spark, tmp_path, many_parts):
    rows = sorted(random_rows(7, 200), key=lambda r: (r[1] is not None, r[1] or START))
    rows = [r for r in rows if r[1] is not None]
    cut = next(i for i in range(100, len(rows)) if rows[i][1] > rows[i - 1][1])
    first = user_metrics(spark.createDataFrame(rows[:cut], SCHEMA))
    known = first.groupBy("user_id").agg(
        F.max("original_timestamp").alias("last_time"), F.max("session_seq_number").alias("last_seq")
    )
    rest = spark.createDataFrame(rows[cut:], SCHEMA)
    ranged = user_metrics_in_ranges(rest, str(tmp_path), earlier=known)
    assert_same(
        [tuple(r) for r in ranged.collect()],
        [tuple(r) for r in user_metrics(rest, earlier=known).collect()],
    )
    empty = user_metrics_in_ranges(rest.where("false"), str(tmp_path / "e"), earlier=known)
    assert empty.count() == 0


def test_a_crowded_second_is_spread_and_the_source_read_once(spark, tmp_path, many_parts):
    source = str(tmp_path / "source")
    spark.range(20_000).selectExpr(
        "cast(null as string) as user_id", "timestamp'2024-01-01' as original_timestamp",
        "cast(id as string) as session_id",
    ).write.parquet(source)
    result = user_metrics_in_ranges(spark.read.parquet(source), str(tmp_path))
    assert result.agg(F.max("session_seq_number"), F.count("*")).first() == (1, 20_000)
    sizes = spark.read.parquet(str(tmp_path / "sorted")).selectExpr("_number >> 33 as part")
    assert max(r["count"] for r in sizes.groupBy("part").count().collect()) < 10_000
    assert all("/sorted/" in f for f in result.inputFiles())
