import json
import re
from datetime import date, datetime

import pytest
from helpers import explain
from pyspark.sql import functions as F

from viewlens import operators as ops
from viewlens import sinks
from viewlens.plans import jobs
from viewlens.schemas import USER_VIEWS
from viewlens.session import build_session, scratch_dir

NOW = "2024-01-10 12:30:00"


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_replace_partitions_leaves_the_others(spark, tmp_path):
    path = str(tmp_path / "t")

    def put(*values):
        df = spark.createDataFrame(values, "d date, v int")
        sinks.replace_partitions(df, path, "d")

    put((date(2024, 1, 1), 1), (date(2024, 1, 2), 2))
    put((date(2024, 1, 2), 3), (date(2024, 1, 2), 4))
    table = spark.read.parquet(path).select("d", "v")
    assert rows(table) == [(date(2024, 1, 1), 1), (date(2024, 1, 2), 3), (date(2024, 1, 2), 4)]
    assert "PartitionFilters: [isnotnull(d" in explain(table.where("d = date'2024-01-02'"))


def test_refresh_and_order(spark, tmp_path):
    path = str(tmp_path / "t")
    for values in ([1, 2, 3], [5, 4, 6]):
        df = spark.createDataFrame([(v,) for v in values], "v int").coalesce(1)
        sinks.refresh(df, path, order_by="v")
    assert [r["v"] for r in spark.read.parquet(path).collect()] == [6, 5, 4]


def test_append_run_can_be_repeated(spark, tmp_path):
    path = str(tmp_path / "t")
    for run in (1, 2, 2):
        sinks.append_run(spark.range(2), path, run)
    assert rows(spark.read.parquet(path).select("run_id", "id")) == [(1, 0), (1, 1), (2, 0), (2, 1)]


def test_latest_rows(spark):
    log = spark.createDataFrame(
        [("a", 1, 0), ("a", 2, 10), ("a", 9, 9), (None, 5, 1), (None, None, 2), ("b", 1, 3)],
        "k string, v int, batch_id int",
    )
    result = {r["k"]: r["v"] for r in sinks.latest_rows(log, ["k"]).collect()}
    assert result == {"a": 2, None: None, "b": 1}


def simple(**changes):
    event = {"user_id": "u", "movie_id": "m", "duration": 5, "event_type": "stop",
             "timestamp": "2024-01-01T00:00:00"}
    return json.dumps(event | changes)


def test_load_views_with_quarantine(spark, tmp_path):
    lines = [
        simple(),
        simple(duration=None, user_id=None),
        simple(timestamp="soon"),
        simple(timestamp=None),
        simple(duration="many"),
        '{ "movie_id": null,"user_id":"' + "u" * 51 + '", "extra": [1, 2] }',
        '{"user_id": "cut',
    ]
    (tmp_path / "in.json").write_text("\n".join(lines))
    table = str(tmp_path / "t")
    for _ in range(2):
        counts = sinks.load_views(spark, str(tmp_path / "in.json"), table, load_id=7, as_of=NOW)
        assert counts == {"loaded": 2, "rejected": 5}
    loaded = sinks.loaded_views(spark, table)
    assert loaded.schema == USER_VIEWS
    assert {r["created_at"] for r in loaded.collect()} == {datetime(2024, 1, 10, 12, 30)}
    assert loaded.count() == 2
    rejected = {r["raw_record"] for r in sinks.rejected_views(spark, table).collect()}
    assert rejected == set(lines[2:])
    assert "PartitionFilters" in explain(loaded) and "status" in explain(loaded)


def test_load_of_an_empty_file(spark, tmp_path):
    (tmp_path / "in.json").write_text("")
    table = str(tmp_path / "t")
    counts = sinks.load_views(spark, str(tmp_path / "in.json"), table, load_id=1)
    assert counts == {"loaded": 0, "rejected": 0}
    assert sinks.loaded_views(spark, table).count() == 0


def test_create_table_twice(spark):
    for _ in range(2):
        sinks.create_table(spark, "movie_popularity", partition_by=[])
    assert "last_updated" in spark.table("movie_popularity").columns
    sinks.create_table(spark, "user_views_fact", partition_by=["event_date"])
    assert spark.table("user_views_fact").columns[-1] == "event_date"
    for name in ("movie_popularity", "user_views_fact"):
        spark.sql(f"DROP TABLE {name}")


def test_writers_survive_a_replay(spark, tmp_path, events):
    row = ("u", "m", 5, "start", "tablet", "2024-01-01T00:00:00", "2024-01-01 00:00:00")
    batch = events([row, row, (*row[:5], "bad", row[6])])
    path = str(tmp_path)
    write = sinks.fan_out(
        sinks.lake_writer(f"{path}/lake"),
        sinks.processed_writer(f"{path}/processed"),
        sinks.fact_writer(f"{path}/facts"),
        sinks.update_log_writer(f"{path}/log"),
    )
    for batch_id in (0, 1, 1):
        write(batch, batch_id)
    write(batch.where("false"), 2)
    stored = {t: spark.read.parquet(f"{path}/{t}") for t in ("facts", "log")}
    for name in ("lake", "processed"):
        table = sinks.event_table(spark, f"{path}/{name}", "processing_date")
        stored[name] = table.updates(spark)
    for name, df in stored.items():
        assert sorted(r["batch_id"] for r in df.collect()) == [0, 0, 0, 1, 1, 1], name
    lake = sinks.read_arrivals(spark, f"{path}/lake")
    changes = sinks.change_table(f"{path}/lake").read(spark)
    day = date(2024, 1, 1)
    assert {tuple(r) for r in changes.collect()} == {(day, None, 2), (day, day, 4)}
    for recent in (
        ops.null_id_check(lake, as_of="2024-01-01 00:30:00"),
        ops.top_movies(lake, as_of="2024-01-01 00:30:00"),
        ops.business_metrics(lake, as_of="2024-01-01 00:30:00"),
        ops.alerts(lake, as_of="2024-01-01 00:30:00"),
    ):
        assert re.search(r"PartitionFilters: \[.*processing_date#\d+ >= 202.*processing_date#\d+ <= 202", explain(recent))
    facts = spark.read.parquet(f"{path}/facts")
    assert facts.where("event_date is null").count() == 2


class Database:
    """Takes what the writer would send, in a database of this process."""

    def __init__(self):
        import duckdb

        self.db, self.fail = duckdb.connect(), None

    def store(self, rows, options):
        frame = rows.toPandas()
        self.db.execute(f"CREATE OR REPLACE TABLE {options['dbtable']} AS SELECT * FROM frame")

    def execute(self, spark, connection, statements):
        self.db.execute("BEGIN")
        for number, statement in enumerate(statements):
            if number == self.fail:
                self.fail = None
                self.db.execute("ROLLBACK")
                raise OSError("lost")
            self.db.execute(statement)
        self.db.execute("COMMIT")

    def rows(self, query):
        return sorted(self.db.execute(query).fetchall(), key=str)


@pytest.mark.parametrize("fail", [None, 0, 1, 2, 3, 4])
def test_database_batches_count_once(spark, fail):
    base = Database()
    base.db.execute("CREATE TABLE stats (k VARCHAR, day DATE, n BIGINT)")
    base.db.execute("CREATE TABLE events (k VARCHAR, day DATE, n BIGINT)")
    options = {"execute": base.execute, "store": base.store}
    keyed = sinks.database_writer({"url": "x"}, "stats", keys=["k", "day"], **options)
    plain = sinks.database_writer({"url": "x"}, "events", **options)
    made = "k string, day date, n long"
    first = spark.createDataFrame([("a", date(2024, 1, 1), 1), (None, date(2024, 1, 1), 2)], made)
    second = spark.createDataFrame([("a", date(2024, 1, 1), 5), ("b", None, 7)], made)
    for number, batch in enumerate((first, second, first.where("false"))):
        for write in (keyed, plain):
            base.fail = fail if number == 1 else None
            try:
                write(batch, number)
            except OSError:
                pass
            base.fail = None
            write(batch, number)
            write(batch, number)
    assert base.rows("SELECT k, n FROM stats") == [("a", 5), ("b", 7), (None, 2)]
    assert base.rows("SELECT k, n FROM events") == [("a", 1), ("a", 5), ("b", 7), (None, 2)]
    assert base.rows("SELECT * FROM loaded_batches") == [
        ("events", 0), ("events", 1), ("stats", 0), ("stats", 1)
    ]
    tables = {t for (t,) in base.rows("SELECT table_name FROM information_schema.tables")}
    assert tables == {"stats", "events", "loaded_batches"}


def test_database_names_are_checked():
    with pytest.raises(ValueError, match="not a table name"):
        sinks.database_writer({"url": "x"}, "t; DROP TABLE u")
    with pytest.raises(IndexError):
        sinks.merge_statements("a.b", ["x"], 1)[4]


def test_top_rows_open_only_the_first_files(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(1000).selectExpr("if(id % 100 = 0, null, id div 2) as n", "id")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sinks.tables.refresh(df.repartition(4), path, order_by="n")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    stored = spark.read.parquet(path)
    assert stored.count() == 1000
    top = sinks.read_top(spark, path, "n", 11, "id")
    expected = df.orderBy(F.col("n").desc(), "id").limit(11)
    assert [tuple(r) for r in top.collect()] == [tuple(r) for r in expected.collect()]
    assert len(top.inputFiles()) < len(stored.inputFiles())
    everything = sinks.read_top(spark, path, "n", 2000, "id")
    assert everything.count() == 1000 and everything.tail(1)[0]["n"] is None
    # Ranges do not overlap, so statistics of the files tell which to open.
    bounds = sorted((b["least"], b["most"]) for b in spark.read.parquet(f"{path}/_bounds").collect())
    assert all(a[1] <= b[0] for a, b in zip(bounds, bounds[1:], strict=False))
    sinks.tables.refresh(df.where("false"), path, order_by="n")
    assert sinks.read_top(spark, path, "n", 5).count() == 0


def test_scratch_is_shared(spark):
    first, second = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    assert first != second
    assert first.startswith(spark.conf.get("spark.checkpoint.dir"))

    class Unset:
        class conf:
            get = staticmethod(lambda key, default=None: {"spark.sql.warehouse.dir": "s3://w/"}.get(key, default))

    assert scratch_dir(Unset, "x").startswith("s3://w/_scratch/x-")

    class OneMachine:
        class conf:
            get = staticmethod(lambda key, default=None: {"spark.sql.warehouse.dir": "file:/w"}.get(key, default))

        class sparkContext:
            master = "spark://host:7077"

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_dir(OneMachine, "x")
    OneMachine.sparkContext.master = "local[4]"
    assert scratch_dir(OneMachine, "x").startswith("file:/w/_scratch/x-")


def test_build_session_reuses_settings(spark):
    assert build_session().conf.get("spark.sql.session.timeZone") == "UTC"


# -- jobs ---------------------------------------------------------------------


def view(user, movie, time, processed, seconds=600):
    return (user, movie, seconds, "start", "mobile", time, processed)


def test_rollup_repeated_and_extended(spark, tmp_path, events):
    tables = str(tmp_path / "t")
    day_nine = [view("a", "m1", "2024-01-09T10:00:00", "2024-01-09 10:01:00")] * 3
    old = [view("a", "m1", "2024-01-02T10:00:00", "2024-01-02 10:00:00")]
    df = events(old + day_nine + [view("b", "m2", "2024-01-09T23:00:00", "2024-01-10 00:01:00")])
    for _ in range(2):
        assert jobs.daily_rollup(df, tables=tables, as_of=NOW) is True
    facts = jobs.read_facts(spark, tables)
    # The whole of the affected day is loaded once, the older day not at all.
    assert facts.count() == 4
    daily = spark.read.parquet(f"{tables}/daily_metrics").collect()
    assert [(r["metric_date"], r["total_views"], r["unique_users"]) for r in daily] == [
        (date(2024, 1, 9), 4, 2)
    ]
    popularity = spark.read.parquet(f"{tables}/movie_popularity")
    assert rows(popularity.select("movie_id", "total_views")) == [("m1", 3), ("m2", 1)]

    later = events([view("c", "m3", "2024-01-10T10:00:00", "2024-01-10 10:00:00")])
    assert jobs.daily_rollup(later, tables=tables, as_of=NOW, exact=False) is True
    assert jobs.read_facts(spark, tables).count() == 5
    assert spark.read.parquet(f"{tables}/daily_metrics").count() == 2
    assert spark.read.parquet(f"{tables}/movie_popularity").count() == 3


def lake_of(spark, path, *batches):
    """Batches folded into a lake, the last one still in its tail, and its changes."""
    write = sinks.lake_writer(path, compact_every=2)
    for number, batch in enumerate(batches):
        write(batch, number)
    return sinks.read_arrivals(spark, path), sinks.change_table(path).read(spark)


def test_load_reads_the_arrival_days_of_the_affected_dates(spark, tmp_path, events):
    tables = str(tmp_path / "t")
    lake, changes = lake_of(
        spark,
        str(tmp_path / "lake"),
        events([view("a", "m1", "2024-01-02T10:00:00", "2024-01-02 10:00:00"),
                view("a", "m1", "bad", "2024-01-02 11:00:00")]),
        events([view("b", "m1", "2024-01-09T10:00:00", "2024-01-09 10:00:00")]),
        events([view("c", "m1", "2024-01-09T11:00:00", "2024-01-10 11:00:00"),
                view("c", "m1", "bad", "2024-01-10 11:00:00")]),
    )
    affected = jobs.affected_dates(lake, as_of=NOW)
    for _ in range(2):
        jobs.load_facts(lake, tables, affected, changes)
    # The earlier row of the affected date is loaded too, the older date not at all.
    users = [r["user_id"] for r in jobs.read_facts(spark, tables).collect()]
    assert sorted(users) == ["b", "c"]
    assert jobs.read_facts(spark, tables, undated=True).count() == 3
    undated = spark.read.parquet(f"{tables}/user_views_undated")
    assert [r["processing_date"] for r in undated.collect()] == [date(2024, 1, 10)]

    recent = changes.where("event_date = date'2024-01-09'").select("processing_date").distinct()
    plan = explain(lake.join(recent.where("processing_date > date'2024-01-01'"), "processing_date", "left_semi"))
    assert "dynamicpruning" in plan
    facts = jobs.on_dates(jobs.read_facts(spark, tables), affected)
    assert facts.count() == 2 and "dynamicpruning" in explain(facts)


def test_rollups_of_sketches_read_no_facts(spark, tmp_path, events):
    tables = str(tmp_path / "t")
    rows_ = [
        view(f"u{i % 40}", f"m{i % 3}", f"2024-01-{d:02}T10:00:00", f"2024-01-{d:02} 10:00:00", i)
        for d in (8, 9, 10) for i in range(150)
    ]
    for _ in range(2):
        assert jobs.daily_rollup(events(rows_), tables=tables, as_of=NOW, interval="3 days", exact=False)
    facts = jobs.read_facts(spark, tables)
    daily = spark.read.parquet(f"{tables}/daily_metrics")
    assert rows(daily) == rows(ops.daily_metrics(facts).select(*daily.columns))
    popularity = spark.read.parquet(f"{tables}/movie_popularity")
    assert rows(popularity) == rows(ops.movie_popularity(facts, as_of=NOW).select(*popularity.columns))
    days = spark.read.parquet(f"{tables}/movie_daily")
    plan = explain(ops.popularity_of_days(days, as_of=NOW))
    assert "user_views_fact" not in plan and "PartitionFilters: [isnotnull(event_date" in plan


def test_popular_movie_from_arrivals(spark, tmp_path, events):
    path = str(tmp_path / "arrivals")
    write = sinks.processed_writer(str(tmp_path / "p"))
    first = [view("a", m, "x", f"2024-01-0{d} 10:00:00") for d, m in ((1, "m1"), (1, "m1"), (2, None))]
    write(events(first), 0)
    processed = sinks.read_arrivals(spark, str(tmp_path / "p"))
    counts = jobs.refresh_movie_arrivals(processed, path)
    assert rows(ops.popular_movie(arrivals=counts)) == [("m1",)]
    write(events([view("a", None, "x", f"2024-01-0{d} 11:00:00") for d in (2, 3)]), 1)
    processed = sinks.read_arrivals(spark, str(tmp_path / "p"))
    for _ in range(2):
        counts = jobs.refresh_movie_arrivals(processed, path)
        assert counts.groupBy().sum("views").first()[0] == 5
    assert rows(ops.popular_movie(arrivals=counts)) == rows(ops.popular_movie(processed)) == [(None,)]
    metrics = ops.business_metrics(processed, as_of="2024-01-03 12:00:00", arrivals=counts)
    plan = explain(metrics)
    scans = re.findall(r"Location: \S+ \[file:(\S+?)[,\]].*?\nPartitionFilters: (.*)", plan)
    assert all("processing_date" in f for location, f in scans if "/p/" in location) and scans
    assert [r["popular_movie"] for r in metrics.collect()] == [None]


def test_rollup_without_recent_events_writes_nothing(tmp_path, events):
    old = events([view("a", "m", "2024-01-02T10:00:00", "2024-01-02 10:00:00")])
    assert jobs.daily_rollup(old, tables=str(tmp_path / "t"), as_of=NOW) is False
    assert not (tmp_path / "t").exists()


def test_business_metrics_are_replaced_by_date(spark, tmp_path, events):
    path = str(tmp_path / "b")
    first = events([view("a", "m", "2024-01-10T10:00:00", "2024-01-10 10:00:00")])
    more = events([view("a", "m", "2024-01-10T10:00:00", "2024-01-10 10:00:00")] * 2)
    jobs.update_business_metrics(first, path, as_of="2024-01-09 10:00:00")
    jobs.update_business_metrics(first, path, as_of=NOW)
    jobs.update_business_metrics(more, path, as_of=NOW)
    stored = spark.read.parquet(path).select("metric_date", "total_views")
    assert rows(stored) == [(date(2024, 1, 9), 0), (date(2024, 1, 10), 2)]


def test_report_file_alerts_and_kpis(spark, tmp_path, events):
    df = events([view("a", "m", "2024-01-10T10:00:00", "2024-01-10 12:10:00")])
    jobs.daily_report(df, str(tmp_path / "report"), as_of=NOW)
    files = list((tmp_path / "report").glob("part-*.txt"))
    assert len(files) == 1
    assert json.loads(files[0].read_text())["popular_movies"][0]["movie_id"] == "m"
    for run in ("r1", "r1", "r2"):
        jobs.monitor_once(df, str(tmp_path / "alerts"), run_id=run, as_of=NOW)
        jobs.append_kpis(df, str(tmp_path / "kpis"), run_id=run, as_of=NOW)
    assert spark.read.parquet(str(tmp_path / "alerts")).count() == 2
    assert spark.read.parquet(str(tmp_path / "kpis")).count() == 6
