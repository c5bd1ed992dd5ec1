"""The command line from raw files to every table."""

import json
from datetime import datetime, timedelta

import pytest

from viewlens.__main__ import main
from viewlens.functions import with_arrival_date
from viewlens.sinks import read_arrivals
from viewlens.sinks.batches import event_writer
from viewlens.streaming import start_totals, statistics_table

NOW = datetime(2024, 1, 10, 12, 30)


def test_all_commands(spark, tmp_path, capsys):
    def event(minutes, **changes):
        time = (NOW - timedelta(minutes=minutes)).isoformat()
        return {"user_id": "u", "movie_id": "m", "duration_seconds": 600, "event_type": "start",
                "device": "mobile", "timestamp": time} | changes

    source, tables = tmp_path / "in", str(tmp_path / "tables")
    source.mkdir()
    events = [event(i) for i in range(20)] + [event(0, user_id=None, timestamp="bad")]
    (source / "0.json").write_text("\n".join(json.dumps(e) for e in events))

    def run(command, *options):
        main([command, "--tables", tables, "--run-id", "r1", *options])

    run("stream", "--files", str(source), "--checkpoints", str(tmp_path / "c"), "--once")
    assert read_arrivals(spark, f"{tables}/lake").count() == 21
    run("compact")
    stats = statistics_table(f"{tables}/movie_stats_realtime", "movie_stats_realtime").read(spark)
    assert stats.groupBy().sum("view_count").first()[0] == 20

    run("rollup", "--approximate")
    assert spark.read.parquet(f"{tables}/user_views_fact").count() == 20
    assert spark.read.parquet(f"{tables}/user_views_undated").count() == 1
    daily = spark.read.parquet(f"{tables}/daily_metrics").first()
    assert (daily["metric_date"], daily["total_views"]) == (NOW.date(), 20)
    for _ in range(2):
        run("metrics")
        run("report")
        run("monitor")
    assert spark.read.parquet(f"{tables}/business_metrics").first()["total_views"] == 21
    assert spark.read.parquet(f"{tables}/kpi_metrics").count() == 3
    alerts = {r["alert_type"] for r in spark.read.parquet(f"{tables}/alerts").collect()}
    assert alerts == {"Performance Alert"}
    document = spark.read.text(f"{tables}/reports/r1").first()["value"]
    assert json.loads(document)["popular_movies"][0]["views"] == 21

    run("verify")
    assert "user_views_processed" in capsys.readouterr().out
    simple = tmp_path / "simple.json"
    simple.write_text(json.dumps({"user_id": "u", "movie_id": "m", "duration": 5,
                                  "event_type": "stop", "timestamp": "2024-01-01T00:00:00"}))
    run("load", "--source", str(simple))
    assert "'loaded': 1" in capsys.readouterr().out


def test_extended_events_sessions_and_retention(spark, tmp_path):
    def event(day):
        return {"user_id": "u", "movie_id": "m", "duration_seconds": 600, "event_type": "start",
                "device": "mobile", "timestamp": f"2024-01-0{day}T00:00:00", "user_region": "eu",
                "content_type": "movie", "bitrate": day}

    source, tables = tmp_path / "in", str(tmp_path / "tables")
    source.mkdir()
    (source / "0.json").write_text("\n".join(json.dumps(event(d)) for d in (1, 2, 4)))
    main(["stream", "--tables", tables, "--files", str(source), "--once", "--extended",
          "--sessions", "--retention", "--corrections", "--flush",
          "--checkpoints", str(tmp_path / "c")])
    main(["correct", "--tables", tables])
    lake = read_arrivals(spark, f"{tables}/lake").orderBy("bitrate").collect()
    assert [(r["user_region"], r["content_type"], r["bitrate"]) for r in lake] == [
        ("eu", "movie", d) for d in (1, 2, 4)
    ]
    sessions = spark.read.parquet(f"{tables}/user_metrics/metrics").collect()
    assert sorted(r["session_seq_number"] for r in sessions) == [1, 2, 3]
    starts = start_totals(f"{tables}/start_totals").totals(spark)
    assert sorted(r["n_rows"] for r in starts.collect()) == [1, 1, 1]
    days = spark.read.parquet(f"{tables}/retention").collect()
    assert sorted(r["event_date"].day for r in days) == [1, 2]


def test_verify_fails_on_an_empty_table(spark, tmp_path):
    rows = spark.sql("SELECT current_timestamp() AS processing_timestamp, 'u' AS user_id")
    event_writer(str(tmp_path / "user_views_processed"), with_arrival_date)(rows, 0)
    with pytest.raises(ValueError, match="empty tables: device_stats_realtime"):
        main(["verify", "--tables", str(tmp_path)])


def test_stream_needs_a_source(tmp_path):
    with pytest.raises(SystemExit):
        main(["stream", "--tables", str(tmp_path), "--checkpoints", str(tmp_path)])
