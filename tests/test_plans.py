"""Properties of the physical plans that matter at scale."""

import re

import pytest
from conftest import SMALL
from helpers import explain

import __spark_entry__ as entry
from viewlens import fixtures
from viewlens import operators as ops
from viewlens.operators import sessions
from viewlens.plans import jobs
from viewlens.sinks import append_run, latest_rows
from viewlens.sources import decode_events


def exchanges(plan):
    return len(re.findall(r"^\(\d+\) Exchange$", plan, re.M))


@pytest.fixture
def views(spark):
    return fixtures.load_views(spark, SMALL)


@pytest.mark.parametrize(
    "name",
    [
        "movie_stats_1h", "user_metrics", "user_metrics_split", "retention", "daily_metrics",
        "movie_popularity", "business_metrics", "top_movies_day", "monitor_checks",
        "hourly_summary", "alerts",
    ],
)
def test_no_python_cross_join_or_full_sort(spark, name):
    plan = explain(entry.queries()[name](spark, SMALL))
    for operator in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin", "rangepartitioning"):
        assert operator not in plan


def test_top_lists_need_no_full_sort(spark):
    for name in ("top_movies_day", "recent_events", "top_movies_chart"):
        assert "TakeOrderedAndProject" in explain(entry.queries()[name](spark, SMALL))


def test_aggregates_are_partial_before_the_shuffle(views):
    plan = explain(ops.movie_window_stats(views))
    assert plan.count("partial_") > 0 and exchanges(plan) == 1


def test_distinct_count_shuffles_by_group_and_user(views):
    plan = explain(ops.daily_metrics(views))
    assert "hashpartitioning(event_date" in plan
    assert re.search(r"hashpartitioning\(event_date#\d+, user_id#\d+", plan)


def test_scan_reads_needed_columns_only(views):
    plan = explain(ops.retention(views))
    schema = re.search(r"ReadSchema: (\S+)", plan)[1]
    assert "props" not in schema and "value" not in schema


def test_events_are_shuffled_once_and_never_by_user_alone(views):
    events = views.select("user_id", "original_timestamp", "session_id", "event_id")
    plan = explain(ops.user_metrics(events))
    shuffles = re.findall(
        r"Exchange\nInput \[\d+\]: \[(.*)\]\nArguments: hashpartitioning\((.*?), \d+\)", plan
    )
    whole = [keys for columns, keys in shuffles if "event_id" in columns]
    assert len(whole) == 1 and "_slot" in whole[0] and "_day" in whole[0]


def test_summaries_read_the_recent_rows_only(views):
    plan = explain(ops.hourly_summary(views, as_of="2024-01-30 12:00:00"))
    assert "ReadSchema: struct<>" in plan


def test_update_logs_are_read_by_hash_aggregate(spark, tmp_path, views):
    path = str(tmp_path / "log")
    append_run(ops.movie_window_stats(views), path, 0, key="batch_id")
    latest = latest_rows(spark.read.parquet(path), ["window_start", "window_end", "movie_id"])
    plan = explain(latest.where("window_start >= timestamp'2024-01-30'"))
    assert "SortAggregate" not in plan and "partial_max_by" in plan
    assert "GreaterThanOrEqual(window_start,2024-01-30" in plan


def test_a_message_is_parsed_once(spark):
    messages = spark.createDataFrame([("{}",)], "value string")
    assert explain(ops.enrich_events(decode_events(messages))).count("from_json(") == 1


def test_rollup_reads_affected_days_only(spark, tmp_path, views):
    path = str(tmp_path / "t")
    affected = jobs.affected_dates(views, as_of="2024-01-03 12:00:00")
    jobs.load_facts(views, path, affected)
    facts = jobs.read_facts(spark, path)
    assert facts.select("event_date").distinct().count() == 2
    plan = explain(jobs.on_dates(facts, affected))
    assert re.search(r"PartitionFilters: \[.*dynamicpruning", plan)


def test_single_scan_of_the_checks(views):
    plan = explain(ops.monitor_checks(views, as_of="2024-01-30 12:00:00"))
    assert len(re.findall(r"^\(\d+\) Scan parquet", plan, re.M)) == 1
