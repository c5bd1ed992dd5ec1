"""Every registered query against its SQL, and known counts of the fixture."""

import duckdb
import pytest
from conftest import SMALL
from helpers import frame, table

import __spark_entry__ as entry
from viewlens.plans import oracle

QUERIES = entry.queries()
ORACLES = oracle.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW events AS SELECT * FROM '{SMALL}/events.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, duck, name):
    result = duck.execute(ORACLES[name])
    expected = table([c[0] for c in result.description], result.fetchall())
    assert frame(QUERIES[name](spark, SMALL)) == expected


def test_the_time_zone_of_the_caller_stays(spark, duck):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        for name in ("movie_stats_1h", "daily_metrics", "past_retention"):
            result = duck.execute(ORACLES[name])
            expected = table([c[0] for c in result.description], result.fetchall())
            df = QUERIES[name](spark, SMALL)
            assert spark.conf.get("spark.sql.session.timeZone") == "America/Los_Angeles"
            assert frame(df) == expected
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_every_sql_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() == 10


@pytest.mark.parametrize(
    ("name", "rows"),
    {
        "processed_events": 1000,
        "movie_stats_1h": 994,
        "movie_stats_1d": 854,
        "device_stats_1m": 1000,
        "device_stats_1h": 990,
        "retention": 30,
        "daily_metrics": 31,
        "fact_last_day": 41,
        "movie_popularity": 93,
        "views_by_device_24h": 41,
    }.items(),
)
def test_known_row_counts(spark, name, rows):
    assert QUERIES[name](spark, SMALL).count() == rows
