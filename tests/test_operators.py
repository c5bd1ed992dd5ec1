"""Hand-made edge rows for windows, metrics, reports, checks and profiles."""

import json
from datetime import date, datetime

import pytest

from viewlens import operators as ops

NOW = "2024-01-10 12:30:00"


def view(user="u1", movie="m1", seconds=600, kind="start", device="mobile",
         time="2024-01-10T12:00:00", processed="2024-01-10 12:10:00"):
    return (user, movie, seconds, kind, device, time, processed)


def rows(df):
    return [r.asDict() for r in df.collect()]


def test_enrichment_keeps_bad_rows(events):
    bad = rows(events([view(None, None, None, None, None, None, None)]))[0]
    assert bad["watch_category"] == "long" and bad["is_valid"] is False
    assert bad["original_timestamp"] is None and bad["event_date"] is None
    unparsed = rows(events([view(seconds=None, time="soon")]))[0]
    assert unparsed["is_valid"] is None and unparsed["original_timestamp"] is None


def test_fact_columns_keep_null_validity(events):
    facts = rows(ops.fact_columns(events([view(seconds=None), view(), view(seconds=0)])))
    assert sorted([f["is_valid"] for f in facts], key=str) == [0, 1, None]
    assert facts[0]["event_timestamp"] == datetime(2024, 1, 10, 12)


def test_movie_windows_count_known_users_only(events):
    stats = rows(
        ops.movie_window_stats(
            events([view(), view(None, seconds=200), view("u2", seconds=None), view(movie=None)])
        ).orderBy("movie_id")
    )
    assert [(s["movie_id"], s["view_count"], s["total_watch_time"], s["avg_watch_time"])
            for s in stats] == [(None, 1, 600, 600.0), ("m1", 2, 800, 400.0)]
    assert stats[0]["window_start"] == datetime(2024, 1, 10, 12, 10)
    assert stats[0]["window_end"] == datetime(2024, 1, 10, 12, 11)


def test_windows_are_half_open(events):
    stats = ops.device_window_stats(
        events([view(processed="2024-01-10 12:10:59.999999"), view(processed="2024-01-10 12:11:00")])
    )
    assert [r["view_count"] for r in stats.collect()] == [1, 1]


def test_retention_counts_users_with_two_starts(events):
    df = events([
        view("a"), view("a"), view("b"), view("b", kind="stop"), view(None), view(None),
        view("a", time="2024-01-11T00:00:00"), view("a", time="bad"),
    ])
    result = {r["event_date"]: r for r in rows(ops.retention(df))}
    first = result[date(2024, 1, 10)]
    assert (first["daily_active_users"], first["retained_users"]) == (3, 2)
    assert first["retention_rate"] == pytest.approx(200 / 3)
    assert result[date(2024, 1, 11)]["retention_rate"] == 0.0
    assert None in result
    for as_of, day in ((NOW, 10), ("2024-01-11 09:00:00", 11)):
        latest = rows(ops.latest_retention(ops.retention(df), as_of=as_of))
        assert [r["event_date"] for r in latest] == [date(2024, 1, day)]


def test_popular_movie_ties_and_nulls(events):
    def winner(*movies):
        return ops.popular_movie(events([view(movie=m) for m in movies])).first()[0]

    assert winner("b", "b", "a") == "b"
    assert winner("b", "a") == "a"
    assert winner("a", None) is None


def test_business_metrics_take_one_day(events):
    df = events([
        view(processed="2024-01-10 00:00:00"),
        view("u2", "m2", 300, processed="2024-01-10 23:59:59.999999"),
        view("u3", "m3", processed="2024-01-09 23:59:59"),
        view("u3", "m3", processed="2024-01-11 00:00:00"),
    ])
    row = rows(ops.business_metrics(df, as_of=NOW))[0]
    assert row["metric_date"] == date(2024, 1, 10)
    assert (row["total_views"], row["unique_users"], row["total_watch_time"]) == (2, 2, 900)
    assert row["popular_movie"] == "m3"


def test_aggregates_of_no_rows(events):
    none = events([view()]).where("false")
    assert ops.movie_window_stats(none).count() == 0
    assert ops.top_movies(none, as_of=NOW).count() == 0
    assert ops.retention(none).count() == 0
    business = rows(ops.business_metrics(none, as_of=NOW))[0]
    assert (business["total_views"], business["total_watch_time"]) == (0, None)
    kpis = {r["metric_name"]: r["metric_value"] for r in rows(ops.kpi_rows(none))}
    assert kpis == {"total_views": 0.0, "unique_users": 0.0, "avg_duration": 0.0}
    checks = rows(ops.monitor_checks(none, as_of=NOW))
    assert [(c["check"], c["value"], c["fired"]) for c in checks] == [
        ("null_ids", 0.0, False), ("latency", None, False), ("view_drop", None, False),
    ]
    assert ops.alerts(none, as_of=NOW).count() == 0


def test_top_movies_ties_and_limit(events):
    many = [view(movie=f"m{i:02}") for i in range(12)] + [view(movie="m11"), view(movie=None)]
    many.append(view(movie="old", processed="2024-01-08 23:59:59"))
    top = [r["movie_id"] for r in ops.top_movies(events(many), as_of=NOW).collect()]
    assert top == ["m11", *[f"m{i:02}" for i in range(9)]]
    assert [r["movie_id"] for r in ops.top_movies(events(many), as_of=NOW, n=20).collect()][-1] is None


def test_report_document_keeps_order_and_nulls(events):
    df = events([view(movie="b"), view(movie="b"), view(movie="a", seconds=None), view(movie=None)])
    document = ops.report_document(ops.top_movies(df, as_of=NOW), as_of=NOW).first()["value"]
    report = json.loads(document)
    assert report["generated_at"].startswith("2024-01-10T12:30:00")
    assert report["popular_movies"] == [
        {"movie_id": "b", "views": 2, "avg_duration": 600.0, "unique_users": 1},
        {"movie_id": "a", "views": 1, "avg_duration": None, "unique_users": 1},
        {"movie_id": None, "views": 1, "avg_duration": 600.0, "unique_users": 1},
    ]


def test_recent_events(events):
    times = ["2024-01-10T12:00:00", "bad", *[f"2024-01-0{i}T00:00:00" for i in range(1, 8)]]
    recent = ops.recent_events(events([view(time=t) for t in times])).collect()
    assert [r["original_timestamp"].day for r in recent] == [10, 7, 6, 5, 4]


def test_null_check_needs_both_conditions(events):
    df = events([
        view(None), view(movie=None), view(),
        view(None, processed="2024-01-10 11:29:59"),
    ])
    check = rows(ops.null_id_check(df, as_of=NOW, threshold=1))[0]
    assert (check["check"], check["value"], check["threshold"], check["fired"]) == (
        "null_ids", 2.0, 1.0, True,
    )
    assert rows(ops.null_id_check(df, as_of=NOW, threshold=2))[0]["fired"] is False


def test_latency_check(events):
    df = events([
        view(time="2024-01-10T12:00:00", processed="2024-01-10 12:10:00.5"),
        view(time="bad"),
        view(time="2024-01-10T11:00:00", processed="2024-01-10 11:59:59"),
    ])
    check = rows(ops.latency_check(df, as_of=NOW))[0]
    assert (check["value"], check["fired"]) == (600.5, True)


def test_view_drop_is_fractional(events):
    df = events(
        [view(processed="2024-01-10 11:10:00")] * 5 + [view(processed="2024-01-10 12:10:00")] * 2
    )
    check = rows(ops.view_drop_check(df, as_of=NOW))[0]
    assert (check["value"], check["fired"]) == (60.0, True)


def test_checks_agree_with_the_single_scan(events):
    df = events(
        [view(None, processed="2024-01-10 10:40:00"), view(movie=None)]
        + [view(processed="2024-01-10 11:10:00")] * 5
    )
    single = [
        *rows(ops.null_id_check(df, as_of=NOW)),
        *rows(ops.latency_check(df, as_of=NOW)),
        *rows(ops.view_drop_check(df, as_of=NOW)),
    ]
    assert rows(ops.monitor_checks(df, as_of=NOW)) == single


def test_alert_messages(events):
    df = events([view(None)] * 11 + [view(processed="2024-01-10 11:10:00")])
    alerts = rows(ops.alerts(df, as_of=NOW))
    assert [(a["alert_type"], a["message"], a["severity"]) for a in alerts] == [
        ("Data Quality Alert", "Found 11 records with null values in the last hour", "high"),
        ("Performance Alert", "High processing latency: 600.00 seconds", "high"),
        ("Business Alert", "Significant drop in views: 90.9%", "high"),
    ]
    assert alerts[0]["created_at"] == datetime(2024, 1, 10, 12, 30)


def test_verification(events):
    full, empty = events([view()]), events([view()]).where("false")
    times = {"full": "processing_timestamp"}
    result = {r["table_name"]: r for r in rows(
        ops.verify_tables({"full": full, "empty": empty}, time_cols=times)
    )}
    assert (result["full"]["n_rows"], result["full"]["ok"]) == (1, True)
    assert result["full"]["latest"] == datetime(2024, 1, 10, 12, 10)
    assert (result["empty"]["n_rows"], result["empty"]["ok"]) == (0, False)
    assert ops.require_tables({"full": full}, time_cols=times).count() == 1
    with pytest.raises(ValueError, match="empty"):
        ops.require_tables({"full": full, "empty": empty}, time_cols=times)


@pytest.mark.parametrize(
    "values",
    [
        [1, 2, 3, 4], [5], [-70000, 0, 3, 70000, 70000, None], [7] * 10, [None], [],
        [0.5, 1.7, 2.9], [-0.125, -1.5, 0, 1.5, 1e-300, -1e300, 1e308], [1.25, 1.250001, -3, None],
    ],
)
def test_statistics_equal_pandas(spark, values):
    values = [None if v is None else float(v) for v in values]
    kinds = ["int", "double", "decimal(38,6)"] if all(v is None or abs(v) < 9e9 and (v == 0 or abs(v) > 1e-6) for v in values) else ["double"]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    for kind in kinds:
        check_statistics(df.select(df["x"].cast(kind)), values if kind != "int" else [v and int(v) for v in values])


def check_statistics(df, values):
    import pandas as pd

    got = ops.column_statistics(df).first()
    want = pd.Series(values, dtype="float64").dropna().describe()
    assert got["n"] == want["count"]
    for ours, theirs in {"mean": "mean", "std": "std", "min": "min", "p25": "25%", "p50": "50%",
                         "p75": "75%", "max": "max"}.items():
        if pd.isna(want[theirs]):
            assert got[ours] is None
        else:
            assert float(got[ours]) == pytest.approx(want[theirs])


def test_statistics_of_extremes(spark):
    least, most = -(2**63), 2**63 - 1
    df = spark.createDataFrame([(least,), (most,), (0,), (None,)], "x long")
    got = ops.column_statistics(df).first()
    assert (got["min"], got["max"], got["p50"]) == (least, most, 0)
    assert got["p25"] == pytest.approx(least / 2) and got["p75"] == pytest.approx(most / 2)
    mixed = df.selectExpr("x", "CAST(x AS string) AS s", "CAST('NaN' AS double) AS y")
    rows = {r["column_name"]: r for r in ops.column_statistics(mixed).collect()}
    assert set(rows) == {"x", "y"} and rows["y"]["max"] == "NaN"
    assert (rows["x"]["min"], rows["x"]["max"]) == (str(least), str(most))
    with pytest.raises(ValueError, match="numeric"):
        ops.column_statistics(mixed.select("s"))


def test_statistics_do_not_depend_on_neighbours(spark):
    df = spark.range(3).selectExpr(
        "id + 9007199254740993 as a", "id / 3.0D as b", "cast(id + 0.1 as decimal(38,10)) as c",
        "cast(id as float) as `d.e`", "if(id = 1, double('NaN'), double(id)) as f",
    )
    alone = {c: ops.column_statistics(df, [c]).first() for c in df.columns}
    for row in ops.column_statistics(df).collect():
        other = alone[row["column_name"]]
        for name in ("n", "mean", "std", "p25", "p50", "p75"):
            assert str(row[name]) == str(other[name])
        assert row["min"] == str(other["min"]) or float(row["min"]) == other["min"]
    assert alone["a"]["min"] == 9007199254740993 and alone["c"]["min"] == "0.1000000000"
    assert alone["f"]["p50"] == 2 and str(alone["f"]["max"]) == "nan" and alone["d.e"]["p25"] == 0.5


@pytest.mark.parametrize("seed", range(3))
def test_quartiles_of_many_values_are_found_by_narrowing(spark, monkeypatch, seed):
    import random
    from decimal import Decimal

    from viewlens.operators import profile

    monkeypatch.setattr(profile, "SORTED", 5)
    monkeypatch.setattr(profile, "ACCURACY", 20)
    rng = random.Random(seed)
    far = [rng.choice([-(2**63), 2**63 - 1, 0, 1, 2**62 + rng.randrange(9)]) for _ in range(400)]
    near = [2**60 + rng.choice([0, 1, 1, 1, 2, 3, 77]) for _ in range(400)]
    spread = [rng.gauss(0, 10 ** rng.randrange(-5, 9)) for _ in range(400)]
    halves = [rng.choice([-1.0, 1.0]) for _ in range(396)] + [0.25, 0.5, float("inf"), -0.0]
    prices = [Decimal(rng.randrange(10**30)).scaleb(-8) * rng.choice([1, -1]) for _ in range(400)]
    rows = list(zip(far, near, spread, halves, prices, strict=True))
    df = spark.createDataFrame(rows, "far long, near long, spread double, halves double, price decimal(38,8)")
    found = {r["column_name"]: r for r in profile.column_statistics(df).collect()}
    for name, values in zip(df.columns, zip(*rows, strict=True), strict=True):
        ordered = sorted(values)
        for k, quartile in enumerate(("p25", "p50", "p75"), 1):
            low, part = divmod(399 * k, 4)
            wanted = float(ordered[low]) * (1 - part / 4) + float(ordered[low + 1]) * (part / 4)
            if ordered[low] == ordered[low + 1]:
                wanted = float(ordered[low])
            assert found[name][quartile] == wanted, (name, quartile)


def test_column_types_and_first_rows(spark):
    df = spark.createDataFrame([(1, None), (2, "b")], "a int, b string")
    assert [tuple(r) for r in ops.column_types(df).collect()] == [("a", "int", 2), ("b", "string", 1)]
    assert ops.first_rows(spark.range(9)).count() == 5
