"""Independent SQL for the registered queries, over the ``events`` table."""

from __future__ import annotations

_VIEWS = """
WITH raw AS (
  SELECT event_id,
    CASE WHEN event_type = 'error' AND event_id % 25 = 0 THEN NULL
         ELSE concat('user_', user_id) END AS user_id,
    CASE WHEN event_type = 'error' AND event_id % 10 = 0 THEN NULL
         ELSE concat('movie_', json_extract_string(props, '$.k')) END AS movie_id,
    CASE WHEN event_id % 200 = 7 THEN NULL WHEN event_id % 500 = 3 THEN 90000
         ELSE CAST(floor(value * 36) AS INTEGER) END AS duration_seconds,
    CASE event_type WHEN 'view' THEN 'start' WHEN 'click' THEN 'pause'
                    WHEN 'signup' THEN 'resume' ELSE 'stop' END AS event_type,
    CASE event_id % 4 WHEN 0 THEN 'mobile' WHEN 1 THEN 'smart_tv'
                      WHEN 2 THEN 'tablet' ELSE 'desktop' END AS device,
    CASE WHEN event_id % 400 = 11 THEN 'not-a-timestamp'
         ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') END AS "timestamp",
    ts + to_seconds(event_id % 900) AS processing_timestamp
  FROM events
), v AS (
  SELECT *, CAST(original_timestamp AS DATE) AS event_date,
    CASE WHEN duration_seconds < 300 THEN 'short'
         WHEN duration_seconds >= 300 AND duration_seconds < 1800 THEN 'medium'
         ELSE 'long' END AS watch_category,
    (duration_seconds > 0 AND duration_seconds <= 86400
     AND user_id IS NOT NULL AND movie_id IS NOT NULL) AS is_valid,
    md5(concat(coalesce(user_id, 'None'), '_', coalesce(movie_id, 'None'), '_',
               coalesce("timestamp", 'None'))) AS session_id
  FROM (SELECT *, TRY_CAST("timestamp" AS TIMESTAMP) AS original_timestamp FROM raw) r
)"""

_NOW = "(SELECT max(processing_timestamp) FROM v)"
_LAST = "(SELECT max(original_timestamp) FROM v)"

_RAW_COLUMNS = 'user_id, movie_id, duration_seconds, event_type, device, "timestamp"'

_FACT_COLUMNS = """user_id, movie_id, duration_seconds, event_type, device, watch_category,
  event_date, original_timestamp AS event_timestamp, session_id,
  CAST(is_valid AS INTEGER) AS is_valid"""

# Dates that a load of the last day touches.
_AFFECTED = f"""(SELECT DISTINCT event_date FROM v
  WHERE processing_timestamp >= {_NOW} - INTERVAL '1' DAY AND event_date IS NOT NULL)"""


def _movie_windows(unit: str, source: str = "v") -> str:
    return f"""SELECT date_trunc('{unit}', processing_timestamp) AS window_start,
  date_trunc('{unit}', processing_timestamp) + INTERVAL '1' {unit} AS window_end,
  movie_id, count(user_id) AS view_count,
  CAST(sum(duration_seconds) AS BIGINT) AS total_watch_time,
  avg(duration_seconds) AS avg_watch_time
FROM {source} GROUP BY 1, 2, 3"""


def _device_windows(unit: str) -> str:
    return f"""SELECT date_trunc('{unit}', processing_timestamp) AS window_start,
  date_trunc('{unit}', processing_timestamp) + INTERVAL '1' {unit} AS window_end,
  device, count(user_id) AS view_count, avg(duration_seconds) AS avg_watch_time
FROM v GROUP BY 1, 2, 3"""


def _user_metrics(source: str, where: str = "true") -> str:
    order = """PARTITION BY user_id ORDER BY original_timestamp NULLS FIRST,
  CASE WHEN original_timestamp IS NULL
       THEN md5(concat(session_id, lpad(CAST(event_id AS VARCHAR), 20, '0'))) END,
  session_id, event_id"""
    return f"""SELECT event_id, user_id, original_timestamp, prev_event_time,
  time_since_last_event, is_new_session,
  CAST(sum(CAST(is_new_session AS INTEGER)) OVER (
    {order} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS session_seq_number
FROM (
  SELECT *, coalesce(time_since_last_event > 3600, true) AS is_new_session
  FROM (
    SELECT *, CAST(floor(epoch(original_timestamp)) AS BIGINT)
            - CAST(floor(epoch(prev_event_time)) AS BIGINT) AS time_since_last_event
    FROM (
      SELECT *, lag(original_timestamp) OVER ({order}) AS prev_event_time
      FROM {source} WHERE {where}
    ) a
  ) b
) c"""


# Time ranges in which the events reach a stream; some come two ranges later.
def _arrivals(time: str, back: int) -> str:
    """v with the number of its range and the latest time up to ``back`` ranges before, less a minute."""
    late = "CASE WHEN event_id % 50 = 7 THEN 2 ELSE 0 END"
    return f"""(SELECT a.*, closed FROM (
  SELECT v.*, CAST(least(4, (epoch_us(ts) - first) * 5 // (last - first + 1) + {late}) AS INTEGER)
    AS arrival
  FROM (SELECT *, processing_timestamp - to_seconds(event_id % 900) AS ts FROM v) v,
       (SELECT min(epoch_us(ts)) AS first, max(epoch_us(ts)) AS last FROM events) bounds
) a JOIN (
  SELECT arrival, max(latest) OVER (ORDER BY arrival ROWS BETWEEN UNBOUNDED PRECEDING
                                    AND {back} PRECEDING) - INTERVAL '1' MINUTE AS closed
  FROM (SELECT least(4, (epoch_us(ts) - first) * 5 // (last - first + 1) + {late}) AS arrival,
          max({time}) AS latest
        FROM (SELECT *, processing_timestamp - to_seconds(event_id % 900) AS ts FROM v) v,
             (SELECT min(epoch_us(ts)) AS first, max(epoch_us(ts)) AS last FROM events) bounds
        GROUP BY 1) r
) h ON h.arrival = a.arrival)"""


_LAGGED = _arrivals("processing_timestamp", 2)
# A window is closed by the watermark that the batch before had.
_MINUTE_END = "date_trunc('minute', processing_timestamp) + INTERVAL '1' MINUTE"
# An event is given out once the stream is a minute past it, so an older one is late.
_TIMED = _arrivals("original_timestamp", 1)

_RETENTION = """SELECT event_date, count(*) AS daily_active_users,
  CAST(sum(CASE WHEN n > 1 THEN 1 ELSE 0 END) AS BIGINT) AS retained_users,
  CASE WHEN count(*) > 0
       THEN CAST(sum(CASE WHEN n > 1 THEN 1 ELSE 0 END) AS DOUBLE) / count(*) * 100
       ELSE 0 END AS retention_rate
FROM (SELECT user_id, event_date, count(*) AS n FROM v
      WHERE event_type = 'start' GROUP BY user_id, event_date) x
GROUP BY event_date"""

_DAILY = """SELECT event_date AS metric_date, count(*) AS total_views,
  count(DISTINCT user_id) AS unique_users,
  CAST(sum(duration_seconds) AS BIGINT) AS total_watch_time,
  avg(duration_seconds) AS avg_watch_time
FROM v WHERE {where} GROUP BY event_date"""

_POPULARITY = """SELECT movie_id, count(*) AS total_views,
  count(DISTINCT user_id) AS unique_users, avg(duration_seconds) AS avg_watch_time,
  {now} AS last_updated
FROM v WHERE event_date BETWEEN CAST({now} AS DATE) - INTERVAL '7' DAY AND CAST({now} AS DATE)
  AND {where}
GROUP BY movie_id"""


def _business(now: str) -> str:
    return f"""SELECT CAST({now} AS DATE) AS metric_date, count(*) AS total_views,
  count(DISTINCT user_id) AS unique_users,
  CAST(sum(duration_seconds) AS BIGINT) AS total_watch_time,
  (SELECT movie_id FROM v GROUP BY movie_id
   ORDER BY count(*) DESC, movie_id NULLS FIRST LIMIT 1) AS popular_movie,
  avg(duration_seconds) AS avg_session_duration, {now} AS calculated_at
FROM v WHERE CAST(processing_timestamp AS DATE) = CAST({now} AS DATE)"""


_YESTERDAY = f"({_NOW} - INTERVAL '1' DAY)"

_REPORT = f"""SELECT movie_id, count(*) AS view_count, avg(duration_seconds) AS avg_duration,
  count(DISTINCT user_id) AS unique_users
FROM v WHERE processing_timestamp >= CAST({_NOW} AS DATE) - INTERVAL '1' DAY
GROUP BY movie_id ORDER BY view_count DESC, movie_id NULLS LAST LIMIT 10"""

_KPIS = """SELECT 'total_views' AS metric_name, CAST(count(*) AS DOUBLE) AS metric_value FROM v
UNION ALL SELECT 'unique_users', CAST(count(DISTINCT user_id) AS DOUBLE) FROM v
UNION ALL SELECT 'avg_duration', coalesce(avg(duration_seconds), 0) FROM v"""

_NULL_VALUE = f"""SELECT CAST(count(*) AS DOUBLE) AS value FROM v
  WHERE (user_id IS NULL OR movie_id IS NULL)
    AND processing_timestamp >= {_NOW} - INTERVAL '1' HOUR"""
_LATENCY_VALUE = f"""SELECT CAST(sum(date_diff('microsecond', original_timestamp,
    processing_timestamp)) AS DOUBLE) / 1e6 / count(original_timestamp) AS value
  FROM v WHERE processing_timestamp >= {_NOW} - INTERVAL '30' MINUTE"""
_DROP_VALUE = f"""SELECT CAST(max(c) - min(c) AS DOUBLE) / nullif(max(c), 0) * 100 AS value
  FROM (SELECT date_trunc('hour', processing_timestamp) AS h, count(*) AS c FROM v
        WHERE processing_timestamp >= {_NOW} - INTERVAL '2' HOUR GROUP BY 1) x"""


def _check(name: str, value: str, threshold: float) -> str:
    return f"""SELECT '{name}' AS "check", value, CAST({threshold} AS DOUBLE) AS threshold,
  coalesce(value > {threshold}, false) AS fired FROM ({value}) q_{name}"""


_CHECKS = [
    _check("null_ids", _NULL_VALUE, 10),
    _check("latency", _LATENCY_VALUE, 300),
    _check("view_drop", _DROP_VALUE, 50),
]

# Alerts with thresholds of 0, so that all three can fire.
_ALERTS = f"""SELECT * FROM (
  SELECT 'Data Quality Alert' AS alert_type,
    printf('Found %.0f records with null values in the last hour', value) AS message,
    'high' AS severity, {_NOW} AS created_at, value FROM ({_NULL_VALUE}) a
  UNION ALL SELECT 'Performance Alert',
    printf('High processing latency: %.2f seconds', value), 'high', {_NOW}, value
    FROM ({_LATENCY_VALUE}) b
  UNION ALL SELECT 'Business Alert',
    printf('Significant drop in views: %.1f%%', value), 'high', {_NOW}, value
    FROM ({_DROP_VALUE}) c) x"""
_ALERT_ROWS = f"SELECT alert_type, message, severity, created_at FROM ({_ALERTS}) y WHERE value > 0"

_STATS = """SELECT 'duration_seconds' AS column_name, count(duration_seconds) AS n,
  round(avg(duration_seconds), 6) AS mean, round(stddev_samp(duration_seconds), 6) AS std,
  CAST(min(duration_seconds) AS BIGINT) AS min, CAST(max(duration_seconds) AS BIGINT) AS max,
  quantile_cont(CAST(duration_seconds AS DOUBLE), 0.25) AS p25,
  quantile_cont(CAST(duration_seconds AS DOUBLE), 0.5) AS p50,
  quantile_cont(CAST(duration_seconds AS DOUBLE), 0.75) AS p75 FROM v"""

_TYPES = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, '{t}' AS column_type, count(\"{c}\") AS non_null FROM v"
    for c, t in {
        "event_id": "bigint",
        "user_id": "string",
        "movie_id": "string",
        "duration_seconds": "int",
        "event_type": "string",
        "device": "string",
        "timestamp": "string",
        "original_timestamp": "timestamp",
        "processing_timestamp": "timestamp",
        "watch_category": "string",
        "is_valid": "boolean",
        "session_id": "string",
        "event_date": "date",
    }.items()
)

_PROCESSED_COLUMNS = """user_id, movie_id, duration_seconds, event_type, device,
  original_timestamp, watch_category, processing_timestamp"""

# Lines of the JSON-lines fixture that are cut off.
_BROKEN = "event_id % 333 = 5"
_ACCEPTED = f"original_timestamp IS NOT NULL AND NOT ({_BROKEN})"


def _verified(name: str, source: str, time: str) -> str:
    return f"""SELECT '{name}' AS table_name, count(*) AS n_rows,
  CAST(max({time}) AS TIMESTAMP) AS latest, count(*) > 0 AS ok FROM ({source}) t_{name}"""


_PAST = f"({_NOW} - INTERVAL '10' DAY)"


def _closed(body: str) -> str:
    """The body at the past reference time; its ranges end there."""
    time = "processing_timestamp >= "
    return body.replace(time, f"processing_timestamp <= {_NOW} AND {time}").replace(_NOW, _PAST)


_STATISTIC = """SELECT '{c}' AS column_name, count({c}) AS n, round(avg({c}), 6) AS mean,
  round(stddev_samp({c}), 6) AS std, CAST(min({c}) AS VARCHAR) AS min, CAST(max({c}) AS VARCHAR) AS max,
  round(quantile_cont(CAST({c} AS DOUBLE), 0.25), 6) AS p25,
  round(quantile_cont(CAST({c} AS DOUBLE), 0.5), 6) AS p50,
  round(quantile_cont(CAST({c} AS DOUBLE), 0.75), 6) AS p75
FROM (SELECT *, CASE WHEN event_id % 7 = 0 THEN -value END AS sometimes,
        9007199254740993 + event_id % 1000 AS large,
        CAST(user_id AS DECIMAL(20, 4)) + CAST(0.0001 AS DECIMAL(20, 4)) AS price
      FROM events) e"""

_LINE = """'{' || concat_ws(',',
  '"user_id":' || to_json(user_id), '"movie_id":' || to_json(movie_id),
  '"event_type":' || to_json(event_type), '"timestamp":' || to_json("timestamp"),
  '"duration":' || duration_seconds) || '}'"""

_BODIES = {
    "processed_events": f"""SELECT event_id, {_RAW_COLUMNS}, processing_timestamp,
  original_timestamp, event_date, watch_category, is_valid, session_id FROM v""",
    "processed_table": f"SELECT {_PROCESSED_COLUMNS} FROM v",
    "decoded_events": f"SELECT {_RAW_COLUMNS} FROM v",
    "decoded_events_ext": f"""SELECT {_RAW_COLUMNS},
  CASE event_id % 3 WHEN 0 THEN 'eu' WHEN 1 THEN 'us' ELSE 'asia' END AS user_region,
  CASE event_id % 2 WHEN 0 THEN 'movie' ELSE 'series' END AS content_type,
  CAST(1000 + event_id % 5000 AS INTEGER) AS bitrate FROM v""",
    "consumed_fields": "SELECT user_id, event_type, movie_id FROM v",
    "json_lines_events": """SELECT user_id, movie_id, duration_seconds AS duration, event_type,
  "timestamp" FROM v""",
    "json_lines_sample": "SELECT least(count(*), 100) AS n_rows FROM v",
    "load_json_lines": f"""SELECT user_id, movie_id, duration_seconds, event_type,
  original_timestamp AS event_timestamp, {_NOW} AS created_at FROM v WHERE {_ACCEPTED}""",
    "load_two_files": f"""SELECT user_id, movie_id, duration_seconds, event_type,
  original_timestamp AS event_timestamp, {_NOW} AS created_at
FROM v, (VALUES (1), (2)) loads(n) WHERE {_ACCEPTED}""",
    "rejected_lines": f"""SELECT CASE WHEN {_BROKEN} THEN left(line, 20) ELSE line END AS raw_record
FROM (SELECT *, {_LINE} AS line FROM v) l WHERE NOT ({_ACCEPTED})""",
    "load_counts": f"""SELECT 'loaded' AS status, count(*) AS n FROM v WHERE {_ACCEPTED}
UNION ALL SELECT 'rejected', count(*) FROM v WHERE NOT ({_ACCEPTED})""",
    "category_counts": "SELECT watch_category, count(*) AS n FROM v GROUP BY watch_category",
    "movie_stats_1m": _movie_windows("minute"),
    "movie_stats_1h": _movie_windows("hour"),
    "movie_stats_1d": _movie_windows("day"),
    "device_stats_1m": _device_windows("minute"),
    "device_stats_1h": _device_windows("hour"),
    "movie_stats_stream": _movie_windows("minute"),
    "movie_stats_log": _movie_windows("day"),
    "device_stats_stream": _device_windows("hour"),
    "movie_stats_on_time": _movie_windows(
        "minute", f"(SELECT * FROM {_LAGGED} l WHERE coalesce({_MINUTE_END} > closed, true))"
    ),
    "movie_stats_corrected": _movie_windows("minute"),
    "device_stats_corrected": _device_windows("hour"),
    "late_rows": f"""SELECT event_id, movie_id, processing_timestamp, arrival AS batch_id
FROM {_LAGGED} l WHERE {_MINUTE_END} <= closed""",
    "retention_corrected": f"SELECT * FROM ({_RETENTION}) r WHERE event_date IS NOT NULL",
    "lake_stream": f"SELECT {_RAW_COLUMNS}, original_timestamp, session_id FROM v",
    "processed_stream": f"SELECT {_PROCESSED_COLUMNS} FROM v",
    "fact_stream": f"SELECT {_FACT_COLUMNS} FROM v",
    "user_metrics": _user_metrics("v"),
    "user_metrics_split": _user_metrics("v"),
    "user_metrics_ranges": _user_metrics("v"),
    "user_metrics_stream": _user_metrics("v", "original_timestamp IS NOT NULL"),
    "user_metrics_stream_late": _user_metrics(
        f"{_TIMED} l", "original_timestamp > coalesce(closed, TIMESTAMP '0001-01-01')"
    ),
    "user_metrics_stream_totals": f"""SELECT 'given_out' AS part, count(*) AS n FROM {_TIMED} l
WHERE original_timestamp > coalesce(closed, TIMESTAMP '0001-01-01')
UNION ALL SELECT 'late', count(*) FROM {_TIMED} l WHERE original_timestamp <= closed
UNION ALL SELECT 'waiting', 0
UNION ALL SELECT 'untimed', count(*) FROM v WHERE original_timestamp IS NULL""",
    "retention": _RETENTION,
    "retention_stream": f"""SELECT * FROM ({_RETENTION}) r
WHERE event_date < CAST((SELECT max(original_timestamp) FROM v WHERE event_type = 'start')
                        - INTERVAL '1' MINUTE AS DATE)""",
    "retention_7d": f"""SELECT * FROM ({_RETENTION}) r
WHERE event_date >= CAST({_NOW} AS DATE) - INTERVAL '7' DAY""",
    "latest_retention": f"""SELECT event_date, retention_rate FROM ({_RETENTION}) r
WHERE event_date >= CAST({_NOW} AS DATE) - INTERVAL '7' DAY ORDER BY event_date DESC LIMIT 1""",
    "fact_last_day": f"""SELECT {_FACT_COLUMNS} FROM v
WHERE processing_timestamp >= {_NOW} - INTERVAL '1' DAY""",
    "fact_load": f"""SELECT {_FACT_COLUMNS} FROM v
WHERE event_date IN {_AFFECTED} OR (event_date IS NULL
  AND CAST(processing_timestamp AS DATE) IN (
    SELECT CAST(processing_timestamp AS DATE) FROM v WHERE event_date IS NULL
      AND processing_timestamp >= {_NOW} - INTERVAL '1' DAY))""",
    "lake_changes": """SELECT CAST(processing_timestamp AS DATE) AS processing_date, event_date,
  count(*) AS n_rows FROM v GROUP BY 1, 2""",
    "daily_metrics": _DAILY.format(where="true"),
    "daily_metrics_table": _DAILY.format(where=f"event_date IN {_AFFECTED}"),
    "movie_popularity": _POPULARITY.format(now=_NOW, where="true"),
    "movie_popularity_table": _POPULARITY.format(
        now=_NOW, where=f"event_date IN {_AFFECTED}"
    ),
    "popularity_top": f"""SELECT * FROM (
  {_POPULARITY.format(now=_NOW, where=f"event_date IN {_AFFECTED}")}) p
ORDER BY total_views DESC, movie_id NULLS FIRST LIMIT 10""",
    "approx_daily_users": f"""SELECT metric_date, total_views, unique_users AS exact_users,
  true AS within_error FROM ({_DAILY.format(where="true")}) d""",
    "approx_movie_users": f"""SELECT movie_id, total_views, unique_users AS exact_users,
  true AS within_error FROM ({_POPULARITY.format(now=_NOW, where="true")}) p""",
    "rollup_daily_users": f"""SELECT metric_date, total_views, unique_users AS exact_users,
  true AS within_error FROM ({_DAILY.format(where=f"event_date IN {_AFFECTED}")}) d""",
    "rollup_movie_users": f"""SELECT movie_id, total_views, unique_users AS exact_users,
  true AS within_error FROM (
    {_POPULARITY.format(now=_NOW, where=f"event_date IN {_AFFECTED}")}) p""",
    "business_metrics": _business(_NOW),
    "business_metrics_table": f"""{_business(_NOW)}
UNION ALL {_business(_YESTERDAY)}""",
    "latest_business_metrics": _business(_NOW),
    "popular_movie": """SELECT movie_id AS popular_movie FROM v GROUP BY movie_id
ORDER BY count(*) DESC, movie_id NULLS FIRST LIMIT 1""",
    "top_movies_day": _REPORT,
    "report_document": _REPORT.replace("view_count", "views"),
    "last_hour_stats": f"""SELECT count(*) AS views, avg(duration_seconds) AS avg_duration,
  count(DISTINCT user_id) AS unique_users
FROM v WHERE processing_timestamp >= {_NOW} - INTERVAL '1' HOUR""",
    "hourly_summary": f"""SELECT (SELECT count(*) FROM v) AS total_rows, count(*) AS views,
  avg(duration_seconds) AS avg_duration, count(DISTINCT user_id) AS unique_users
FROM v WHERE processing_timestamp >= {_NOW} - INTERVAL '1' HOUR""",
    "load_summary": """SELECT count(*) AS total_records, count(DISTINCT user_id) AS unique_users,
  count(DISTINCT movie_id) AS unique_movies FROM v""",
    "row_count": "SELECT count(*) AS n_rows FROM v",
    "headline_metrics": """SELECT CAST(count(*) AS DOUBLE) AS total_views,
  CAST(count(DISTINCT user_id) AS DOUBLE) AS unique_users,
  coalesce(avg(duration_seconds), 0) AS avg_duration FROM v""",
    "recent_events": """SELECT user_id, movie_id, event_type, original_timestamp FROM v
WHERE original_timestamp IS NOT NULL ORDER BY original_timestamp DESC, session_id LIMIT 5""",
    "kpi_rows": _KPIS,
    "kpi_table": f"SELECT *, {_NOW} AS calculated_at FROM ({_KPIS}) k",
    "null_check": _CHECKS[0],
    "latency_check": _CHECKS[1],
    "drop_check": _CHECKS[2],
    "monitor_checks": "\nUNION ALL ".join(_CHECKS),
    "alerts": _ALERT_ROWS,
    "alerts_table": _ALERT_ROWS,
    "views_by_device_24h": f"""SELECT date_trunc('hour', processing_timestamp) AS period, device,
  count(*) AS views
FROM v WHERE processing_timestamp >= {_NOW} - INTERVAL '24' HOUR GROUP BY 1, 2""",
    "top_movies_chart": """SELECT movie_id, count(user_id) AS view_count FROM v
GROUP BY movie_id ORDER BY view_count DESC, movie_id NULLS LAST LIMIT 10""",
    "table_verification": "\nUNION ALL ".join(
        [
            _verified("device_stats_realtime", _device_windows("hour"), "window_end"),
            _verified("movie_stats_realtime", _movie_windows("hour"), "window_end"),
            _verified("user_views_processed", "SELECT * FROM v", "processing_timestamp"),
        ]
    ),
    "column_types": _TYPES,
    "column_statistics": _STATS,
    "declared_table": f"""SELECT user_id, movie_id, duration_seconds, event_type,
  original_timestamp AS event_timestamp, {_NOW} AS created_at FROM v""",
}


_BODIES |= {
    "top_movies_chart_stored": _BODIES["top_movies_chart"],
    "lake_stream_ext": f"""{_BODIES["processed_events"].rsplit(" FROM v", 1)[0]},
  CASE event_id % 3 WHEN 0 THEN 'eu' WHEN 1 THEN 'us' ELSE 'asia' END AS user_region,
  CASE event_id % 2 WHEN 0 THEN 'movie' ELSE 'series' END AS content_type,
  CAST(1000 + event_id % 5000 AS INTEGER) AS bitrate FROM v""",
    "past_hour_stats": _closed(_BODIES["last_hour_stats"]),
    "past_hourly_summary": _closed(_BODIES["hourly_summary"]),
    "past_last_day": _closed(_BODIES["fact_last_day"]),
    "past_popularity": _POPULARITY.format(now=_PAST, where="true"),
    "past_top_movies": _closed(_REPORT),
    "past_checks": "\nUNION ALL ".join(map(_closed, _CHECKS)),
    "past_views_by_device": _closed(_BODIES["views_by_device_24h"]),
    "past_retention": f"""SELECT * FROM ({_RETENTION}) r
WHERE event_date BETWEEN CAST({_PAST} AS DATE) - INTERVAL '7' DAY AND CAST({_PAST} AS DATE)""",
    "past_business_metrics": _business(_PAST),
    "column_statistics_mixed": "\nUNION ALL ".join(
        _STATISTIC.format(c=c) for c in ("user_id", "value", "sometimes")
    ),
    "column_statistics_exact": "\nUNION ALL ".join(
        _STATISTIC.format(c=c) for c in ("large", "value", "price")
    )
    .replace("stddev_samp(large)", "stddev_samp(large - 9007199254740993)")
    .replace("round(avg(large), 6)", "avg(large - 9007199254740993) + 9007199254740993"),
}


def oracle_sql() -> dict[str, str]:
    return {name: f"{_VIEWS}\n{body}" for name, body in _BODIES.items()}
