"""DuckDB SQL of the queries in ``catalog_live``."""

from __future__ import annotations

from beatstream.plans.oracle import VIEWS, with_views


def moment(i: int, parts: int) -> str:
    """The i-th of the moments that cut the events' time range into ``parts``."""
    return (f"(SELECT make_timestamp((epoch_us(min(ts)) + (epoch_us(max(ts)) - epoch_us(min(ts))) * {i} // {parts})"
            " // 1000000 * 1000000) FROM events)")


PARSED_GOOD = """
SELECT event_id, customer_id, track_id, datetime, ismobile, listening_zip_code
FROM parsed_lines WHERE reject_reason IS NULL"""

# the lines with their host and place in its log
_PLACED = VIEWS["play_lines"].replace("END AS value", "END AS value, ts, event_id, user_id % 8 AS host,"
                                      " NOT (event_type = 'error' AND value > 80 AND value <= 90) AS timed", 1) \
    .replace("SELECT event_type, value, ts,", "SELECT event_type, value, ts, event_id, user_id,", 1)

LIVE_ORACLE = {
    "follow_play_log": with_views(["parsed_lines"], PARSED_GOOD),
    "follow_from_earliest": with_views(["play_lines"], "SELECT value FROM play_lines"),
    "follow_from_latest": f"WITH placed AS ({_PLACED})\nSELECT value FROM placed WHERE ts > {moment(1, 3)}",
    "follow_from_time": f"""WITH placed AS ({_PLACED}),
starts AS (SELECT host, min((ts, event_id)) AS first_line FROM placed
          WHERE timed AND date_trunc('second', ts) >= {moment(1, 2)} GROUP BY host)
SELECT value FROM placed JOIN starts USING (host) WHERE (ts, event_id) >= first_line""",
}

_KEYED = """
  SELECT user_id % 200 AS customer_id, CAST(json_extract_string(props, '$.k') AS BIGINT) % 5 AS track_id, epoch_us(ts) AS us
  FROM events"""
_DAY = 24 * 3600 * 1_000_000
LIVE_ORACLE["stream_repeat_state"] = f"""
WITH p AS (SELECT * FROM ({_KEYED}) WHERE customer_id IS NOT NULL AND track_id IS NOT NULL),
mark AS (SELECT max(us) // 1000 - {_DAY // 1000} AS ms FROM p),
runs AS (SELECT customer_id, track_id, us, us - lag(us, 3) OVER (PARTITION BY customer_id, track_id ORDER BY us) AS gap FROM p),
keys AS (SELECT customer_id, track_id, max(us) AS newest, min(us) FILTER (WHERE gap <= {_DAY}) AS found
         FROM runs GROUP BY customer_id, track_id)
SELECT 'reported' AS kind, customer_id, track_id, newest AS number FROM keys, mark WHERE found // 1000 + 1 <= ms
UNION ALL
SELECT 'waiting', customer_id, track_id, count(*) FROM p JOIN keys USING (customer_id, track_id), mark
WHERE found IS NULL AND (us // {_DAY} + 2) * {_DAY} // 1000 > ms GROUP BY customer_id, track_id"""

_WIDTHS = ("1 hour", "6 hours", "1 day")
LIVE_ORACLE["rollup_mobile_trend"] = with_views(["plays"], "\nUNION ALL\n".join(f"""
SELECT '{w}' AS width, time_bucket(INTERVAL '{w}', datetime) AS bucket_start, COUNT(*) AS plays,
       CAST(SUM(ismobile) AS BIGINT) AS mobile_connections, COUNT(DISTINCT customer_id) AS unique_customers, true AS within
FROM plays GROUP BY 2""" for w in _WIDTHS))

# the narrowest of these widths (seconds) with at most 50 buckets
LIVE_ORACLE["rollup_trend_auto"] = with_views(["plays"], """
, ends AS (SELECT min(epoch(date_trunc('hour', datetime)))::bigint AS a, max(epoch(date_trunc('hour', datetime)))::bigint AS b
           FROM plays),
width AS (SELECT coalesce(min(w), 604800) AS w FROM (VALUES (3600), (10800), (43200), (86400), (604800)) t(w), ends
          WHERE b - a + 3600 <= w * 50)
SELECT make_timestamp(epoch(datetime)::bigint // w * w * 1000000) AS bucket_start, COUNT(*) AS plays,
       CAST(SUM(ismobile) AS BIGINT) AS mobile_connections
FROM plays, width GROUP BY 1""")

LIVE_ORACLE["stream_wait_for_customers"] = with_views(["plays", "customers"], """
, begin AS (SELECT min(ts) AS t FROM events)
SELECT p.*, c.name, c.age, c.gender, c.zip, c.Address, c.SignDate, c.Status, c.Level, c.Campaign, c.LinkedWithApps
FROM plays p CROSS JOIN begin LEFT JOIN customers c
  ON p.customer_id = c.customer_id AND t + to_hours(c.customer_id % 49) <= p.datetime + INTERVAL 12 HOURS""")

LIVE_ORACLE["stream_observed_flow"] = with_views(["parsed_lines", "customers", "predictions"], """
, seen AS (SELECT l.reject_reason, c.name, pr.pred FROM parsed_lines l
           LEFT JOIN (SELECT * FROM customers WHERE Status = '1') c ON l.customer_id = c.customer_id
           LEFT JOIN predictions pr ON l.customer_id = pr.customer_id)
SELECT 'flow_lines' AS metric, 'lines' AS attribute, COUNT(*) AS total FROM seen
UNION ALL SELECT 'flow_lines', 'quarantined', COUNT(*) FILTER (WHERE reject_reason IS NOT NULL) FROM seen
UNION ALL SELECT 'flow_plays', 'plays', COUNT(*) FILTER (WHERE reject_reason IS NULL) FROM seen
UNION ALL SELECT 'flow_plays', 'missing_customers', COUNT(*) FILTER (WHERE reject_reason IS NULL AND name IS NULL) FROM seen
UNION ALL SELECT 'flow_plays', 'flagged', COUNT(*) FILTER (WHERE reject_reason IS NULL AND pred = 1) FROM seen""")

LIVE_ORACLE["metric_rollup"] = """
SELECT event_type AS alias, 'events' AS metric, 'user' || (user_id % 3) AS attribute,
       time_bucket(INTERVAL '1 hour', ts) AS bucket_start, avg(CAST(event_id % 97 AS DOUBLE)) AS avg_value,
       max(CAST(event_id % 97 AS DOUBLE)) AS max_value, COUNT(*) AS samples
FROM events GROUP BY 1, 2, 3, 4"""
