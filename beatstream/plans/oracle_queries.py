"""DuckDB statements matching ``beatstream.plans.catalog.QUERIES`` (same names).

Queries left out here have no exact SQL form (approximate counts, libSVM rounding, trained
coefficients, run times); where they have deterministic facts, a query next to them states
those and has a statement here.
"""

from __future__ import annotations

from beatstream.functions.scalar import AGE_DECADES
from beatstream.plans.oracle import with_views
from beatstream.plans.oracle_live import LIVE_ORACLE
from beatstream.schemas import FEATURE_NAMES

DAYPART_CASE = ("CASE WHEN h < 5 THEN 'night' WHEN h < 12 THEN 'morn' WHEN h < 17 THEN 'aft' "
                "WHEN h < 22 THEN 'eve' ELSE 'night' END")

ENRICHED_COLS = ("event_id, customer_id, track_id, datetime, ismobile, listening_zip_code, name, age, "
                 "gender, zip, Address, SignDate, Status, Level, Campaign, LinkedWithApps")


def _nested_top(outer: str, inner: str, src: str, outer_count: str, inner_count: str,
                n_outer: int = 5, n_inner: int = 5) -> str:
    return f"""
, oc AS (SELECT {outer}, COUNT(*) AS {outer_count} FROM {src} WHERE {outer} IS NOT NULL GROUP BY 1),
top AS (SELECT *, CAST(ROW_NUMBER() OVER (ORDER BY {outer_count} DESC, {outer}) AS INTEGER) AS {outer}_rank
        FROM oc QUALIFY {outer}_rank <= {n_outer}),
pc AS (SELECT {outer}, {inner}, COUNT(*) AS {inner_count} FROM {src}
       WHERE {outer} IS NOT NULL AND {inner} IS NOT NULL GROUP BY 1, 2)
SELECT t.{outer}, t.{outer_count}, t.{outer}_rank, pc.{inner}, pc.{inner_count},
       CAST(ROW_NUMBER() OVER (PARTITION BY pc.{outer} ORDER BY pc.{inner_count} DESC, pc.{inner}) AS INTEGER)
         AS {inner}_rank
FROM pc JOIN top t ON pc.{outer} = t.{outer}
QUALIFY {inner}_rank <= {n_inner}"""


def _ranges_values(ranges) -> str:
    rows = []
    for lo, hi in ranges:
        label = f"{'*' if lo is None else lo}-{'*' if hi is None else hi}"
        rows.append(f"('{label}', {'NULL' if lo is None else lo}, {'NULL' if hi is None else hi})")
    return "(VALUES " + ", ".join(rows) + ") r(label, lo, hi)"


def _range_terms(term: str, ranges) -> str:
    return with_views(["enriched"], f"""
SELECT r.label AS age_range, CAST(r.lo AS DOUBLE) AS age_range_from, CAST(r.hi AS DOUBLE) AS age_range_to,
       e.{term}, COUNT(*) AS plays,
       CAST(ROW_NUMBER() OVER (PARTITION BY r.label ORDER BY COUNT(*) DESC, e.{term}) AS INTEGER) AS {term}_rank
FROM enriched e JOIN {_ranges_values(ranges)}
  ON (r.lo IS NULL OR e.age >= r.lo) AND (r.hi IS NULL OR e.age < r.hi)
WHERE e.{term} IS NOT NULL
GROUP BY 1, 2, 3, 4
QUALIFY {term}_rank <= 5""")


APPLINK_AGE_RANGES = [(0, 10), (10, 20), (20, 30), (30, 40), (50, None)]
LEVEL_AGE_RANGES = [(0, 8), (8, 14), (14, 20), (20, 30), (30, 40), (50, None)]
CUSTOMER_AGE_RANGES = [(None, 18), (18, 35), (30, 50), (65, None)]

RECENT = "datetime >= (SELECT MAX(datetime) FROM plays) - INTERVAL 15 MINUTE AND datetime <= (SELECT MAX(datetime) FROM plays)"

PROFILE_LAST = """
  SELECT customer_id, COUNT(DISTINCT track_id) AS unique_tracks,
         CAST(arg_max(dp, (datetime, event_id)) = 'morn' AS BIGINT) AS morn,
         CAST(arg_max(dp, (datetime, event_id)) = 'aft' AS BIGINT) AS aft,
         CAST(arg_max(dp, (datetime, event_id)) = 'eve' AS BIGINT) AS eve,
         CAST(arg_max(dp, (datetime, event_id)) = 'night' AS BIGINT) AS night,
         CAST(arg_max(ismobile, (datetime, event_id)) AS BIGINT) AS mobile
  FROM (SELECT *, """ + DAYPART_CASE + """ AS dp FROM (SELECT *, hour(datetime) AS h FROM plays))
  GROUP BY customer_id"""

REPEAT = """
SELECT customer_id, track_id, MIN(datetime) AS first_detected, COUNT(*) AS qualifying_plays
FROM (SELECT customer_id, track_id, datetime,
             epoch_us(datetime) - LAG(epoch_us(datetime), 2) OVER (
               PARTITION BY customer_id, track_id ORDER BY datetime, event_id) AS gap
      FROM {src})
WHERE gap <= {horizon_us}
GROUP BY 1, 2"""

COARSE = "(SELECT event_id, customer_id, track_id % 5 AS track_id, datetime FROM plays)"

ORACLE: dict[str, str] = {
    # dashboards
    "count_docs": with_views(["plays"], "SELECT COUNT(*) AS doc_count FROM plays"),
    "mobile_trend": with_views(["plays"], """
SELECT time_bucket(INTERVAL '1 hour', datetime) AS bucket_start,
       CAST(SUM(ismobile) AS BIGINT) AS mobile_connections,
       COUNT(DISTINCT customer_id) AS unique_customers
FROM plays GROUP BY 1"""),
    "connections_per_minute": with_views(["plays"], """
SELECT time_bucket(INTERVAL '1 minute', datetime) AS minute_start, COUNT(*) AS connections
FROM plays GROUP BY 1"""),
    "top_regions_and_users": with_views(
        ["plays"], _nested_top("listening_zip_code", "customer_id", "plays", "zip_count", "plays")),
    "terms_zip": with_views(["plays"], """
SELECT listening_zip_code, COUNT(*) AS plays FROM plays WHERE listening_zip_code IS NOT NULL
GROUP BY 1 ORDER BY plays DESC, listening_zip_code LIMIT 5"""),
    "level_gender_trend": with_views(["enriched"], """
, lv AS (SELECT Level FROM enriched WHERE Level IS NOT NULL GROUP BY Level ORDER BY COUNT(*) DESC, Level LIMIT 5)
SELECT Level, time_bucket(INTERVAL '1 day', datetime) AS bucket_start, gender, COUNT(*) AS plays,
       CAST(ROW_NUMBER() OVER (PARTITION BY Level, time_bucket(INTERVAL '1 day', datetime)
                               ORDER BY COUNT(*) DESC, gender) AS INTEGER) AS gender_rank
FROM enriched WHERE gender IS NOT NULL AND Level IN (SELECT Level FROM lv)
GROUP BY 1, 2, 3 QUALIFY gender_rank <= 5"""),
    "applink_by_age": _range_terms("LinkedWithApps", APPLINK_AGE_RANGES),
    "level_by_age": _range_terms("Level", LEVEL_AGE_RANGES),
    "range_bucket": with_views(["customers"], f"""
SELECT r.label AS age_range, CAST(r.lo AS DOUBLE) AS age_range_from, CAST(r.hi AS DOUBLE) AS age_range_to,
       COUNT(*) AS customers
FROM customers c JOIN {_ranges_values(CUSTOMER_AGE_RANGES)}
  ON (r.lo IS NULL OR c.age >= r.lo) AND (r.hi IS NULL OR c.age < r.hi)
GROUP BY 1, 2, 3"""),
    "demographics": with_views(["enriched"], """
, pairs AS (
  SELECT 'gender' AS dimension, gender AS value FROM enriched
  UNION ALL SELECT 'age_group', CAST(CAST(floor(age / 10) * 10 AS BIGINT) AS VARCHAR) FROM enriched
  UNION ALL SELECT 'device', CASE WHEN ismobile = 1 THEN 'mobile' ELSE 'pc' END FROM enriched
  UNION ALL SELECT 'hour', CAST(hour(datetime) AS VARCHAR) FROM enriched),
counts AS (SELECT dimension, value, COUNT(*) AS plays FROM pairs WHERE value IS NOT NULL GROUP BY 1, 2)
SELECT dimension, value, plays, plays / CAST(SUM(plays) OVER (PARTITION BY dimension) AS DOUBLE) AS share
FROM counts"""),
    "share_by_level": with_views(["enriched"], f"""
, counts AS (
  SELECT r.label AS age_range, e.Level, COUNT(*) AS plays
  FROM enriched e JOIN {_ranges_values(LEVEL_AGE_RANGES)}
    ON (r.lo IS NULL OR e.age >= r.lo) AND (r.hi IS NULL OR e.age < r.hi)
  GROUP BY 1, 2)
SELECT age_range, Level, plays, plays / CAST(SUM(plays) OVER (PARTITION BY age_range) AS DOUBLE) AS share
FROM counts"""),
    "recent_plays": with_views(["plays"], f"SELECT * FROM plays WHERE {RECENT}"),
    "discover_view": with_views(["plays"], f"""
SELECT datetime, customer_id, track_id, listening_zip_code, ismobile FROM plays WHERE {RECENT}
ORDER BY datetime DESC"""),
    # parsing and joins
    "parse_plays": with_views(["parsed_lines"], """
SELECT event_id, customer_id, track_id, datetime, ismobile, listening_zip_code
FROM parsed_lines WHERE reject_reason IS NULL"""),
    "quarantine_lines": with_views(["parsed_lines"], """
SELECT raw, reject_reason FROM parsed_lines WHERE reject_reason IS NOT NULL"""),
    "enrich_plays": with_views(["enriched"], f"SELECT {ENRICHED_COLS} FROM enriched"),
    "enrich_parsed_lines": with_views(["parsed_lines", "customers"], """
SELECT p.event_id, p.customer_id, p.track_id, p.datetime, p.ismobile, p.listening_zip_code,
       c.name, c.age, c.gender, c.zip, c.Address, c.SignDate, c.Status, c.Level, c.Campaign, c.LinkedWithApps
FROM parsed_lines p LEFT JOIN customers c ON p.customer_id = c.customer_id
WHERE p.reject_reason IS NULL"""),
    "enrich_active_only": with_views(["plays", "customers"], """
SELECT p.*, c.name, c.age, c.gender, c.zip, c.Address, c.SignDate, c.Status, c.Level, c.Campaign, c.LinkedWithApps
FROM plays p JOIN customers c ON p.customer_id = c.customer_id WHERE c.Status = '1'"""),
    "missing_customers": with_views(["plays", "customers"], """
SELECT customer_id, COUNT(*) AS plays FROM plays
WHERE customer_id NOT IN (SELECT customer_id FROM customers WHERE Status = '1' AND customer_id IS NOT NULL)
GROUP BY 1"""),
    "flag_ad_targets": with_views(["enriched", "predictions"], f"""
SELECT e.event_id, e.customer_id, e.track_id, e.datetime, e.ismobile, e.listening_zip_code, e.name, e.age,
       e.gender, e.zip, e.Address, e.SignDate, e.Status, e.Level, e.Campaign, e.LinkedWithApps,
       p.pred AS SendEvent
FROM enriched e LEFT JOIN predictions p ON e.customer_id = p.customer_id"""),
    "is_member": with_views(["customers", "predictions"], """
SELECT c.customer_id, c.Level,
       CASE WHEN c.customer_id IN (SELECT customer_id FROM predictions WHERE pred = 1) THEN 1 ELSE 0 END
         AS is_member
FROM customers c"""),
    "enrich_tracks": with_views(["plays", "music"], """
SELECT p.*, m.Title, m.Artist, m.Length FROM plays p LEFT JOIN music m ON p.track_id = m.TrackId"""),
    # scalar projections
    "daypart_of_plays": with_views(["plays"], f"""
SELECT event_id, customer_id, h AS hour, {DAYPART_CASE} AS daypart
FROM (SELECT *, CAST(hour(datetime) AS INTEGER) AS h FROM plays)"""),
    "ad_match": with_views(["clicks"], """
SELECT EventID, CustID, CAST(contains(AdClicked, 'ADV_REDUCED_1DAY') AS INTEGER) AS matched FROM clicks"""),
    "ad_match_exact": with_views(["clicks"], """
SELECT EventID, CustID, AdClicked FROM clicks WHERE AdClicked = 'ADV_REDUCED_1DAY'"""),
    "retail_cost": with_views(["retail"], "SELECT *, UnitPrice * Quantity AS total_cost FROM retail"),
    "hashtags": with_views(["messages"], """
SELECT msg_id, tag FROM (
  SELECT msg_id, regexp_replace(lower(regexp_replace(token, '[,.!?:;]', '', 'g')), '^#', '') AS tag
  FROM (SELECT msg_id, unnest(regexp_split_to_array(text, '\\s+')) AS token FROM messages)
  WHERE starts_with(token, '#'))
WHERE tag <> ''"""),
    "decode_payload": with_views(["play_lines"], "SELECT value FROM play_lines"),
    # profiles and features
    "listening_profile": with_views(["profile"], "SELECT * FROM profile"),
    "listening_profile_last": with_views(["plays"], PROFILE_LAST),
    "click_counts": with_views(["click_counts"], "SELECT * FROM click_counts"),
    "sorted_click_counts": with_views(["click_counts"], "SELECT * FROM click_counts ORDER BY CAST(customer_id AS VARCHAR)"),
    "label_from_clicks": with_views(["profile", "click_counts"], """
SELECT p.*, CASE WHEN COALESCE(c.clicks, 0) > 0 THEN 1 ELSE 0 END AS label
FROM profile p LEFT JOIN click_counts c ON p.customer_id = c.customer_id"""),
    "feature_ratios": with_views(["profile"], """
SELECT customer_id,
       morn / CAST(morn + aft + eve + night AS DOUBLE) AS morn,
       aft / CAST(morn + aft + eve + night AS DOUBLE) AS aft,
       eve / CAST(morn + aft + eve + night AS DOUBLE) AS eve,
       night / CAST(morn + aft + eve + night AS DOUBLE) AS night,
       mobile / CAST(morn + aft + eve + night AS DOUBLE) AS mobile,
       unique_tracks / CAST(morn + aft + eve + night AS DOUBLE) AS "unique"
FROM profile"""),
    "build_features": with_views(["features"], "SELECT * FROM features"),
    "profile_averages": with_views(["profile"], """
SELECT AVG(unique_tracks) AS avg_unique_tracks, AVG(morn) AS avg_morn, AVG(aft) AS avg_aft,
       AVG(eve) AS avg_eve, AVG(night) AS avg_night, AVG(mobile) AS avg_mobile, COUNT(*) AS customers
FROM profile"""),
    "ad_audience": with_views(["customers", "predictions"], """
SELECT customer_id, Level FROM customers
WHERE TRY_CAST(Level AS INTEGER) < 2 AND customer_id IN (SELECT customer_id FROM predictions WHERE pred = 1)"""),
    # listening statistics
    "top_tracks_by_gender": with_views(["enriched"], """
SELECT gender, track_id, COUNT(*) AS plays,
       CAST(ROW_NUMBER() OVER (PARTITION BY gender ORDER BY COUNT(*) DESC, track_id) AS INTEGER) AS rank
FROM enriched
WHERE gender IS NOT NULL
  AND datetime >= (SELECT MAX(datetime) FROM enriched) - INTERVAL 30 HOUR
  AND datetime <= (SELECT MAX(datetime) FROM enriched)
GROUP BY 1, 2 QUALIFY rank <= 10"""),
    "daypart_average": with_views(["plays"], """
, pd AS (
  SELECT customer_id, CAST(datetime AS DATE) AS day,
         COUNT(*) FILTER (WHERE h >= 5 AND h < 12) AS morn,
         COUNT(*) FILTER (WHERE h >= 12 AND h < 17) AS aft,
         COUNT(*) FILTER (WHERE h >= 17 AND h < 22) AS eve,
         COUNT(*) FILTER (WHERE h < 5 OR h >= 22) AS night
  FROM (SELECT *, hour(datetime) AS h FROM plays) GROUP BY 1, 2),
pc AS (
  SELECT customer_id, COUNT(*) AS active_days,
         SUM(morn) / CAST(COUNT(*) AS DOUBLE) AS morn_per_day, SUM(aft) / CAST(COUNT(*) AS DOUBLE) AS aft_per_day,
         SUM(eve) / CAST(COUNT(*) AS DOUBLE) AS eve_per_day, SUM(night) / CAST(COUNT(*) AS DOUBLE) AS night_per_day
  FROM pd GROUP BY 1)
SELECT *, CASE greatest(morn_per_day, aft_per_day, eve_per_day, night_per_day)
            WHEN morn_per_day THEN 'morn' WHEN aft_per_day THEN 'aft'
            WHEN eve_per_day THEN 'eve' ELSE 'night' END AS favourite_daypart
FROM pc"""),
    "distinct_tracks": with_views(["plays"], "SELECT DISTINCT track_id FROM plays WHERE track_id IS NOT NULL"),
    "distinct_mobile_tracks": with_views(["plays"],
                                         "SELECT DISTINCT track_id FROM plays WHERE ismobile = 1 AND track_id IS NOT NULL"),
    "access_stats": with_views(["plays"], """
SELECT window_start, window_start + INTERVAL 30 MINUTE AS window_end, COUNT(*) AS plays,
       COUNT(DISTINCT customer_id) AS unique_customers, CAST(SUM(ismobile) AS BIGINT) AS mobile_plays
FROM (SELECT p.*, time_bucket(INTERVAL 5 MINUTE, datetime) - k * INTERVAL 5 MINUTE AS window_start
      FROM plays p, range(0, 6) r(k))
GROUP BY window_start"""),
    "repeat_listens": with_views(["plays"], REPEAT.format(src="plays", horizon_us=30 * 60 * 1_000_000)),
    "repeat_listens_coarse": with_views(["plays"], REPEAT.format(src=COARSE, horizon_us=24 * 3600 * 1_000_000)),
    "kth_previous_gap": with_views(["plays"], f"""
SELECT customer_id, track_id, event_id, datetime,
       CASE WHEN gap <= {24 * 3600 * 1_000_000} THEN gap / CAST(1000000 AS DOUBLE) END AS gap_seconds
FROM (SELECT *, epoch_us(datetime) - LAG(epoch_us(datetime), 2) OVER (
        PARTITION BY customer_id, track_id ORDER BY datetime, event_id) AS gap
      FROM {COARSE})"""),
    # tags, retail, sets
    "tag_counts": with_views(["messages"], """
SELECT tag, COUNT(*) AS amount FROM (
  SELECT regexp_replace(lower(regexp_replace(token, '[,.!?:;]', '', 'g')), '^#', '') AS tag
  FROM (SELECT unnest(regexp_split_to_array(text, '\\s+')) AS token FROM messages)
  WHERE starts_with(token, '#'))
WHERE tag <> '' GROUP BY tag"""),
    "trending_tags": with_views(["messages"], """
SELECT tag, COUNT(*) AS amount FROM (
  SELECT regexp_replace(lower(regexp_replace(token, '[,.!?:;]', '', 'g')), '^#', '') AS tag
  FROM (SELECT unnest(regexp_split_to_array(text, '\\s+')) AS token FROM messages)
  WHERE starts_with(token, '#'))
WHERE tag <> '' GROUP BY tag ORDER BY amount DESC, tag LIMIT 10"""),
    "daily_spend": with_views(["retail"], """
SELECT CustomerId, time_bucket(INTERVAL '1 day', InvoiceDate) AS day_start,
       CAST(SUM(CAST(UnitPrice * Quantity AS DECIMAL(18, 2))) AS DOUBLE) AS total_cost
FROM retail GROUP BY 1, 2"""),
    "top_spenders": with_views(["retail"], """
SELECT CustomerId, time_bucket(INTERVAL '1 day', InvoiceDate) AS day_start,
       CAST(SUM(CAST(UnitPrice * Quantity AS DECIMAL(18, 2))) AS DOUBLE) AS total_cost
FROM retail GROUP BY 1, 2 ORDER BY total_cost DESC, CustomerId, day_start LIMIT 5"""),
    "union_sources": with_views(["plays"], "SELECT * FROM plays"),
    "new_members": with_views(["customers", "predictions"], """
SELECT DISTINCT customer_id FROM predictions WHERE pred = 1
  AND customer_id NOT IN (SELECT customer_id FROM customers WHERE Level = '2' AND customer_id IS NOT NULL)"""),
}

# --- sources, sinks and streams ------------------------------------------------------------

PARSED_GOOD = """
SELECT event_id, customer_id, track_id, datetime, ismobile, listening_zip_code
FROM parsed_lines WHERE reject_reason IS NULL"""

STREAM_FLAGGED = """
SELECT p.event_id, p.customer_id, p.track_id, p.datetime, p.ismobile, p.listening_zip_code,
       c.name, c.age, c.gender, c.zip, c.Address, c.SignDate, c.Status, c.Level, c.Campaign, c.LinkedWithApps,
       pr.pred AS SendEvent
FROM parsed_lines p LEFT JOIN customers c ON p.customer_id = c.customer_id
LEFT JOIN predictions pr ON p.customer_id = pr.customer_id
WHERE p.reject_reason IS NULL"""

TAG_ROWS = """
SELECT ts, regexp_replace(lower(regexp_replace(token, '[,.!?:;]', '', 'g')), '^#', '') AS tag
FROM (SELECT ts, unnest(regexp_split_to_array(text, '\\s+')) AS token FROM messages)
WHERE starts_with(token, '#')"""

ORACLE.update({
    "read_plays_file": with_views(["parsed_lines"], PARSED_GOOD),
    "read_clicks_csv": with_views(["clicks"], "SELECT * FROM clicks"),
    "read_customers_csv": with_views(["customers"], "SELECT * FROM customers"),
    "read_music_csv": with_views(["music"], "SELECT * FROM music"),
    "read_retail_infer": ORACLE["daily_spend"],
    "upsert_customers": with_views(["customers"], "SELECT * FROM customers"),
    "set_predictions": with_views(["predictions"], "SELECT * FROM predictions"),
    "stream_parse_lines": with_views(["parsed_lines"], PARSED_GOOD),
    "stream_ad_flags": with_views(["parsed_lines", "customers", "predictions"], STREAM_FLAGGED),
    "stream_audience": with_views(["parsed_lines", "predictions"], """
SELECT DISTINCT p.customer_id FROM parsed_lines p JOIN predictions pr ON p.customer_id = pr.customer_id
WHERE p.reject_reason IS NULL AND pr.pred = 1"""),
    "stream_trending_tags": with_views(["messages"], f"""
, tags AS ({TAG_ROWS}),
w AS (SELECT time_bucket(INTERVAL 20 MINUTE, ts) - k * INTERVAL 20 MINUTE AS window_start, tag
      FROM tags, range(0, 3) r(k) WHERE tag <> ''),
c AS (SELECT window_start, window_start + INTERVAL 60 MINUTE AS window_end, tag, COUNT(*) AS amount
      FROM w GROUP BY 1, 2, 3)
SELECT window_start, window_end, CAST(ROW_NUMBER() OVER (PARTITION BY window_start ORDER BY amount DESC, tag)
       AS INTEGER) AS rank, tag, amount
FROM c
QUALIFY rank <= 10"""),
    "stream_dedup": "SELECT DISTINCT event_id, user_id, event_type FROM events",
    "stream_tumbling_counts": f"""
SELECT time_bucket(INTERVAL 1 HOUR, ts) AS bucket_start, event_type, COUNT(*) AS events
FROM events GROUP BY 1, 2""",
    "stream_repeat_listens": with_views(["plays"], """
SELECT customer_id, track_id, first_detected FROM (""" + REPEAT.format(src=COARSE, horizon_us=24 * 3600 * 1_000_000)
                                        + ")"),
})

ORACLE["stream_publish_lines"] = with_views(["play_lines"], "SELECT value FROM play_lines")

_LADDER = [1, 5, 10, 30, 60, 300, 600, 1800, 3600, 10800, 43200, 86400, 604800]
_WIDTH = ("CASE " + " ".join(f"WHEN span_s <= {w * 100} THEN {w}" for w in _LADDER[:-1])
          + f" ELSE {_LADDER[-1]} END")
ORACLE["mobile_trend_auto"] = with_views(["plays"], f"""
, w AS (SELECT CAST({_WIDTH} AS BIGINT) * 1000000 AS width_us
        FROM (SELECT (MAX(epoch_us(datetime)) - MIN(epoch_us(datetime))) / 1000000.0 AS span_s FROM plays))
SELECT make_timestamp(epoch_us(datetime) - (epoch_us(datetime) % w.width_us)) AS bucket_start,
       CAST(SUM(ismobile) AS BIGINT) AS mobile_connections, COUNT(DISTINCT customer_id) AS unique_customers,
       COUNT(*) AS plays
FROM plays, w GROUP BY 1""")

ORACLE["stream_access_stats"] = with_views(["plays"], f"""
SELECT window_start, window_start + INTERVAL 30 MINUTE AS window_end, COUNT(*) AS plays,
       CAST(SUM(ismobile) AS BIGINT) AS mobile_plays
FROM (SELECT p.*, time_bucket(INTERVAL 5 MINUTE, datetime) - k * INTERVAL 5 MINUTE AS window_start
      FROM plays p, range(0, 6) r(k))
GROUP BY window_start""")

ORACLE["stream_top_tracks_by_gender"] = with_views(["enriched"], f"""
, w AS (SELECT time_bucket(INTERVAL 1 HOUR, datetime) - k * INTERVAL 1 HOUR AS window_start, gender, track_id
        FROM enriched, range(0, 30) r(k) WHERE gender IS NOT NULL),
c AS (SELECT window_start, window_start + INTERVAL 30 HOUR AS window_end, gender, track_id, COUNT(*) AS plays
      FROM w GROUP BY 1, 2, 3, 4)
SELECT window_start, window_end, gender, track_id, plays,
       CAST(ROW_NUMBER() OVER (PARTITION BY window_start, gender ORDER BY plays DESC, track_id) AS INTEGER) AS rank
FROM c
QUALIFY rank <= 10""")

ORACLE["dashboard_on_index"] = with_views(["parsed_lines", "customers"], f"""
, idx AS (
  SELECT p.*, c.age, c.LinkedWithApps FROM parsed_lines p LEFT JOIN customers c ON p.customer_id = c.customer_id
  WHERE p.reject_reason IS NULL)
SELECT r.label AS age_range, CAST(r.lo AS DOUBLE) AS age_range_from, CAST(r.hi AS DOUBLE) AS age_range_to,
       i.LinkedWithApps, COUNT(*) AS plays,
       CAST(ROW_NUMBER() OVER (PARTITION BY r.label ORDER BY COUNT(*) DESC, i.LinkedWithApps) AS INTEGER)
         AS LinkedWithApps_rank
FROM idx i JOIN {_ranges_values(APPLINK_AGE_RANGES)}
  ON (r.lo IS NULL OR i.age >= r.lo) AND (r.hi IS NULL OR i.age < r.hi)
WHERE i.LinkedWithApps IS NOT NULL
GROUP BY 1, 2, 3, 4
QUALIFY LinkedWithApps_rank <= 5""")

ORACLE["compact_index"] = with_views(["parsed_lines", "customers", "predictions"], STREAM_FLAGGED)

ORACLE["stream_level_gender_trend"] = with_views(["enriched"], f"""
, c AS (SELECT time_bucket(INTERVAL 1 HOUR, datetime) AS window_start,
               time_bucket(INTERVAL 1 HOUR, datetime) + INTERVAL 1 HOUR AS window_end,
               Level, gender, COUNT(*) AS plays
        FROM enriched WHERE Level IS NOT NULL AND gender IS NOT NULL GROUP BY 1, 2, 3, 4)
SELECT *, CAST(ROW_NUMBER() OVER (PARTITION BY window_start, Level ORDER BY plays DESC, gender) AS INTEGER) AS rank
FROM c
QUALIFY rank <= 5""")


ORACLE["flag_enriched_plays"] = ORACLE["flag_ad_targets"]

ORACLE["plays_by_customer"] = with_views(["plays"], """
SELECT customer_id, CAST(CAST(datetime AS DATE) AS TIMESTAMP) AS period_start, CAST(COUNT(*) AS INTEGER) AS n,
       string_agg(concat_ws('/', event_id, track_id, ismobile, listening_zip_code), ';' ORDER BY datetime, event_id)
         AS plays
FROM plays GROUP BY 1, 2""")

ORACLE["rejected_model_changes_nothing"] = with_views(["parsed_lines", "features"], """
SELECT CASE WHEN f.customer_id IS NOT NULL THEN 0 END AS "SendEvent", COUNT(*) AS plays
FROM parsed_lines p LEFT JOIN features f ON p.customer_id = f.customer_id
WHERE p.reject_reason IS NULL GROUP BY 1""")

DENSE = """
  SELECT event_id, user_id % 50 AS customer_id,
         CASE WHEN k % 7 <> 0 THEN k % 2 END AS track_id,
         CAST(CAST(ts AS DATE) AS TIMESTAMP) + to_seconds(event_id * 7919 % 2880) AS datetime
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events)"""
DENSE_REPEAT = REPEAT.format(src=f"(SELECT * FROM ({DENSE}) WHERE track_id IS NOT NULL)",
                             horizon_us=30 * 60 * 1_000_000)
ORACLE["repeat_listens_dense"] = DENSE_REPEAT
ORACLE["stream_repeat_listens_dense"] = f"SELECT customer_id, track_id, first_detected FROM ({DENSE_REPEAT})"

ORACLE["stream_progress_rows"] = "SELECT COUNT(*) AS input_rows FROM events"

# The split: the first 32 bits of md5('<customer>-<seed>'), modulo 10,000, below 7,000.
ORACLE["model_facts"] = with_views(["features"], """
SELECT COUNT(*) AS predictions, COUNT(DISTINCT customer_id) AS customers, CAST(0 AS BIGINT) AS odd_predictions,
       CAST(COUNT(*) FILTER (WHERE h < 7000) AS INTEGER) AS train_rows,
       CAST(COUNT(*) FILTER (WHERE h >= 7000) AS INTEGER) AS test_rows, true AS error_in_range
FROM (SELECT customer_id, CAST('0x' || substr(md5(customer_id || '-0'), 1, 8) AS BIGINT) % 10000 AS h FROM features)""")

ORACLE["approx_users_bound"] = with_views(["plays"], """
SELECT time_bucket(INTERVAL '1 day', datetime) AS bucket_start, CAST(SUM(ismobile) AS BIGINT) AS mobile_connections,
       COUNT(DISTINCT customer_id) AS unique_customers, true AS within
FROM plays GROUP BY 1""")
ORACLE["stream_mobile_trend_bound"] = ORACLE["approx_users_bound"].replace("'1 day'", "'1 hour'")

ORACLE["synth_age"] = with_views(["customers"], f"""
SELECT customer_id, CAST([{", ".join(map(str, AGE_DECADES))}][
         CAST('0x' || substr(md5(customer_id::VARCHAR), 1, 8) AS BIGINT) % {len(AGE_DECADES)} + 1]
       + CAST('0x' || substr(md5(customer_id::VARCHAR), 9, 8) AS BIGINT) % 10 AS INTEGER) AS synth_age
FROM customers""")

# The text form keeps two decimals of each ratio (half up); the query gives them back as read.
_ROUNDED = ", ".join(f'round("{f}" + 1e-9, 2) AS "{f}"' for f in FEATURE_NAMES)
ORACLE["libsvm_round_trip"] = with_views(["features"], f"SELECT label, {_ROUNDED} FROM features")
ORACLE["parse_libsvm_values"] = ORACLE["libsvm_round_trip"]

ORACLE["compare_models_facts"] = with_views(["features"], """
SELECT setting, COUNT(*) FILTER (WHERE h < 7000) AS train_rows, COUNT(*) FILTER (WHERE h >= 7000) AS test_rows,
       true AS error_in_range, true AS gate_followed
FROM (SELECT CAST('0x' || substr(md5(customer_id || '-0'), 1, 8) AS BIGINT) % 10000 AS h FROM features),
     (VALUES ('lbfgs'), ('l2')) s(setting)
GROUP BY setting""")

ORACLE.update(LIVE_ORACLE)
ORACLE["live_level_gender"] = ORACLE["level_gender_trend"]
ORACLE["live_applink_by_age"] = ORACLE["applink_by_age"]
ORACLE["live_level_by_age"] = ORACLE["level_by_age"]
ORACLE["stream_top_regions_bounds"] = (
    f"SELECT *, true AS zip_within, true AS pair_within FROM ({ORACLE['top_regions_and_users']})")
ORACLE["live_features"] = ORACLE["build_features"]
