"""DuckDB SQL for each registered query: the correctness oracle.

The adapter views of ``beatstream.sources.testdata`` are repeated here as common
table expressions over the raw test tables (``events``, ``customer``, ...), so
each statement is self-contained.  Column names and types match the Spark output
(counts BIGINT, sums cast to BIGINT, ranks INTEGER, times TIMESTAMP).
"""

from __future__ import annotations

VIEWS: dict[str, str] = {
    "plays": """
  SELECT event_id, user_id AS customer_id,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS track_id,
         ts AS datetime,
         CAST(CASE WHEN event_type IN ('view', 'click') THEN 1 ELSE 0 END AS INTEGER) AS ismobile,
         CAST(10000 + event_id % 40 AS VARCHAR) AS listening_zip_code
  FROM events""",
    "customers": """
  SELECT c.c_custkey AS customer_id, c.c_name AS name,
         CAST(10 + c.c_custkey % 60 AS INTEGER) AS age,
         CAST(c.c_custkey % 2 AS VARCHAR) AS gender,
         CAST(c.c_nationkey AS VARCHAR) AS zip,
         n.n_name AS Address,
         strftime(DATE '2013-01-01' + CAST(c.c_custkey % 1000 AS INTEGER), '%m/%d/%Y') AS SignDate,
         CASE WHEN c.c_acctbal >= 0 THEN '1' ELSE '0' END AS Status,
         CAST(c.c_custkey % 3 AS VARCHAR) AS Level,
         c.c_mktsegment AS Campaign,
         CAST(c.c_custkey % 5 % 2 AS VARCHAR) AS LinkedWithApps
  FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey""",
    "enriched": """
  SELECT p.*, c.name, c.age, c.gender, c.zip, c.Address, c.SignDate, c.Status, c.Level,
         c.Campaign, c.LinkedWithApps
  FROM plays p LEFT JOIN customers c ON p.customer_id = c.customer_id""",
    "clicks": """
  SELECT event_id AS EventID, user_id AS CustID,
         CASE WHEN CAST(json_extract_string(props, '$.k') AS BIGINT) % 5 = 0
              THEN 'ADV_REDUCED_1DAY' ELSE 'ADV_FREE_REFERRAL' END AS AdClicked,
         ts AS Localtime
  FROM events WHERE event_type = 'click'""",
    "music": """
  SELECT p_partkey AS TrackId, p_name AS Title, p_brand AS Artist, CAST(p_size AS INTEGER) AS Length
  FROM part""",
    "messages": """
  SELECT event_id AS msg_id, ts,
         concat('Now #', event_type, ', #K', CAST(CAST(json_extract_string(props, '$.k') AS BIGINT) % 10 AS VARCHAR),
                '! a#b ##', CAST(user_id % 3 AS VARCHAR), ' #?') AS text
  FROM events""",
    "retail": """
  SELECT o.o_custkey AS CustomerId, l.l_extendedprice AS UnitPrice, 1 AS Quantity,
         o.o_orderdate AS InvoiceDate
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey""",
    "play_lines": """
  SELECT CASE
           WHEN event_type <> 'error' THEN head || mobile || ',"' || zip || '"'
           WHEN value < 5 THEN head
           WHEN value > 90 THEN ids || 'T' || k || ',"' || strftime(ts, '%Y-%m-%d %H:%M:%S') || '",0,"' || zip || '"'
           WHEN value > 80 THEN ids || k || ',"' || strftime(ts, '%Y-%m-%d') || '",0,"' || zip || '"'
           ELSE head || 'E,"' || zip || '"' END AS value
  FROM (SELECT event_type, value, ts, json_extract_string(props, '$.k') AS k,
               CAST(event_id AS VARCHAR) || ',' || CAST(user_id AS VARCHAR) || ',' AS ids,
               CAST(event_id AS VARCHAR) || ',' || CAST(user_id AS VARCHAR) || ',' ||
               json_extract_string(props, '$.k') || ',"' || strftime(ts, '%Y-%m-%d %H:%M:%S') || '",' AS head,
               CASE WHEN event_type IN ('view', 'click') THEN '1' ELSE '0' END AS mobile,
               CAST(10000 + event_id % 40 AS VARCHAR) AS zip
        FROM events)""",
    "parsed_lines": """
  SELECT value AS raw,
         TRY_CAST(replace(trim(f[1]), '"', '') AS BIGINT) AS event_id,
         TRY_CAST(replace(trim(f[2]), '"', '') AS BIGINT) AS customer_id,
         TRY_CAST(replace(trim(f[3]), '"', '') AS BIGINT) AS track_id,
         try_strptime(NULLIF(trim(replace(trim(f[4]), '"', '')), ''), '%Y-%m-%d %H:%M:%S') AS datetime,
         TRY_CAST(trim(f[5]) AS INTEGER) AS ismobile,
         replace(trim(f[6]), '"', '') AS listening_zip_code,
         CASE WHEN value IS NULL OR len(f) < 6 THEN 'too_few_fields'
              WHEN TRY_CAST(replace(trim(f[2]), '"', '') AS BIGINT) IS NULL THEN 'bad_customer_id'
              WHEN TRY_CAST(trim(f[5]) AS INTEGER) IS NULL THEN 'bad_ismobile'
              WHEN TRY_CAST(replace(trim(f[3]), '"', '') AS BIGINT) IS NULL THEN 'bad_track_id'
              WHEN try_strptime(NULLIF(trim(replace(trim(f[4]), '"', '')), ''), '%Y-%m-%d %H:%M:%S') IS NULL
                THEN 'bad_event_time' END AS reject_reason
  FROM (SELECT value, string_split(value, ',') AS f FROM play_lines)""",
    "profile": """
  SELECT customer_id,
         COUNT(DISTINCT track_id) AS unique_tracks,
         COUNT(*) FILTER (WHERE h >= 5 AND h < 12) AS morn,
         COUNT(*) FILTER (WHERE h >= 12 AND h < 17) AS aft,
         COUNT(*) FILTER (WHERE h >= 17 AND h < 22) AS eve,
         COUNT(*) FILTER (WHERE h < 5 OR h >= 22) AS night,
         CAST(SUM(ismobile) AS BIGINT) AS mobile
  FROM (SELECT *, hour(datetime) AS h FROM plays) GROUP BY customer_id""",
    "click_counts": """
  SELECT CustID AS customer_id,
         CAST(SUM(CAST(contains(AdClicked, 'ADV_REDUCED_1DAY') AS INTEGER)) AS BIGINT) AS clicks
  FROM clicks GROUP BY CustID""",
    "features": """
  SELECT p.customer_id,
         CAST(CASE WHEN COALESCE(c.clicks, 0) > 0 THEN 1 ELSE 0 END AS DOUBLE) AS label,
         p.morn / CAST(p.morn + p.aft + p.eve + p.night AS DOUBLE) AS morn,
         p.aft / CAST(p.morn + p.aft + p.eve + p.night AS DOUBLE) AS aft,
         p.eve / CAST(p.morn + p.aft + p.eve + p.night AS DOUBLE) AS eve,
         p.night / CAST(p.morn + p.aft + p.eve + p.night AS DOUBLE) AS night,
         p.mobile / CAST(p.morn + p.aft + p.eve + p.night AS DOUBLE) AS mobile,
         p.unique_tracks / CAST(p.morn + p.aft + p.eve + p.night AS DOUBLE) AS "unique"
  FROM profile p LEFT JOIN click_counts c ON p.customer_id = c.customer_id""",
    "predictions": """
  SELECT customer_id, CAST(label AS INTEGER) AS pred FROM features""",
}

# View dependencies, so that a statement only carries the views it needs.
DEPENDS: dict[str, list[str]] = {
    "enriched": ["plays", "customers"],
    "parsed_lines": ["play_lines"],
    "profile": ["plays"],
    "click_counts": ["clicks"],
    "features": ["profile", "click_counts"],
    "predictions": ["features"],
}


def _order(names: list[str]) -> list[str]:
    out: list[str] = []

    def visit(n: str) -> None:
        for d in DEPENDS.get(n, []):
            visit(d)
        if n not in out:
            out.append(n)

    for n in names:
        visit(n)
    return out


def with_views(views: list[str], body: str, extra: list[tuple[str, str]] | None = None) -> str:
    """``WITH <views>, <extra ctes> <body>``."""
    ctes = [f"{n} AS ({VIEWS[n]}\n)" for n in _order(views)]
    ctes += [f"{n} AS (\n{sql}\n)" for n, sql in (extra or [])]
    return "WITH " + ",\n".join(ctes) + "\n" + body
