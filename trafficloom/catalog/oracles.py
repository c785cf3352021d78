"""The same results as plain DuckDB SQL over the sample tables.

The SQL goes the long way on purpose: it unnests every parameter, counts
distinct ids as such and builds legacy rows without pages, so it shares no
shortcut with the Spark side.
"""

from __future__ import annotations

from trafficloom.schemas import LANDING_DIMENSIONS, METRICS, RATIO_METRIC, SOURCE_MEDIUM_DIMENSIONS


def cents(value: str) -> str:
    """Round half up on the printed decimal, as Spark does."""
    return f"CAST(round(CAST(CAST({value} AS VARCHAR) AS DECIMAL(38, 15)), 2) AS DOUBLE)"


EXPORT = """
timed AS (
  SELECT *, epoch_us(ts) AS us, CAST(regexp_extract(props, '"k":\\s*(-?\\d+)', 1) AS BIGINT) AS k FROM events
),
listed AS (
  SELECT *, list_filter([
    CASE WHEN event_id % 17 <> 0 THEN {'key': 'ga_session_id', 's': NULL::VARCHAR, 'i': (us // 21600000000)::BIGINT} END,
    {'key': 'ga_session_number', 's': NULL, 'i': event_id % 9},
    {'key': 'session_engaged', 's': CAST(event_id % 2 AS VARCHAR), 'i': NULL},
    {'key': 'page_title', 's': 'T' || (event_id % 6), 'i': NULL},
    CASE WHEN event_id % 19 <> 0 THEN {'key': 'page_location', 's': 'https://shop.example.com/p/' || (k % 7), 'i': NULL} END,
    CASE WHEN event_id % 3 = 0 THEN {'key': 'engagement_time_msec', 's': NULL, 'i': (1 + event_id % 119) * 1000} END,
    CASE WHEN event_id % 5 = 0 THEN {'key': 'source', 'i': NULL,
      's': CASE event_id % 4 WHEN 0 THEN 'google' WHEN 1 THEN 'bing' WHEN 2 THEN '(direct)' END} END,
    CASE WHEN event_id % 5 = 0 THEN {'key': 'medium', 's': CASE event_id % 4 WHEN 0 THEN 'cpc' END, 'i': NULL} END,
    CASE WHEN event_id % 10 = 0 THEN {'key': 'campaign', 's': 'camp' || (event_id % 3), 'i': NULL} END
  ], lambda p: p IS NOT NULL) AS every_param
  FROM timed
),
export AS (
  SELECT
    ts::DATE AS event_date,
    us // 3600000000 * 3600000000 AS event_timestamp,
    1700000000000000 + user_id * 1000000 AS user_first_touch_timestamp,
    CASE event_type WHEN 'signup' THEN 'first_visit' WHEN 'click' THEN 'session_start'
      WHEN 'view' THEN 'page_view' WHEN 'error' THEN 'user_engagement' ELSE event_type END AS event_name,
    CASE WHEN user_id % 29 <> 0 THEN 'u' || user_id END AS user_pseudo_id,
    ['desktop', 'mobile', 'tablet'][user_id % 3 + 1] AS category,
    CASE user_id % 13 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE 'NATION_' || (user_id % 25) END AS country,
    CASE WHEN user_id % 7 = 0 THEN '' ELSE 'R' || (user_id % 5) END AS region,
    CASE WHEN user_id % 11 <> 0 THEN 'C' || (user_id % 40) END AS city,
    CASE WHEN user_id % 4 <> 0 THEN 's' || (user_id % 4) END AS ts_source,
    CASE WHEN user_id % 4 <> 0 THEN 'organic' END AS ts_medium,
    CASE WHEN event_type IN ('purchase', 'error') THEN 't' || (event_id % 700) END AS transaction_id,
    CASE WHEN event_type = 'purchase' THEN value END AS purchase_revenue,
    CASE WHEN event_id % 101 = 0 THEN NULL WHEN event_id % 97 = 0 THEN every_param[1:0] ELSE every_param END AS params
  FROM listed
),
param AS (
  SELECT export.* EXCLUDE (params), u.p.key AS key, u.p.s AS string_value, u.p.i AS int_value
  FROM export, unnest(params) AS u(p)
)"""

# The events that count as purchases.
PURCHASES = """('purchase', 'ecommerce_purchase', 'in_app_purchase', 'app_store_subscription_convert',
      'app_store_subscription_renew', 'refund')"""


def flat(acquisition: bool) -> str:
    def pick(key: str, field: str = "string_value", event: str = "") -> str:
        only = f" AND event_name = '{event}'" if event else ""
        return f"max({field}) FILTER (WHERE key = '{key}'{only})"

    if acquisition:
        channel = "max(ts_source) AS utm_source, max(ts_medium) AS utm_medium,"
        transaction = f"max(transaction_id) FILTER (WHERE event_name IN {PURCHASES})"
    else:
        channel = ", ".join(f"{pick(k)} AS utm_{k}" for k in ("source", "medium", "campaign")) + ","
        transaction = "max(transaction_id)"
    return f"""
flat AS (
  SELECT
    event_date,
    strftime(make_timestamp(event_timestamp), '%Y-%m-%d %H:%M:%S') AS event_time,
    strftime(make_timestamp(user_first_touch_timestamp), '%Y-%m-%d %H:%M:%S') AS user_first_touch_time,
    event_name,
    user_pseudo_id,
    max(category) AS device_category,
    'en-us' AS device_language,
    'Chrome' AS device_browser,
    max(country) AS geo_country,
    max(region) AS geo_region,
    max(city) AS geo_city,
    CAST(event_name = 'session_start' AS INTEGER) AS entrance,
    CAST(event_name = 'first_visit' AS INTEGER) AS new_user,
    {pick('ga_session_id', 'int_value')} AS ga_session_id,
    {pick('ga_session_number', 'int_value')} AS ga_session_number,
    CAST({pick('session_engaged')} AS BIGINT) AS session_engaged,
    {pick('page_title')} AS page_title,
    {pick('page_location', event='page_view')} AS pageview_location,
    {pick('page_location', event='session_start')} AS landing_page,
    max(CASE key WHEN 'engagement_time_msec' THEN int_value / 1000 ELSE 0 END) AS engagment_time_sec,
    {channel}
    {transaction} AS ecommerce_transaction_id,
    max(coalesce(purchase_revenue, 0)) AS ecommerce_purchase_revenue,
    count(*) FILTER (WHERE key = 'page_location' AND event_name = 'purchase') AS conversions
  FROM param
  GROUP BY event_date, event_name, event_timestamp, user_pseudo_id, user_first_touch_timestamp
)"""


def sessions(acquisition: bool) -> str:
    dimensions = "" if acquisition else """
    max(coalesce(landing_page, '(not set')) AS landing_page,
    max(geo_country) AS country, max(geo_region) AS region, max(geo_city) AS city,
    max(utm_campaign) AS utm_campaign,"""
    distinct = "" if acquisition else "DISTINCT "
    return f"""
sessions AS (
  SELECT
    event_date,{dimensions}
    max(utm_source) AS utm_source,
    max(utm_medium) AS utm_medium,
    count(DISTINCT user_pseudo_id) AS users,
    count(pageview_location) AS page_views,
    count(DISTINCT pageview_location) AS unique_page_views,
    CAST(sum(entrance) AS BIGINT) AS entrance,
    CAST(sum(new_user) AS BIGINT) AS new_user,
    count(DISTINCT ga_session_id) AS sessions,
    sum(engagment_time_sec) AS engagment_time_sec,
    CAST(sum(conversions) AS BIGINT) AS conversions,
    sum(ecommerce_purchase_revenue) AS ecommerce_revenue,
    count({distinct}ecommerce_transaction_id) AS ecommerce_transactions
  FROM flat
  GROUP BY event_date, user_pseudo_id, ga_session_id
)"""


GEO_LABELS = ", ".join(f"coalesce(nullif({c}, ''), '(not set)') AS {c}" for c in ("country", "region", "city"))
CHANNEL_LABELS = """coalesce(utm_source, '(direct)') AS utm_source,
    coalesce(utm_medium, '(none)') AS utm_medium"""
LANDING_LABELS = f"{GEO_LABELS}, {CHANNEL_LABELS}, coalesce(utm_campaign, '(not set)') AS utm_campaign"
ADDED = [m for m in METRICS if m not in (RATIO_METRIC, "ecommerce_revenue")]
SESSION_COLUMN = {"new_users": "new_user", "entrances": "entrance"}


def report(acquisition: bool) -> str:
    dimensions = SOURCE_MEDIUM_DIMENSIONS if acquisition else LANDING_DIMENSIONS
    labels = CHANNEL_LABELS if acquisition else LANDING_LABELS
    sums = ", ".join(f"CAST(sum({SESSION_COLUMN.get(m, m)}) AS BIGINT) AS {m}" for m in ADDED)
    by = ", ".join(dimensions)
    return f"""
labelled AS (SELECT sessions.* REPLACE ({labels}), event_date AS date FROM sessions),
report AS (
  SELECT {by}, {sums},
    {cents('sum(engagment_time_sec) / nullif(sum(sessions), 0)')} AS {RATIO_METRIC},
    {cents('sum(ecommerce_revenue)')} AS ecommerce_revenue
  FROM labelled
  GROUP BY {by}
)"""


LANDING_FLAT = f"WITH {EXPORT},{flat(False)}"
ACQUISITION_FLAT = f"WITH {EXPORT},{flat(True)}"
LANDING_SESSIONS = f"{LANDING_FLAT},{sessions(False)}"
ACQUISITION_SESSIONS = f"{ACQUISITION_FLAT},{sessions(True)}"
LANDING = f"{LANDING_SESSIONS},{report(False)}"
ACQUISITION = f"{ACQUISITION_SESSIONS},{report(True)}"

LEGACY_CTE = """
legacy_text AS (
  SELECT
    strftime(DATE '2023-10-01' + CAST(page_id % 92 AS INTEGER), '%Y%m%d') AS "ga:date",
    regexp_extract(url, '^https?://([^/?#]+)', 1) AS "ga:hostname",
    CASE WHEN page_id % 20 = 0 THEN '(not set)'
      ELSE regexp_extract(url, '^https?://[^/?#]+([^?#]*)', 1) END AS "ga:landingPagePath",
    'NATION_' || (page_id % 25) AS "ga:country",
    'R' || (page_id % 5) AS "ga:region",
    '(not set)' AS "ga:city",
    ['google', 'bing', '(direct)'][page_id % 3 + 1] AS "ga:source",
    ['cpc', 'organic', '(none)'][page_id % 3 + 1] AS "ga:medium",
    '(not set)' AS "ga:campaign",
    CAST(page_id % 9 + 1 AS VARCHAR) AS "ga:users",
    CAST(page_id % 3 AS VARCHAR) AS "ga:newUsers",
    CAST(page_id % 5 AS VARCHAR) AS "ga:entrances",
    CAST(page_id % 9 + 1 + page_id % 2 AS VARCHAR) AS "ga:sessions",
    CAST(page_id % 9 + 3 AS VARCHAR) AS "ga:pageviews",
    CAST(page_id % 9 + 2 AS VARCHAR) AS "ga:uniquePageviews",
    CASE WHEN page_id % 4 = 0 THEN '0.0' ELSE (page_id % 50) || '.5' END AS "ga:timeOnPage",
    CAST(page_id % 4 AS VARCHAR) AS "ga:goalCompletionsAll",
    CASE WHEN page_id % 6 = 0 THEN '12.25' ELSE '0.0' END AS "ga:transactionRevenue",
    CASE WHEN page_id % 6 = 0 THEN '1' ELSE '0' END AS "ga:transactions"
  FROM pages
),
legacy AS (
  SELECT
    strptime("ga:date", '%Y%m%d')::DATE AS date,
    CASE "ga:landingPagePath" WHEN '(not set)' THEN '(not set)'
      ELSE 'https://' || "ga:hostname" || "ga:landingPagePath" END AS landing_page,
    "ga:country" AS country, "ga:region" AS region, "ga:city" AS city,
    "ga:source" AS utm_source, "ga:medium" AS utm_medium, "ga:campaign" AS utm_campaign,
    "ga:users"::BIGINT AS users, "ga:newUsers"::BIGINT AS new_users, "ga:entrances"::BIGINT AS entrances,
    "ga:sessions"::BIGINT AS sessions, "ga:pageviews"::BIGINT AS page_views,
    "ga:uniquePageviews"::BIGINT AS unique_page_views,
    "ga:timeOnPage"::DOUBLE AS engagment_time_sec_per_session,
    "ga:goalCompletionsAll"::BIGINT AS conversions,
    "ga:transactionRevenue"::DOUBLE AS ecommerce_revenue, "ga:transactions"::BIGINT AS ecommerce_transactions
  FROM legacy_text
)"""
LEGACY = f"WITH {LEGACY_CTE}"
UNIFIED = f"""{LANDING},{LEGACY_CTE},
unified AS (SELECT * FROM report UNION ALL BY NAME SELECT * FROM legacy)"""

SESSION_METRICS = """users, page_views, unique_page_views, entrance, new_user, sessions, engagment_time_sec,
  conversions, """ + f"{cents('ecommerce_revenue')} AS ecommerce_revenue, ecommerce_transactions"

WEIGHTED = f"sum({RATIO_METRIC} * sessions) / nullif(sum(sessions) FILTER (WHERE {RATIO_METRIC} IS NOT NULL), 0)"


def totals(*metrics: str) -> str:
    def one(m: str) -> str:
        if m == RATIO_METRIC:
            return f"{cents(WEIGHTED)} AS {m}"
        if m == "ecommerce_revenue":
            return f"{cents('sum(ecommerce_revenue)')} AS {m}"
        return f"CAST(sum({m}) AS BIGINT) AS {m}"

    return ", ".join(one(m) for m in metrics)


def flat_columns(*columns: str) -> str:
    return f"{LANDING_FLAT} SELECT event_date, event_time, event_name, user_pseudo_id, {', '.join(columns)} FROM flat"


def ranges_report() -> str:
    ranges = [("2023-12-01", "2024-01-15"), ("2024-01-10", "2024-01-31")]
    wanted = totals("users", "sessions", RATIO_METRIC)
    parts = [
        f"SELECT {i} AS range_index, utm_medium, {wanted} FROM unified "
        f"WHERE date >= DATE '{first}' AND date <= DATE '{last}' GROUP BY utm_medium"
        for i, (first, last) in enumerate(ranges)
    ]
    return f"{UNIFIED} {' UNION ALL '.join(parts)}"


def segments_report() -> str:
    segments = {"paid": "utm_medium = 'cpc'", "buyers": "ecommerce_transactions > 0", "organic": "utm_medium = 'organic'"}
    wanted = totals("users", "sessions", "ecommerce_revenue")
    parts = [
        f"SELECT '{name}' AS segment, date, {wanted} FROM unified WHERE {condition} GROUP BY date"
        for name, condition in segments.items()
    ]
    return f"{UNIFIED} {' UNION ALL '.join(parts)}"


ORDERED_LANDING = ", ".join(f"{d} NULLS FIRST" for d in LANDING_DIMENSIONS)
SAMPLE_KEY = " || '|' || ".join(["'7'"] + [f"coalesce(CAST({d} AS VARCHAR), '')" for d in LANDING_DIMENSIONS])

SAMPLED = f"""{UNIFIED}
SELECT date, {totals('users', 'sessions')} FROM unified
WHERE CAST('0x' || substr(md5({SAMPLE_KEY}), 1, 13) AS BIGINT) / pow(2, 52) < 0.25 GROUP BY date"""

SCANNED = f"""WITH {EXPORT}
SELECT strftime(event_date, '%Y%m%d') AS event_date, event_timestamp, user_first_touch_timestamp, event_name,
  user_pseudo_id, category AS device_category, country AS geo_country, ts_source AS traffic_source,
  transaction_id, purchase_revenue, CAST(len(params) AS BIGINT) AS n_params
FROM export WHERE event_date BETWEEN DATE '2024-01-30' - 6 AND DATE '2024-01-30'"""

ORACLES: dict[str, str] = {
    "scan_window": SCANNED,
    "scan_shards": SCANNED,
    "scan_table_window": SCANNED,
    "param_explode": f"""WITH {EXPORT}
SELECT strftime(event_date, '%Y%m%d') AS event_date, event_timestamp, event_name, user_pseudo_id,
  key AS param_key, string_value, int_value
FROM param""",
    "param_pivot": flat_columns(
        "ga_session_id", "ga_session_number", "page_title", "pageview_location", "landing_page",
        "utm_source", "utm_medium", "utm_campaign",
    ),
    "event_times": flat_columns("user_first_touch_time"),
    "event_flags": flat_columns("entrance", "new_user"),
    "engagement_seconds": flat_columns("engagment_time_sec"),
    "event_revenue": flat_columns("ecommerce_purchase_revenue"),
    "conversion_count": flat_columns("conversions"),
    "purchase_transactions": f"""{ACQUISITION_FLAT}
SELECT event_date, event_time, event_name, user_pseudo_id, ecommerce_transaction_id FROM flat""",
    "event_flatten": f"{LANDING_FLAT} SELECT * FROM flat",
    "event_flatten_acquisition": f"{ACQUISITION_FLAT} SELECT * FROM flat",
    "session_rollup": f"""{LANDING_SESSIONS}
SELECT event_date, landing_page, country, region, city, utm_source, utm_medium, utm_campaign, {SESSION_METRICS}
FROM sessions""",
    "session_rollup_acquisition": f"""{ACQUISITION_SESSIONS}
SELECT event_date, utm_source, utm_medium, {SESSION_METRICS} FROM sessions""",
    "session_landing_page": f"{LANDING_SESSIONS} SELECT event_date, landing_page FROM sessions",
    "user_session_flags": f"{LANDING_SESSIONS} SELECT event_date, users, sessions FROM sessions",
    "page_views": f"{LANDING_SESSIONS} SELECT event_date, page_views, unique_page_views FROM sessions",
    "label_defaults": f"{LANDING_SESSIONS} SELECT event_date, landing_page, {LANDING_LABELS} FROM sessions",
    "engagement_ratio": f"{ACQUISITION} SELECT date, utm_source, utm_medium, sessions, {RATIO_METRIC} FROM report",
    "source_medium_report": f"{ACQUISITION} SELECT * FROM report",
    "landing_report": f"{LANDING} SELECT * FROM report",
    "source_medium_report_sql": f"{ACQUISITION} SELECT * FROM report",
    "landing_report_sql": f"{LANDING} SELECT * FROM report",
    "ranked_report": f"{LANDING} SELECT * FROM report ORDER BY sessions DESC, {ORDERED_LANDING}",
    "legacy_pages_flatten": f"{LEGACY} SELECT * FROM legacy_text",
    "legacy_bad_pages": """
WITH landed AS (
  SELECT page_id, CAST(date_trunc('month', DATE '2023-10-01' + CAST(page_id % 92 AS INTEGER)) AS DATE) AS window_start,
    page_id % 10 IN (3, 7) AS unreadable FROM pages
)
SELECT window_start, count(*) AS pages, count(*) FILTER (unreadable) AS unreadable_pages,
  CAST(NOT max_by(unreadable, page_id) AS BIGINT) AS last_pages, count(*) FILTER (NOT unreadable) AS legacy_rows
FROM landed GROUP BY window_start""",
    "legacy_metric_types": f"""{LEGACY} SELECT strftime(date, '%Y%m%d') AS legacy_date, {', '.join(METRICS)} FROM legacy""",
    "legacy_landing_page": f"""{LEGACY}
SELECT t."ga:hostname" AS host, t."ga:landingPagePath" AS path,
  CASE WHEN t."ga:landingPagePath" = '(not set)' THEN t."ga:landingPagePath"
    ELSE concat('https://', t."ga:hostname", t."ga:landingPagePath") END AS landing_page
FROM legacy_text t""",
    "legacy_normalize": f"{LEGACY} SELECT * FROM legacy",
    "month_windows": f"""{UNIFIED},
bounds AS (SELECT (SELECT min(date) FROM legacy) AS b, (SELECT min(date) - 1 FROM report) AS e),
starts AS (
  SELECT CAST(unnest(generate_series(date_trunc('month', b), e::TIMESTAMP, INTERVAL 1 MONTH)) AS DATE) AS m, b, e
  FROM bounds
),
windows AS (SELECT greatest(m, b) AS window_start, least(last_day(m), e) AS window_end FROM starts)
SELECT window_start, window_end, count(date) AS legacy_rows, CAST(coalesce(sum(sessions), 0) AS BIGINT) AS sessions
FROM windows LEFT JOIN legacy ON date >= window_start AND date <= window_end
GROUP BY window_start, window_end""",
    "backfill_bound": f"{LANDING} SELECT min(date) - 1 AS bound FROM report",
    "backfill_union": f"{UNIFIED} SELECT * FROM unified",
    "backfill_windows": f"""{LANDING},
bounds AS (SELECT DATE '2023-08-15' AS b, min(date) - 1 AS e FROM report),
starts AS (
  SELECT CAST(unnest(generate_series(date_trunc('month', b), e::TIMESTAMP, INTERVAL 1 MONTH)) AS DATE) AS m, b, e
  FROM bounds
)
SELECT greatest(m, b) AS window_start, least(last_day(m), e) AS window_end,
  row_number() OVER (ORDER BY m DESC) - 1 AS nth FROM starts""",
    "pull_totals": f"""{LANDING}
SELECT date, count(*) AS report_rows,
  {totals('users', 'sessions', 'page_views', 'conversions', 'ecommerce_revenue', 'ecommerce_transactions')}
FROM report GROUP BY date""",
    "target_sources": f"""{UNIFIED}
SELECT utm_source, utm_medium, count(*) AS report_rows, min(date) AS first_day, max(date) AS last_day,
  count(DISTINCT date) AS days,
  {totals('users', 'sessions', 'conversions', 'ecommerce_revenue', 'ecommerce_transactions')}
FROM unified GROUP BY utm_source, utm_medium""",
    "target_bound": f"{UNIFIED} SELECT min(date) - 1 AS bound FROM unified",
    "daily_incremental": f"{UNIFIED} SELECT * FROM unified",
    "target_review": f"""{UNIFIED}
SELECT CAST(date_trunc('month', date) AS DATE) AS month, count(*) AS report_rows, min(date) AS first_day,
  max(date) AS last_day, count(DISTINCT date) AS days,
  {totals('users', 'sessions', 'conversions', 'ecommerce_revenue', 'ecommerce_transactions')}
FROM unified GROUP BY 1""",
    "report_query_default": f"""{UNIFIED}
SELECT {totals('users')} FROM unified WHERE date BETWEEN DATE '2024-01-31' - 91 AND DATE '2024-01-30'""",
    "report_query": f"{UNIFIED} SELECT country, utm_medium, {totals(*METRICS)} FROM unified GROUP BY country, utm_medium",
    "report_distinct_pages": f"""{LANDING_SESSIONS},
shown AS (
  SELECT s.*, f.pageview_location FROM (SELECT * FROM flat) f JOIN (
    SELECT event_date, user_pseudo_id, ga_session_id, {LANDING_LABELS} FROM (
      SELECT event_date, user_pseudo_id, ga_session_id, max(geo_country) AS country, max(geo_region) AS region,
        max(geo_city) AS city, max(utm_source) AS utm_source, max(utm_medium) AS utm_medium, max(utm_campaign) AS utm_campaign
      FROM flat GROUP BY ALL)
  ) s ON f.event_date = s.event_date AND f.user_pseudo_id IS NOT DISTINCT FROM s.user_pseudo_id
    AND f.ga_session_id IS NOT DISTINCT FROM s.ga_session_id
)
SELECT utm_medium, country, count(DISTINCT (event_date, coalesce(user_pseudo_id, ''), coalesce(ga_session_id, -1), pageview_location))
    FILTER (WHERE pageview_location IS NOT NULL) AS unique_page_views,
  count(DISTINCT pageview_location) AS distinct_pages
FROM shown GROUP BY utm_medium, country""",
    "report_date_ranges": ranges_report(),
    "report_many_ranges": f"""{UNIFIED},
numbered AS (SELECT CAST(k AS INT) AS k, DATE '2023-10-01' + CAST(7 * k % 120 AS INT) AS first FROM range(1000) AS t(k)),
wanted AS (
  SELECT k, first, first + CAST(k % 45 AS INT) AS last FROM numbered
  UNION ALL SELECT 1000, DATE '1900-01-01', DATE '9999-12-31'
)
SELECT k AS range_index, utm_medium, {totals('users', 'sessions', RATIO_METRIC)}
FROM wanted JOIN unified ON date BETWEEN first AND last GROUP BY k, utm_medium""",
    "report_segment": segments_report(),
    "report_page": f"""{UNIFIED}
SELECT date, country, utm_source, {totals('sessions', 'page_views')} FROM unified
GROUP BY date, country, utm_source
ORDER BY date NULLS FIRST, country NULLS FIRST, utm_source NULLS FIRST LIMIT 500 OFFSET 250""",
    "report_page_large": f"""{UNIFIED}
SELECT {', '.join(LANDING_DIMENSIONS)}, {totals('sessions', 'page_views')} FROM unified
GROUP BY {', '.join(LANDING_DIMENSIONS)} ORDER BY {ORDERED_LANDING} LIMIT 20000 OFFSET 750""",
    "report_follow_tokens": f"""{UNIFIED},
grouped AS (SELECT date, country, {totals('users', 'sessions')} FROM unified GROUP BY date, country),
placed AS (
  SELECT *, row_number() OVER (ORDER BY date NULLS FIRST, country NULLS FIRST) - 1 AS nth, count(*) OVER () AS n FROM grouped
)
SELECT date, country, users, sessions, CAST(nth // greatest(1, (n + 3) // 4) AS INT) AS page FROM placed""",
    "report_sample": SAMPLED,
    "report_sample_clustered": SAMPLED,
    "report_default_today": f"""{UNIFIED},
moved AS (
  SELECT current_date + date_diff('day', max(date) OVER (), date)::INT AS day, users, sessions FROM unified
)
SELECT {totals('users', 'sessions')} FROM moved WHERE day BETWEEN current_date - 91 AND current_date - 1""",
    "report_all_pages": f"""{UNIFIED},
grouped AS (SELECT date, country, {totals('sessions')} FROM unified GROUP BY date, country)
SELECT *, CAST((row_number() OVER (ORDER BY date NULLS FIRST, country NULLS FIRST) - 1) // 2000 AS INT) AS page
FROM grouped""",
    "legacy_report_preset": f"""{UNIFIED},
grouped AS (
  SELECT {', '.join(LANDING_DIMENSIONS)}, {totals(*METRICS)} FROM unified GROUP BY {', '.join(LANDING_DIMENSIONS)}
)
SELECT *, (row_number() OVER (ORDER BY {ORDERED_LANDING}) - 1) // 10000 AS page FROM grouped""",
    "iso_date_check": """
WITH spelled AS (
  SELECT o_orderkey, CASE o_orderkey % 5
    WHEN 0 THEN strftime(o_orderdate, '%Y%m%d')
    WHEN 1 THEN strftime(o_orderdate, '%Y-%m') || '-31'
    WHEN 2 THEN strftime(o_orderdate, '%Y-%m-%d') || ' '
    ELSE strftime(o_orderdate, '%Y-%m-%d') END AS spelled
  FROM orders
)
SELECT o_orderkey, spelled,
  CASE WHEN regexp_full_match(spelled, '[0-9]{4}-[0-9]{2}-[0-9]{2}') THEN try_cast(spelled AS DATE) END AS day
FROM spelled""",
}
