"""The same queries as plain SQL over the test tables, to compare results with.

Sums and counts are cast to the types Spark gives them. Rounding goes through text and decimal because
that rounds the shortest decimal form of a double half up, as Spark does.
"""

from __future__ import annotations

_K = "CAST(json_extract_string(props, '$.k') AS INTEGER)"

_EVENTS = f"""
events_k AS (SELECT *, {_K} AS k FROM events),
e AS (
  SELECT
    CASE event_id % 3 WHEN 0 THEN 'ADBRIX' WHEN 1 THEN 'BRANCH' ELSE 'SINGULAR' END AS tracking,
    'app_' || (user_id % 5) AS "trackingId",
    CASE event_type
      WHEN 'view' THEN 'TPD002' WHEN 'click' THEN 'TPD003' WHEN 'purchase' THEN 'TPD004'
      WHEN 'signup' THEN 'TPD012'
      WHEN 'error' THEN CASE k % 3 WHEN 0 THEN 'TPD007' WHEN 1 THEN 'TPD008' ELSE 'TPD009' END
    END AS "trackingEventCode",
    CAST(user_id AS VARCHAR) AS cid,
    CASE WHEN user_id % 10 < 5 THEN 'ATC001' WHEN user_id % 10 < 9 THEN 'ATC002' ELSE 'ATC999' END
      AS "osTypeCode",
    date_trunc('second', ts) AS "logTimeStamp",
    date_trunc('second', ts) AS "eventTimeStamp",
    CAST(ts AS DATE) AS "eventDate",
    strftime(ts, '%H') AS "eventHour",
    '' AS campaign,
    CAST(k AS VARCHAR) AS "contentId",
    '' AS "contentName",
    CAST(floor(value) AS INTEGER) AS value,
    CAST(k % 5 + 1 AS INTEGER) AS quantity,
    CAST(floor(value) * (k % 5 + 1) AS INTEGER) AS amount,
    'KRW' AS currency,
    props AS "activityParam",
    '' AS attributed,
    '' AS "latdAdvertisingPartnerName"
  FROM events_k
)"""

_MART = """
m AS (
  SELECT "trackingId" AS app_name, cid AS c_id, "osTypeCode" AS os_typecode,
    count(*) AS event_count, "trackingEventCode" AS event_typecode, "eventDate" AS event_date,
    "eventHour" AS event_hour
  FROM e GROUP BY ALL
)"""

_PURCHASES = """
p AS (
  SELECT c_mktsegment AS app_name,
    CASE o_orderstatus WHEN 'F' THEN 'ATC001' WHEN 'O' THEN 'ATC002' ELSE 'ATC999' END AS os_typecode,
    CAST(o_custkey AS VARCHAR) AS c_id, CAST(l_partkey AS VARCHAR) AS content_id,
    CAST(floor(l_quantity) AS BIGINT) AS quantity_total,
    CAST(floor(l_extendedprice) AS BIGINT) AS amount_total,
    CAST(o_orderdate AS DATE) AS event_date
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
)"""

# Raw logs: every event once per vendor, already with the names and codes that should come out.
_RAW = f"""
events_k AS (SELECT *, {_K} AS k FROM events),
r AS (
  SELECT v.tracking, events_k.*,
    CASE WHEN k % 10 <> 9 THEN 'app_' || (user_id % 5) END AS app,
    CASE v.tracking
      WHEN 'ADBRIX' THEN CASE event_type
        WHEN 'view' THEN 'product_view' WHEN 'click' THEN 'add_to_cart'
        WHEN 'purchase' THEN CASE WHEN k % 4 = 3 THEN 'refund' ELSE 'purchase' END
        WHEN 'signup' THEN 'sign_up'
        WHEN 'error' THEN CASE k % 4
          WHEN 0 THEN 'search' WHEN 1 THEN 'login' WHEN 2 THEN 'add_to_wishlist' ELSE 'crash' END
      END
      WHEN 'BRANCH' THEN CASE event_type
        WHEN 'view' THEN 'VIEW_ITEM' WHEN 'click' THEN 'ADD_TO_CART' WHEN 'purchase' THEN 'PURCHASE'
        WHEN 'signup' THEN 'INSTALL'
        WHEN 'error' THEN CASE k % 3 WHEN 0 THEN 'SEARCH' WHEN 1 THEN 'OPEN' ELSE 'CRASH' END
      END
      ELSE CASE event_type
        WHEN 'view' THEN 'ViewItem' WHEN 'click' THEN 'AddToCart'
        WHEN 'purchase' THEN CASE k % 3
          WHEN 0 THEN 'Purchase' WHEN 1 THEN 'FirstPurchase' ELSE '__iap__' END
        WHEN 'signup' THEN '__START__'
        WHEN 'error' THEN CASE WHEN k % 2 = 0 THEN '__SESSION__' ELSE 'Crash' END
      END
    END AS event_name,
    CASE v.tracking
      WHEN 'ADBRIX' THEN CASE WHEN user_id % 10 < 5 THEN 'android' WHEN user_id % 10 < 9 THEN 'ios' ELSE 'web' END
      WHEN 'BRANCH' THEN CASE WHEN user_id % 10 < 5 THEN 'ANDROID' WHEN user_id % 10 < 9 THEN 'IOS' ELSE 'WEB' END
      ELSE CASE WHEN user_id % 10 < 5 THEN 'Android' WHEN user_id % 10 < 9 THEN 'iOS' ELSE 'Web' END
    END AS platform,
    CASE WHEN user_id % 10 < 5 THEN 'g-' || user_id
         WHEN user_id % 10 < 9 OR v.tracking <> 'BRANCH' THEN 'i-' || user_id END AS device,
    CASE WHEN user_id % 10 < 5 THEN 'ATC001' WHEN user_id % 10 < 9 THEN 'ATC002' ELSE 'ATC999' END AS os,
    k % 5 + 1 AS items
  FROM events_k, (VALUES ('ADBRIX'), ('BRANCH'), ('SINGULAR')) AS v(tracking)
),
s AS (
  SELECT tracking, app AS "trackingId",
    CASE event_type
      WHEN 'view' THEN 'TPD002'
      WHEN 'click' THEN 'TPD003'
      WHEN 'purchase' THEN CASE
        WHEN tracking = 'ADBRIX' AND k % 4 = 3 THEN 'TPD015'
        WHEN tracking = 'SINGULAR' AND k % 3 = 1 THEN 'TPD010'
        WHEN tracking = 'SINGULAR' AND k % 3 = 2 THEN 'TPD011'
        ELSE 'TPD004' END
      WHEN 'signup' THEN CASE WHEN tracking = 'ADBRIX' THEN 'TPD012' ELSE 'TPD008' END
      ELSE CASE
        WHEN tracking = 'ADBRIX' THEN CASE k % 4
          WHEN 0 THEN 'TPD001' WHEN 1 THEN 'TPD013' WHEN 2 THEN 'TPD014' ELSE 'TPD999' END
        WHEN tracking = 'BRANCH' THEN CASE k % 3 WHEN 0 THEN 'TPD007' WHEN 1 THEN 'TPD009' ELSE 'TPD999' END
        ELSE CASE WHEN k % 2 = 0 THEN 'TPD009' ELSE 'TPD999' END END
    END AS "trackingEventCode",
    device AS cid, os AS "osTypeCode",
    date_trunc('second', ts + INTERVAL 5999 MILLISECOND) AS "logTimeStamp",
    date_trunc('second', ts) AS "eventTimeStamp",
    CAST(ts AS DATE) AS "eventDate",
    strftime(ts, '%H') AS "eventHour",
    CASE WHEN tracking = 'ADBRIX' THEN '' ELSE 'c' || (k % 7) END AS campaign,
    CASE WHEN tracking = 'SINGULAR' AND event_name <> '__iap__' THEN 'x' || k ELSE 'p' || k END AS "contentId",
    CASE WHEN tracking = 'BRANCH' THEN '' ELSE 'item ' || k END AS "contentName",
    CASE WHEN tracking = 'SINGULAR' AND event_name <> '__iap__' THEN 0
         ELSE CAST(floor(value) AS INTEGER) END AS value,
    CASE WHEN tracking = 'SINGULAR' AND event_name <> '__iap__' THEN 0
         ELSE CAST(items AS INTEGER) END AS quantity,
    CAST(floor(value * items) AS INTEGER) AS amount,
    CASE WHEN k % 2 = 0 THEN 'KRW' ELSE 'USD' END AS currency,
    CASE tracking WHEN 'ADBRIX' THEN props WHEN 'BRANCH' THEN ''
      ELSE '[{{"id":"p' || k || '","prd_code":"x' || k || '","product":"item ' || k || '","price":'
        || CAST(value AS VARCHAR) || ',"quantity":' || items || '}}]' END AS "activityParam",
    CASE tracking WHEN 'ADBRIX' THEN '' WHEN 'BRANCH' THEN CASE WHEN user_id % 2 = 0 THEN 'true' ELSE 'false' END
      ELSE CASE WHEN user_id % 2 = 0 THEN '1' ELSE '0' END END AS attributed,
    CASE WHEN tracking = 'BRANCH' THEN 'partner' || (user_id % 4) ELSE '' END AS "latdAdvertisingPartnerName"
  FROM r
),
kept AS (SELECT * FROM s WHERE "trackingId" IS NOT NULL)"""


def _e(select: str) -> str:
    return f"WITH {_EVENTS}\n{select}"


def _m(select: str, *more: str) -> str:
    return "WITH " + ",".join([_EVENTS, _MART, *more]) + f"\n{select}"


def _p(select: str, *more: str) -> str:
    return "WITH " + ",".join([_PURCHASES, *more]) + f"\n{select}"


def _r(select: str) -> str:
    return f"WITH {_RAW}\n{select}"


def _round2(number: str) -> str:
    return f"CAST(CAST(CAST({number} AS VARCHAR) AS DECIMAL(38, 2)) AS DOUBLE)"


def _parts(day: str) -> str:
    return (
        f"CAST(year({day}) AS INTEGER) AS event_year, CAST(month({day}) AS INTEGER) AS event_month, "
        f"CAST(day({day}) AS INTEGER) AS event_day"
    )


_IN_2024 = "BETWEEN DATE '2024-01-01' AND DATE '2024-12-31'"
_SALES_YEARS = "event_date BETWEEN DATE '1995-01-01' AND DATE '2002-01-01'"

_DAILY = f"""
d AS (
  SELECT app_name, os_typecode, event_date, CAST(sum(amount_total) AS BIGINT) AS amount_total
  FROM p WHERE {_SALES_YEARS} GROUP BY ALL
)"""


def _purchase_mart(day: str, also: str = "") -> str:
    return _e(f"""
SELECT "trackingId" AS app_name, "osTypeCode" AS os_typecode, cid AS c_id, "contentId" AS content_id,
  CAST(sum(quantity) AS BIGINT) AS quantity_total, CAST(sum(amount) AS BIGINT) AS amount_total,
  {day} AS event_date, {_parts(day)}
FROM e WHERE amount > 0 AND "trackingEventCode" = 'TPD004' {also}
GROUP BY "trackingId", "osTypeCode", cid, "contentId", {day}""")


def _histogram(table: str, width: int, low: int, high: int) -> str:
    return f"""
SELECT bucket, CAST({width} * (bucket - 1) AS DOUBLE) AS lower_limit,
  CAST({width} * bucket AS DOUBLE) AS upper_limit,
  count(*) AS num_purchase, CAST(sum(price) AS BIGINT) AS total_amount
FROM (SELECT price, CAST(price // {width} + 1 AS BIGINT) AS bucket
      FROM ({table}) WHERE price > {low} AND price <= {high})
GROUP BY bucket"""


def _lead_time_columns() -> str:
    flags = {
        **{f"purchase_{h}_hour": f"coalesce(lead_time <= {h * 3600}, false)" for h in (1, 6, 24, 48)},
        "not_purchase": "purchase_date IS NULL",
        "not_add_cart_purchase": "lead_time IS NULL AND purchase_date IS NOT NULL",
    }
    return ", ".join(
        f"count(*) FILTER (WHERE {flag}) AS {name}, "
        + _round2(f"avg(CASE WHEN {flag} THEN 1 ELSE 0 END)")
        + f" AS {name}_rate"
        for name, flag in flags.items()
    )


def _weekday_columns() -> str:
    days = ("Sun", "Mon", "Tue", "Wed", "Thu", "Fri", "Sat")
    return ", ".join(
        f"nullif(count(*) FILTER (WHERE dayofweek(event_date) = {n}), 0) AS {d.lower()}"
        for n, d in enumerate(days)
    )


def oracle_sql() -> dict[str, str]:
    """SQL by query name."""
    return {
        "raw_scan": _r("""
SELECT tracking, CAST(epoch_us(ts) // 1000 + 5999 AS VARCHAR) AS log_time, app, event_name,
  CAST(CASE WHEN tracking = 'BRANCH' THEN epoch_us(ts) // 1000 ELSE epoch_us(ts) // 1000000 END AS VARCHAR) AS event_time,
  DATE '2024-01-30' AS run_date
FROM r"""),
        "standardize_adbrix": _r("SELECT * FROM s WHERE tracking = 'ADBRIX'"),
        "standardize_branch": _r("SELECT * FROM s WHERE tracking = 'BRANCH'"),
        "standardize_singular": _r("SELECT * FROM s WHERE tracking = 'SINGULAR'"),
        "union_events": _r("SELECT * FROM kept"),
        "drop_no_app": _r("""
SELECT tracking, "trackingId", "osTypeCode", count(*) AS kept FROM kept GROUP BY ALL"""),
        "event_code_map": _r("""
SELECT s.tracking, event_name, "trackingEventCode" AS event_code, count(*) AS lines
FROM (SELECT tracking, "trackingEventCode", row_number() OVER () AS n FROM s) AS s
JOIN (SELECT event_name, row_number() OVER () AS n FROM r) AS r USING (n) GROUP BY ALL"""),
        "os_code_map": _r("""
SELECT tracking, platform, os AS os_code, count(*) AS lines FROM r GROUP BY ALL"""),
        "device_id": _r("""
SELECT tracking, platform, device AS device_id, count(*) AS lines FROM r GROUP BY ALL"""),
        "epoch_to_time": """
SELECT unit, date_trunc('second', ts) AS moment, CAST(ts + INTERVAL 9 HOUR AS DATE) AS local_date,
  strftime(ts + INTERVAL 9 HOUR, '%H') AS local_hour
FROM events, (VALUES ('s'), ('ms')) AS u(unit)""",
        "json_attrs": _r("""
SELECT "trackingEventCode", "contentId", "contentName", value, quantity FROM s WHERE tracking = 'SINGULAR'"""),
        "next_event_time": _e("""
SELECT tracking, "trackingId", cid, "osTypeCode", "eventTimeStamp",
  lead("eventTimeStamp") OVER (
    PARTITION BY tracking, "trackingId", cid, "osTypeCode" ORDER BY "eventTimeStamp"
  ) AS "nextEventTimeStamp"
FROM e"""),
        "partition_columns": _r("""
SELECT tracking, "trackingId", cid, "eventDate", "eventHour", "eventDate" AS date, "eventHour" AS hour
FROM kept"""),
        "tier1_write": _r("""
SELECT *, "eventHour" AS hour, "eventDate" AS date, DATE '2024-01-30' AS run_date FROM kept"""),
        "tier_scan": _e("""
SELECT *, "eventHour" AS hour, "eventDate" AS date FROM e
WHERE "eventDate" BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'"""),
        "tier2_write": _m(f"SELECT *, {_parts('event_date')}, event_date AS date FROM m"),
        "tuned_parquet_write": _e("SELECT * FROM e"),
        "relayout": _e("""
SELECT *, "eventHour" AS hour, "eventDate" AS date,
  CASE WHEN "trackingEventCode" = 'TPD004' THEN DATE '2024-01-31' ELSE DATE '2024-01-30' END AS run_date
FROM e"""),
        "missing_days": """
SELECT CAST(d AS DATE) AS date
FROM generate_series(TIMESTAMP '2023-12-01', TIMESTAMP '2024-12-31', INTERVAL 1 DAY) AS c(d)
WHERE CAST(d AS DATE) NOT IN (SELECT CAST(ts AS DATE) FROM events)""",
        "catch_up_marts": _r(f"""
SELECT "trackingId" AS app_name, cid AS c_id, "osTypeCode" AS os_typecode, count(*) AS event_count,
  "trackingEventCode" AS event_typecode, "eventDate" AS event_date, {_parts('"eventDate"')}, "eventHour" AS event_hour,
  "eventDate" AS date
FROM kept WHERE cid IS NOT NULL
GROUP BY "trackingId", cid, "osTypeCode", "trackingEventCode", "eventDate", "eventHour" """),
        "raw_quality": _r("""
SELECT tracking, count(*) AS lines, count(*) FILTER (app IS NOT NULL AND event_id % 50 <> 0) AS events,
  count(*) FILTER (event_id % 50 = 0 OR event_id % 50 = 1 AND app IS NULL) AS unreadable,
  count(*) FILTER (app IS NULL AND event_id % 50 > 1) AS no_app,
  count(*) FILTER (app IS NOT NULL AND event_id % 50 = 1) AS partly_read, DATE '2024-01-30' AS run_date
FROM r GROUP BY tracking"""),
        "event_by_user": _m(f"SELECT *, {_parts('event_date')} FROM m"),
        "event_by_user_daily": _e(f"""
SELECT "trackingId" AS app_name, cid AS c_id, "osTypeCode" AS os_typecode, count(*) AS event_count,
  "trackingEventCode" AS event_typecode, "eventDate" AS event_date, {_parts('"eventDate"')}
FROM e GROUP BY "trackingId", cid, "osTypeCode", "trackingEventCode", "eventDate" """),
        "purchase_by_user": _purchase_mart('"eventDate"'),
        "purchase_by_user_from_ts": _purchase_mart('CAST("eventTimeStamp" AS DATE)'),
        "purchase_by_user_from_ts_in_range": _purchase_mart(
            'CAST("eventTimeStamp" AS DATE)',
            """AND CAST("eventTimeStamp" AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'""",
        ),
        "sales_by_event_time": _e(f"""
SELECT "trackingId", "osTypeCode", "eventTimeStamp", count(amount) AS purchased_count,
  CAST(sum(value) AS BIGINT) AS total_value, CAST(sum(amount) AS BIGINT) AS total_amount,
  avg(amount) AS avg_amount
FROM e WHERE CAST("eventTimeStamp" AS DATE) {_IN_2024} GROUP BY "trackingId", "osTypeCode", "eventTimeStamp" """),
        "daily_sales": _p(f"""
SELECT app_name, os_typecode, event_date, count(amount_total) AS purchase_count,
  CAST(sum(amount_total) AS BIGINT) AS amount_total, {_round2('avg(amount_total)')} AS amount_avg
FROM p WHERE {_SALES_YEARS} GROUP BY app_name, os_typecode, event_date"""),
        "moving_avg_7": _p("""
SELECT *, CAST(trunc(amount_avg_7day) AS BIGINT) AS avg FROM (
  SELECT *, CASE WHEN count(*) OVER w = 7 THEN avg(amount_total) OVER w END AS amount_avg_7day FROM d
  WINDOW w AS (PARTITION BY app_name, os_typecode ORDER BY event_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW))
""", _DAILY),
        "running_total": _p("""
SELECT *, CAST(sum(amount_total) OVER (
  PARTITION BY app_name, os_typecode ORDER BY event_date ROWS UNBOUNDED PRECEDING) AS BIGINT) AS amount_agg
FROM d""", _DAILY),
        "month_over_month": _p("""
SELECT *, amount_total - pre_amount AS diff_amount FROM (
  SELECT *, lag(amount_total) OVER (
    PARTITION BY app_name, os_typecode ORDER BY event_year, event_month) AS pre_amount
  FROM (
    SELECT app_name, os_typecode, CAST(year(event_date) AS INTEGER) AS event_year,
      CAST(month(event_date) AS INTEGER) AS event_month, CAST(sum(amount_total) AS BIGINT) AS amount_total
    FROM p WHERE app_name <> '' GROUP BY ALL))"""),
        "price_histogram": _e(
            _histogram("""SELECT value AS price FROM e WHERE "trackingEventCode" = 'TPD004'""", 40, 10, 400)
        ),
        "price_histogram_items": _p(
            _histogram("SELECT amount_total AS price FROM p", 10_000, 100, 100_000)
        ),
        "event_slice": _e(f"""
SELECT * FROM e
WHERE "trackingEventCode" = 'TPD004' AND value = 2 AND "eventDate" {_IN_2024}
ORDER BY ALL LIMIT 1"""),
        "distinct_users": _m(f"SELECT DISTINCT app_name, c_id FROM m WHERE event_date {_IN_2024}"),
        "active_days": _m("""
SELECT app_name, event_day_count, count(*) AS user_count,
  CAST(100 * count(*) AS DOUBLE) / CAST(sum(count(*)) OVER (PARTITION BY app_name) AS DOUBLE) AS composition_ratio,
  CAST(100 * sum(count(*)) OVER (PARTITION BY app_name ORDER BY event_day_count ROWS UNBOUNDED PRECEDING) AS DOUBLE)
    / CAST(sum(count(*)) OVER (PARTITION BY app_name) AS DOUBLE) AS cumulative_ratio
FROM u GROUP BY app_name, event_day_count""", f"""
u AS (
  SELECT app_name, c_id, count(DISTINCT event_date) AS event_day_count
  FROM m WHERE event_date {_IN_2024} GROUP BY app_name, c_id
)"""),
        "hourly_funnel": _m(f"""
SELECT *, search / user_count AS search_per_user, viewcontent / user_count AS viewcontent_per_user,
  addtocart / user_count AS addtocart_per_user, purchase / user_count AS purchase_per_user
FROM (
  SELECT event_date, event_hour, app_name, os_typecode, count(DISTINCT c_id) AS user_count,
    count(*) AS user_access_count,
    count(*) FILTER (WHERE event_typecode = 'TPD008') AS install,
    count(*) FILTER (WHERE event_typecode = 'TPD009') AS open,
    count(*) FILTER (WHERE event_typecode IN ('TPD001', 'TPD007')) AS search,
    count(*) FILTER (WHERE event_typecode = 'TPD002') AS viewcontent,
    count(*) FILTER (WHERE event_typecode IN ('TPD003', 'TPD016')) AS addtocart,
    count(*) FILTER (WHERE event_typecode = 'TPD004') AS purchase
  FROM m WHERE event_date {_IN_2024} GROUP BY event_date, event_hour, app_name, os_typecode)"""),
        "event_venn": _m("""
SELECT app_name, os_typecode,
  CASE v WHEN 1 THEN 'viewcontent' WHEN 0 THEN 'not viewcontent' ELSE 'any' END AS has_viewcontent,
  CASE c WHEN 1 THEN 'cart' WHEN 0 THEN 'not cart' ELSE 'any' END AS has_cart,
  CASE b WHEN 1 THEN 'purchase' WHEN 0 THEN 'not purchase' ELSE 'any' END AS has_purchased,
  user_count,
  CAST(100 * user_count AS DOUBLE) / CAST(max(user_count) OVER (PARTITION BY app_name, os_typecode) AS DOUBLE) AS ratio
FROM (SELECT app_name, os_typecode, v, c, b, count(*) AS user_count
      FROM f GROUP BY app_name, os_typecode, CUBE (v, c, b))""", f"""
f AS (
  SELECT app_name, os_typecode, c_id, max(CASE WHEN event_typecode = 'TPD002' THEN 1 ELSE 0 END) AS v,
    max(CASE WHEN event_typecode = 'TPD003' THEN 1 ELSE 0 END) AS c,
    max(CASE WHEN event_typecode = 'TPD004' THEN 1 ELSE 0 END) AS b
  FROM m WHERE event_date {_IN_2024} AND event_typecode IN ('TPD002', 'TPD003', 'TPD004', 'TPD011')
  GROUP BY app_name, os_typecode, c_id
)"""),
        "weekday_by_hour": _m(f"""
SELECT app_name, event_hour, {_weekday_columns()}
FROM m WHERE event_date {_IN_2024} GROUP BY app_name, event_hour"""),
        "slice_count": _m(f"""
SELECT count(*) AS row_count FROM m
WHERE app_name = 'app_1' AND event_hour = '00' AND dayofweek(event_date) = 1 AND event_date {_IN_2024}"""),
        "cart_lead_time": _e(f"""
SELECT app_name, os_typecode, add_cart_date, count(*) AS add_cart, {_lead_time_columns()}
FROM (
  SELECT app_name, os_typecode, c_id, content_id, min(cart_day) AS add_cart_date, min(buy_day) AS purchase_date,
    CAST(epoch(min(buy_time)) - epoch(min(cart_time)) AS BIGINT) AS lead_time
  FROM (
    SELECT "trackingId" AS app_name, "osTypeCode" AS os_typecode, cid AS c_id, "contentId" AS content_id,
      CASE WHEN "trackingEventCode" = 'TPD003' THEN "eventDate" END AS cart_day,
      CASE WHEN "trackingEventCode" = 'TPD003' THEN "eventTimeStamp" END AS cart_time,
      CASE WHEN "trackingEventCode" = 'TPD004' THEN "eventDate" END AS buy_day,
      CASE WHEN "trackingEventCode" = 'TPD004' THEN "eventTimeStamp" END AS buy_time
    FROM e
    WHERE "eventDate" {_IN_2024} AND "osTypeCode" <> 'ATC999' AND "trackingEventCode" IN ('TPD003', 'TPD004'))
  GROUP BY app_name, os_typecode, c_id, content_id)
GROUP BY app_name, os_typecode, add_cart_date"""),
        "post_signup_events": _m(f"""
SELECT g.app_name, g.c_id, g.event_date AS register_date, t.event_typecode, t.event_date
FROM m AS g JOIN m AS t ON t.app_name = g.app_name AND t.c_id = g.c_id AND t.event_date >= g.event_date
WHERE g.event_typecode = 'TPD012' AND g.event_date {_IN_2024} AND t.event_date {_IN_2024}
  AND g.c_id <> '00000000-0000-0000-0000-000000000000'"""),
        "signup_retention": _m(f"""
SELECT app_name, register_date, index_name, {_round2('avg(100.0::DOUBLE * flag)')} AS repeat_rate
FROM (
  SELECT g.app_name, g.c_id, g.register_date, printf('%02d day repeat', o.k) AS index_name,
    CASE WHEN g.register_date + o.k <= l.latest THEN
      CASE WHEN EXISTS (SELECT 1 FROM m AS t WHERE t.app_name = g.app_name AND t.c_id = g.c_id
                        AND t.event_date = g.register_date + o.k AND t.event_date {_IN_2024})
      THEN 1 ELSE 0 END END AS flag
  FROM (SELECT DISTINCT app_name, c_id, event_date AS register_date FROM m
        WHERE event_typecode = 'TPD012' AND event_date {_IN_2024}
          AND c_id <> '00000000-0000-0000-0000-000000000000') AS g
  JOIN (SELECT app_name, c_id, max(event_date) AS latest FROM m WHERE event_date {_IN_2024}
        GROUP BY app_name, c_id) AS l USING (app_name, c_id),
  (SELECT CAST(unnest(range(1, 8)) AS INTEGER) AS k) AS o)
GROUP BY app_name, register_date, index_name"""),
        "cast_avg_bigint": _p("""
SELECT app_name, CAST(trunc(avg(amount_total)) AS BIGINT) AS amount_avg FROM p GROUP BY app_name"""),
        "date_diff_days": """
SELECT CAST(CAST(l_shipdate AS DATE) - CAST(o_orderdate AS DATE) AS INTEGER) AS ship_days, count(*) AS items
FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL""",
        "round_2": f"""
SELECT l_orderkey, l_linenumber, {_round2('l_extendedprice * l_discount')} AS discount FROM lineitem""",
        "second_diff": """
SELECT user_id, CAST(epoch(date_trunc('second', max(ts))) - epoch(date_trunc('second', min(ts))) AS BIGINT)
  AS active_seconds
FROM events GROUP BY user_id""",
    }
