"""DuckDB SQL twins of the registered queries (the correctness oracle).

Written independently of the Spark code, straight from the definitions in
FIXTURES.md, over the driver's tables registered as views.  Column names
match the Spark results exactly.
"""

from __future__ import annotations

# ------------------------------------------------------------ shared CTEs

STARTUP = """
startup AS (
  SELECT 'mid_' || CAST(user_id AS VARCHAR) AS mid, CAST(user_id AS VARCHAR) AS uid,
         'shop_app' AS appid, 'startup' AS log_type,
         epoch_us(ts) // 1000 AS ts, event_id AS log_id,
         strftime(ts, '%Y-%m-%d') AS log_date, strftime(ts, '%H') AS log_hour
  FROM events)"""

FIRST_VISITS = STARTUP + """,
fv AS (
  SELECT mid, uid, appid, log_type, log_date, log_hour, ts FROM (
    SELECT *, row_number() OVER (PARTITION BY mid, log_date ORDER BY ts, log_id) AS rn
    FROM startup) WHERE rn = 1)"""

NEW_MID = FIRST_VISITS + """,
nm AS (
  SELECT log_date, count(*) AS ct FROM (SELECT mid, min(log_date) AS log_date FROM fv GROUP BY mid)
  GROUP BY log_date)"""

ORDERS = """
o_raw AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS id, CAST(o_custkey AS VARCHAR) AS user_id,
         '1' || lpad(CAST((o_orderkey * 1234577) % 10000000000 AS VARCHAR), 10, '0') AS tel,
         o_orderstatus AS order_status, o_totalprice AS total_amount,
         strftime(o_orderdate + to_seconds((o_orderkey * 7919) % 86400), '%Y-%m-%d %H:%M:%S')
           AS create_time
  FROM orders),
oc AS (
  SELECT id, user_id, substring(tel, 1, 4) || '*******' AS consignee_tel, order_status,
         total_amount, create_time,
         split_part(create_time, ' ', 1) AS create_date,
         split_part(split_part(create_time, ' ', 2), ':', 1) AS create_hour
  FROM o_raw)"""

HOURS = """
hours AS (SELECT lpad(CAST(h AS VARCHAR), 2, '0') AS hour FROM range(24) t(h))"""


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"


SQL: dict[str, str] = {}

# ---------------------------------------------------------------- DAU family

SQL["dau_first_visits"] = _with(FIRST_VISITS) + "SELECT * FROM fv"

SQL["dau_total"] = _with(FIRST_VISITS) + \
    "SELECT log_date, count(*) AS ct FROM fv GROUP BY log_date"

SQL["dau_total_day"] = _with(FIRST_VISITS) + \
    "SELECT count(*) AS ct FROM fv WHERE log_date = '2024-01-15'"

SQL["dau_hour"] = _with(FIRST_VISITS) + \
    "SELECT log_date, log_hour, count(*) AS ct FROM fv GROUP BY log_date, log_hour"

SQL["dau_hour_day"] = _with(FIRST_VISITS) + \
    "SELECT log_hour, count(*) AS ct FROM fv WHERE log_date = '2024-01-15' GROUP BY log_hour"

SQL["new_mid"] = _with(NEW_MID) + "SELECT log_date, ct FROM nm"

SQL["new_mid_day"] = _with(NEW_MID) + \
    "SELECT count(*) AS ct FROM (SELECT mid, min(log_date) AS d FROM fv GROUP BY mid) " \
    "WHERE d = '2024-01-01'"

# ------------------------------------------------------------- order family

SQL["orders_clean"] = _with(ORDERS) + \
    "SELECT id, user_id, consignee_tel, order_status, total_amount, create_time, " \
    "create_date, create_hour FROM oc"

SQL["order_amount_total"] = _with(ORDERS) + \
    "SELECT create_date, round(sum(total_amount), 2) AS order_amount FROM oc GROUP BY create_date"

SQL["order_amount_total_day"] = _with(ORDERS) + \
    "SELECT round(sum(total_amount), 2) AS order_amount FROM oc WHERE create_date = '1997-02-01'"

SQL["order_amount_hour"] = _with(ORDERS) + \
    "SELECT create_date, create_hour, round(sum(total_amount), 2) AS order_amount " \
    "FROM oc GROUP BY create_date, create_hour"

SQL["first_order_flag"] = _with(ORDERS) + """
SELECT id, user_id, create_time,
       CASE WHEN row_number() OVER (PARTITION BY user_id ORDER BY create_time, id) = 1
            THEN '1' ELSE '0' END AS is_first_order
FROM oc"""

SQL["order_amount_by_province"] = _with(ORDERS) + """
SELECT CAST(c.c_nationkey AS VARCHAR) AS province_id, oc.create_date,
       round(sum(oc.total_amount), 2) AS order_amount
FROM oc LEFT JOIN customer c ON oc.user_id = CAST(c.c_custkey AS VARCHAR)
GROUP BY 1, 2"""

# -------------------------------------------------------- dashboard composites

SQL["realtime_total"] = _with(NEW_MID, ORDERS) + """
SELECT log_date AS date, 'dau' AS id, '新增日活' AS name, CAST(count(*) AS DOUBLE) AS value
FROM fv GROUP BY log_date
UNION ALL
SELECT log_date AS date, 'new_mid', '新增设备', CAST(ct AS DOUBLE) FROM nm
UNION ALL
SELECT create_date, 'order_amount', '新增交易额', round(sum(total_amount), 2) FROM oc
GROUP BY create_date"""

SQL["realtime_total_busy_day"] = _with(NEW_MID, ORDERS) + """
SELECT 'dau' AS id, '新增日活' AS name,
       CAST((SELECT count(*) FROM fv WHERE log_date = '2024-01-01') AS DOUBLE) AS value
UNION ALL
SELECT 'new_mid', '新增设备', CAST(count(*) AS DOUBLE)
FROM (SELECT mid, min(log_date) AS d FROM fv GROUP BY mid) WHERE d = '2024-01-01'
UNION ALL
SELECT 'order_amount', '新增交易额', round(sum(total_amount), 2) FROM oc
WHERE create_date = '1997-02-01'"""

SQL["realtime_total_day"] = _with(NEW_MID, ORDERS) + """
SELECT 'dau' AS id, '新增日活' AS name,
       CAST((SELECT count(*) FROM fv WHERE log_date = '2024-01-15') AS DOUBLE) AS value
UNION ALL
SELECT 'new_mid', '新增设备', CAST(count(*) AS DOUBLE)
FROM (SELECT mid, min(log_date) AS d FROM fv GROUP BY mid) WHERE d = '2024-01-15'
UNION ALL
SELECT 'order_amount', '新增交易额', round(sum(total_amount), 2) FROM oc
WHERE create_date = '2024-01-15'"""


def _today_vs_yesterday(src: str, date_col: str, hour_col: str, value: str) -> str:
    return f"""
series AS (
  SELECT date, hour, sum(today) AS today, sum(yesterday) AS yesterday FROM (
    SELECT {date_col} AS date, {hour_col} AS hour, {value} AS today, NULL AS yesterday FROM {src}
    UNION ALL
    SELECT strftime(CAST({date_col} AS DATE) + 1, '%Y-%m-%d'), {hour_col}, NULL, {value} FROM {src})
  GROUP BY date, hour),
filled AS (
  SELECT d.date, h.hour, coalesce(s.today, 0.0) AS today, coalesce(s.yesterday, 0.0) AS yesterday
  FROM (SELECT DISTINCT date FROM series) d CROSS JOIN hours h
  LEFT JOIN series s ON s.date = d.date AND s.hour = h.hour)"""


SQL["realtime_hour_dau"] = _with(FIRST_VISITS, HOURS,
                                 _today_vs_yesterday("fv", "log_date", "log_hour", "CAST(1 AS DOUBLE)")) + \
    "SELECT date, hour, today, yesterday FROM filled"

SQL["realtime_hour_dau_day"] = _with(FIRST_VISITS, HOURS) + """
SELECT '2024-01-15' AS date, h.hour,
       CAST(coalesce((SELECT count(*) FROM fv WHERE log_date = '2024-01-15' AND log_hour = h.hour), 0)
            AS DOUBLE) AS today,
       CAST(coalesce((SELECT count(*) FROM fv WHERE log_date = '2024-01-14' AND log_hour = h.hour), 0)
            AS DOUBLE) AS yesterday
FROM hours h"""

SQL["realtime_hour_amount"] = _with(ORDERS, HOURS,
                                    _today_vs_yesterday("oc", "create_date", "create_hour",
                                                        "total_amount")) + \
    "SELECT date, hour, round(today, 2) AS today, round(yesterday, 2) AS yesterday FROM filled"

# ------------------------------------------------------- sales and search

USERS = """
users AS (
  SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS login_name,
         CAST(c_custkey % 4 + 1 AS VARCHAR) AS user_level,
         strftime(DATE '1950-01-01' + CAST((c_custkey * 7919) % 22000 AS INTEGER), '%Y-%m-%d')
           AS birthday,
         CASE WHEN c_custkey % 2 = 0 THEN 'M' ELSE 'F' END AS gender
  FROM customer),
ages AS (
  SELECT id, gender, user_level,
         CAST(date_diff('day', CAST(birthday AS DATE), DATE '2020-01-01') // 365 AS INTEGER) AS age
  FROM users)"""

DETAILS = """
det AS (
  SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) || '-' ||
         CAST(l_partkey AS VARCHAR) || '-' || CAST(l_suppkey AS VARCHAR) AS order_detail_id,
         CAST(l_orderkey AS VARCHAR) AS order_id, CAST(l_partkey AS VARCHAR) AS sku_id,
         p_name AS sku_name, p_retailprice AS sku_price,
         epoch_us(l_shipdate) // 1000 AS d_ts, l_extendedprice AS d_price
  FROM lineitem JOIN part ON l_partkey = p_partkey)"""

ORDER_TS = """
ots AS (SELECT CAST(o_orderkey AS VARCHAR) AS id, epoch_us(o_orderdate) // 1000 AS o_ts FROM orders)"""

SALE_INDEX = ORDERS + "," + USERS + "," + DETAILS + """,
sale_all AS (
  SELECT det.order_detail_id, oc.id AS order_id, oc.order_status, oc.create_time, oc.user_id,
         det.sku_id, a.gender AS user_gender, coalesce(a.age, 0) AS user_age,
         a.user_level, det.sku_price, det.sku_name, oc.create_date AS dt, det.d_ts, det.d_price
  FROM oc JOIN det ON det.order_id = oc.id LEFT JOIN ages a ON a.id = oc.user_id),
sale_idx AS (
  SELECT order_detail_id, order_id, order_status, create_time, user_id, sku_id, user_gender,
         user_age, user_level, sku_price, sku_name, dt
  FROM (SELECT *, row_number() OVER (PARTITION BY order_detail_id
                                     ORDER BY d_ts DESC, d_price DESC) AS rn FROM sale_all)
  WHERE rn = 1)"""


def _match(keyword_terms: list[str]) -> str:
    terms = ", ".join(f"'{t}'" for t in keyword_terms)
    return (f"list_has_all(regexp_extract_all(lower(sku_name), '\\p{{Han}}|[\\p{{L}}\\p{{N}}]+'), "
            f"[{terms}])")


HITS = SALE_INDEX + f""",
hits AS (SELECT * FROM sale_idx WHERE {_match(['widget'])})"""

SQL["user_latest"] = _with(USERS) + "SELECT id, login_name, user_level, birthday, gender FROM users"

SQL["user_age_bands"] = _with(USERS) + """
SELECT CASE WHEN age < 20 THEN 'lt20' WHEN age <= 30 THEN '20to30' ELSE 'gt30' END AS band,
       count(*) AS ct
FROM ages GROUP BY 1"""

SQL["sale_join"] = _with(ORDERS, DETAILS, ORDER_TS) + """
SELECT det.order_detail_id, oc.id AS order_id, oc.order_status, oc.create_time, oc.user_id,
       det.sku_id, det.sku_price, det.sku_name, oc.create_date AS dt
FROM oc JOIN ots ON ots.id = oc.id JOIN det ON det.order_id = oc.id
WHERE det.d_ts > ots.o_ts - 7776000000 AND det.d_ts < ots.o_ts + 7776000000"""

SQL["sale_detail"] = _with(SALE_INDEX) + "SELECT * FROM sale_idx"

SQL["sale_search"] = _with(SALE_INDEX) + f"SELECT * FROM sale_idx WHERE {_match(['widget', 'cold'])}"

SQL["sale_search_day"] = _with(SALE_INDEX) + \
    f"SELECT * FROM sale_idx WHERE dt = '1997-02-01' AND {_match(['widget'])}"

SQL["sale_gender_terms"] = _with(HITS) + """
SELECT user_gender, count(*) AS doc_count FROM hits WHERE user_gender IS NOT NULL
GROUP BY user_gender ORDER BY doc_count DESC, user_gender LIMIT 2"""

SQL["sale_age_terms"] = _with(HITS) + """
SELECT user_age, count(*) AS doc_count FROM hits WHERE user_age IS NOT NULL
GROUP BY user_age ORDER BY doc_count DESC, user_age LIMIT 100"""


def _ratio(cond: str) -> str:
    return (f"CASE WHEN count(*) = 0 THEN 0.0 ELSE "
            f"floor(count(*) FILTER (WHERE {cond}) * 1000.0 / count(*) + 0.5) / 10.0 END")


SQL["sale_age_stat"] = _with(HITS) + f"""
SELECT count(*) AS total, {_ratio('user_age < 20')} AS age_lt20,
       {_ratio('user_age >= 20 AND user_age <= 30')} AS age_20to30,
       {_ratio('user_age > 30')} AS age_gt30
FROM hits"""

SQL["sale_gender_stat"] = _with(HITS) + f"""
SELECT count(*) AS total, {_ratio("user_gender = 'M'")} AS male,
       {_ratio("user_gender = 'F'")} AS female
FROM hits"""

SQL["sale_page"] = _with(HITS) + "SELECT * FROM hits ORDER BY order_detail_id LIMIT 20 OFFSET 40"

SQL["sale_detail_report"] = _with(HITS) + f"""
SELECT count(*) AS total, {_ratio('user_age < 20')} AS age_lt20,
       {_ratio('user_age >= 20 AND user_age <= 30')} AS age_20to30,
       {_ratio('user_age > 30')} AS age_gt30,
       {_ratio("user_gender = 'M'")} AS male, {_ratio("user_gender = 'F'")} AS female,
       (SELECT string_agg(order_detail_id, ',' ORDER BY order_detail_id) FROM
          (SELECT order_detail_id FROM hits ORDER BY order_detail_id LIMIT 10 OFFSET 10))
         AS detail_ids
FROM hits"""

DAY_HITS = "(SELECT * FROM hits WHERE dt = '1997-02-01')"

SQL["sale_report_stat"] = _with(HITS) + " UNION ALL ".join(
    f"SELECT count(*) AS total, '{title}' AS title, '{name}' AS name, {_ratio(rule)} AS value FROM {DAY_HITS}"
    for title, name, rule in (
        ("年龄占比", "20岁以下", "user_age < 20"),
        ("年龄占比", "20岁到30岁", "user_age >= 20 AND user_age <= 30"),
        ("年龄占比", "30岁以上", "user_age > 30"),
        ("性别占比", "男", "user_gender = 'M'"),
        ("性别占比", "女", "user_gender = 'F'")))

SQL["sale_report_detail"] = _with(HITS) + \
    f"SELECT * FROM {DAY_HITS} ORDER BY order_detail_id LIMIT 10 OFFSET 10"

SQL["sale_search_postings"] = SQL["sale_search"]

SQL["sale_page_after"] = SQL["sale_page"]

SQL["sale_age_terms_top"] = SQL["sale_age_terms"].replace("LIMIT 100", "LIMIT 5")

# ------------------------------------------------------------------ alerts

EVENT_LOG = """
ev AS (
  SELECT 'mid_' || CAST(user_id % 5 AS VARCHAR) AS mid, CAST(user_id AS VARCHAR) AS uid,
         CASE event_type WHEN 'purchase' THEN 'coupon' WHEN 'click' THEN 'clickItem'
              WHEN 'view' THEN CASE WHEN event_id % 3 = 0 THEN 'view_' || CAST(event_id % 4 AS VARCHAR)
                                    ELSE 'addCart' END
              WHEN 'signup' THEN 'addFavor' WHEN 'error' THEN 'addComment' END AS evid,
         json_extract_string(props, '$.k') AS itemid,
         epoch_us(ts) // 1000 AS ts
  FROM events)"""


def _alerts_sql(window_ms: int, slide_ms: int, min_uids: int) -> str:
    n = window_ms // slide_ms
    return f"""
win AS (
  SELECT mid, (ts // {slide_ms} - k) * {slide_ms} AS window_start, uid, evid, itemid
  FROM ev, range(0, {n}) t(k)),
agg AS (
  SELECT mid, window_start,
         list_sort(list_distinct(list(uid) FILTER (WHERE evid = 'coupon'))) AS uids,
         list_sort(list_distinct(list(itemid) FILTER (WHERE evid = 'coupon'))) AS item_ids,
         count(*) FILTER (WHERE evid = 'clickItem') AS clicks
  FROM win GROUP BY mid, window_start),
per_evid AS (SELECT mid, window_start, evid, count(*) AS n FROM win GROUP BY mid, window_start, evid),
alert_events AS (
  SELECT mid || '_' || CAST((window_start + {window_ms}) // 60000 AS VARCHAR) AS alert_id,
         window_start + {window_ms} AS ts, mid, window_start, evid, n
  FROM per_evid JOIN agg USING (mid, window_start) WHERE len(uids) >= {min_uids} AND clicks = 0),
alerts AS (
  SELECT mid || '_' || CAST((window_start + {window_ms}) // 60000 AS VARCHAR) AS alert_id, mid,
         array_to_string(uids, ',') AS uids, array_to_string(item_ids, ',') AS item_ids,
         (SELECT string_agg(evid || ':' || CAST(n AS VARCHAR), ',' ORDER BY evid) FROM per_evid p
          WHERE p.mid = agg.mid AND p.window_start = agg.window_start) AS events,
         window_start + {window_ms} AS ts
  FROM agg WHERE len(uids) >= {min_uids} AND clicks = 0)"""


SQL["coupon_alert"] = _with(EVENT_LOG, _alerts_sql(7_200_000, 1_800_000, 3)) + \
    "SELECT * FROM alerts"

SQL["coupon_alert_header"] = _with(EVENT_LOG, _alerts_sql(7_200_000, 1_800_000, 3)) + """
SELECT alert_id, mid, CAST(len(string_split(uids, ',')) AS BIGINT) AS n_uids,
       CAST(CASE WHEN item_ids = '' THEN 0 ELSE len(string_split(item_ids, ',')) END AS BIGINT)
         AS n_items,
       events, ts
FROM alerts"""

SQL["coupon_alert_uids"] = _with(EVENT_LOG, _alerts_sql(7_200_000, 1_800_000, 3)) + """
SELECT alert_id, ts, unnest(string_split(uids, ',')) AS uid FROM alerts"""

SQL["coupon_alert_events"] = _with(EVENT_LOG, _alerts_sql(7_200_000, 1_800_000, 3)) + \
    "SELECT alert_id, ts, evid, n FROM alert_events"

SQL["coupon_alert_items"] = _with(EVENT_LOG, _alerts_sql(7_200_000, 1_800_000, 3)) + """
SELECT alert_id, ts, unnest(string_split(item_ids, ',')) AS itemid FROM alerts
WHERE item_ids <> ''"""

SQL["coupon_alert_per_bucket"] = _with(EVENT_LOG, _alerts_sql(7_200_000, 1_800_000, 3)) + """
SELECT alert_id, mid, uids, item_ids, events, ts FROM (
  SELECT *, row_number() OVER (PARTITION BY alert_id ORDER BY ts DESC, mid DESC, uids DESC) AS rn
  FROM alerts) WHERE rn = 1"""

SQL["coupon_alert_per_hour"] = _with(EVENT_LOG, _alerts_sql(7_200_000, 1_800_000, 3)) + """
SELECT hour_id AS alert_id, mid, uids, item_ids, events, ts FROM (
  SELECT *, mid || '_' || CAST(ts // 3600000 AS VARCHAR) AS hour_id,
         row_number() OVER (PARTITION BY mid || '_' || CAST(ts // 3600000 AS VARCHAR)
                            ORDER BY ts DESC, mid DESC, uids DESC) AS rn
  FROM alerts) WHERE rn = 1"""

# ------------------------------------------------------------------ ingest

SQL["route_logs"] = """
SELECT CASE WHEN event_type = 'signup' THEN 'SHOP_STARTUP' ELSE 'SHOP_EVENT' END AS topic,
       event_id AS log_id,
       CASE WHEN event_type = 'signup' THEN 'startup' ELSE 'event' END AS type,
       'mid_' || CAST(user_id AS VARCHAR) AS mid, CAST(user_id AS VARCHAR) AS uid,
       CASE event_type WHEN 'purchase' THEN 'coupon' WHEN 'click' THEN 'clickItem'
            WHEN 'view' THEN 'addCart' WHEN 'error' THEN 'addComment' END AS evid,
       CASE WHEN event_type <> 'signup' THEN json_extract_string(props, '$.k') END AS itemid,
       epoch_us(ts) // 1000 AS ts
FROM events"""

CDC_ROWS = ORDERS + "," + DETAILS + """,
changes AS (
  SELECT 'order_info' AS table_name, CAST(id AS BIGINT) AS seq,
         to_json(MAP(['id', 'user_id', 'consignee_tel', 'order_status', 'total_amount',
                      'create_time'],
                     [id, user_id, tel, order_status, CAST(total_amount AS VARCHAR),
                      create_time])) AS value
  FROM o_raw
  UNION ALL
  SELECT 'order_detail', CAST(l_orderkey AS BIGINT),
         to_json(MAP(['id', 'order_id', 'sku_name', 'sku_id', 'order_price', 'sku_num'],
                     [CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) || '-' ||
                      CAST(l_partkey AS VARCHAR) || '-' || CAST(l_suppkey AS VARCHAR),
                      CAST(l_orderkey AS VARCHAR), p_name, CAST(l_partkey AS VARCHAR),
                      CAST(p_retailprice AS VARCHAR), CAST(l_quantity AS VARCHAR)]))
  FROM lineitem JOIN part ON l_partkey = p_partkey
  UNION ALL
  SELECT 'user_info', c_custkey,
         to_json(MAP(['id', 'login_name', 'user_level', 'birthday', 'gender'],
                     [CAST(c_custkey AS VARCHAR), c_name, CAST(c_custkey % 4 + 1 AS VARCHAR),
                      strftime(DATE '1950-01-01' + CAST((c_custkey * 7919) % 22000 AS INTEGER),
                               '%Y-%m-%d'),
                      CASE WHEN c_custkey % 2 = 0 THEN 'M' ELSE 'F' END]))
  FROM customer),
cdc_rows AS (
  SELECT table_name, ['INSERT', 'UPDATE', 'DELETE'][CAST(seq % 3 AS INTEGER) + 1] AS event_type,
         seq, row_no,
         CASE row_no WHEN 0 THEN value
              ELSE regexp_replace(value, '^[{]"id":"([^"]*)"', '{"id":"\\1+1"') END AS value
  FROM changes, (VALUES (0), (1)) AS r(row_no)
  WHERE row_no = 0 OR seq % 2 = 0)"""

SQL["cdc_after_image"] = _with(CDC_ROWS) + "SELECT * FROM cdc_rows"

SQL["cdc_route"] = _with(CDC_ROWS) + """
SELECT CASE WHEN table_name = 'order_info' THEN 'SHOP_ORDER'
            WHEN table_name = 'order_detail' THEN 'SHOP_ORDER_DETAIL'
            ELSE 'SHOP_USER' END AS topic,
       table_name, event_type, seq, row_no, value
FROM cdc_rows
WHERE (table_name IN ('order_info', 'order_detail') AND event_type = 'INSERT')
   OR (table_name = 'user_info' AND event_type IN ('INSERT', 'UPDATE'))"""

# Lines whose log id divides by 5 are cut short, else by 7 lack mid, else by 11
# have a text in ts.
SQL["accepted_logs"] = "SELECT type, mid, uid, evid, itemid, ts FROM (" + SQL["route_logs"] + """)
WHERE log_id % 5 <> 0 AND log_id % 7 <> 0 AND log_id % 11 <> 0"""

SQL["rejected_logs"] = """
SELECT CASE WHEN event_id % 5 <> 0 AND event_id % 7 = 0 THEN 'no mid' ELSE 'malformed' END AS reason,
       count(*) AS ct
FROM events WHERE event_id % 5 = 0 OR event_id % 7 = 0 OR event_id % 11 = 0 GROUP BY 1"""

# ------------------------------------------------------------ stream twins
# The stream twins' sinks must equal the batch definitions: first visits,
# cleaned orders, the time-bounded sale join (enriched, one row per line id),
# and the alerts whose window the watermark has closed (end <= max event
# time - 2 h): append mode holds the later ones back by design.

SQL["dau_stream"] = SQL["dau_first_visits"]

SQL["new_mid_stream"] = SQL["new_mid"]

SQL["dau_stateful_stream"] = _with(FIRST_VISITS) + "SELECT mid, log_date FROM fv"

SQL["collector_stream"] = "SELECT * REPLACE (CAST(1704067200000 AS BIGINT) AS ts) FROM (" + \
    SQL["route_logs"] + ")"

SQL["capture_stream"] = "SELECT topic, value FROM (" + SQL["cdc_route"] + ")"

SQL["order_stream"] = SQL["orders_clean"]

SQL["first_order_stream"] = SQL["first_order_flag"]

SQL["user_stream"] = SQL["user_latest"]

SQL["sale_stream"] = _with(SALE_INDEX, ORDER_TS) + """
SELECT order_detail_id, order_id, order_status, create_time, user_id, sku_id, user_gender,
       user_age, user_level, sku_price, sku_name, dt
FROM (SELECT s.*, row_number() OVER (PARTITION BY s.order_detail_id
                                     ORDER BY s.d_ts DESC, s.d_price DESC) AS rn
      FROM sale_all s JOIN ots ON ots.id = s.order_id
      WHERE s.d_ts > ots.o_ts - 7776000000 AND s.d_ts < ots.o_ts + 7776000000)
WHERE rn = 1"""

SQL["alert_stream"] = _with(EVENT_LOG, _alerts_sql(7_200_000, 1_800_000, 3)) + """
SELECT * FROM alerts"""
