"""SQL that computes the registered queries' results from the raw tables, for DuckDB.

It knows nothing of log lines: where a query goes through raw text, parsing and the region
join, the SQL starts from the events the text was made of.
"""

from __future__ import annotations

ORACLE_SQL: dict[str, str] = {}

TRACKED = """
tracked AS (
  SELECT e.event_id, e.user_id, CAST(e.user_id AS VARCHAR) AS uid, CAST(e.ts AS DATE) AS dt,
    e.user_id || '-' || CAST(CAST(e.ts AS DATE) AS VARCHAR) AS sid,
    epoch_us(date_trunc('day', e.ts)::TIMESTAMP) // 1000 + (epoch_us(e.ts) // 1000
      - epoch_us(date_trunc('day', e.ts)::TIMESTAMP) // 1000) // 25 AS ms,
    CASE e.event_type WHEN 'signup' THEN 'e_l' WHEN 'view' THEN 'e_pv' WHEN 'click' THEN 'e_bp'
      WHEN 'purchase' THEN 'e_ba' ELSE 'e_s' END AS en,
    CASE e.user_id % 3 WHEN 0 THEN 'pc' WHEN 1 THEN 'ios' ELSE 'android' END AS pl,
    CASE WHEN e.event_type = 'click' THEN regexp_extract(e.props, '[0-9]+') END AS pid,
    CASE WHEN e.event_id % 50 = 0 THEN 3232235520 + e.event_id % 256
      ELSE 16777216 + c.c_nationkey * 65536 + (e.user_id % 4) * 16384 + e.event_id % 16384
      END AS number,
    e.event_id % 50 <> 0 AND NOT (c.c_nationkey = 24 AND e.user_id % 4 = 3) AS located,
    r.r_name, n.n_name, 'CITY_' || c.c_nationkey || '_' || (e.user_id % 4) AS c_name
  FROM events e
  JOIN customer c ON c.c_custkey = e.user_id
  JOIN nation n ON n.n_nationkey = c.c_nationkey
  JOIN region r ON r.r_regionkey = n.n_regionkey
)"""

# Events whose line is a record.
LOG = (
    TRACKED
    + """,
log AS (
  SELECT *, CASE WHEN located THEN r_name ELSE 'unknown' END AS country,
    CASE WHEN located THEN n_name ELSE 'unknown' END AS province,
    CASE WHEN located THEN c_name ELSE 'unknown' END AS city
  FROM tracked WHERE event_id % 97 <> 0
)"""
)

REQUEST = """'/log.gif?en=' || en || '&uid=' || uid || '&sid=' || sid || '&pl=' || pl
  || CASE WHEN pid IS NULL THEN '' ELSE '&pid=' || pid END"""
ADDRESS = """(number // 16777216) || '.' || (number // 65536 % 256) || '.'
  || (number // 256 % 256) || '.' || (number % 256)"""
LINE = f"""{ADDRESS} || '|' || ms || '|'
  || CASE WHEN event_id % 97 <> 0 THEN 'www.example.com|' ELSE '' END || {REQUEST}"""

FAULT = """CASE WHEN event_id % 97 = 0 THEN 'no four fields' WHEN event_id % 101 = 0 THEN 'no uid'
  WHEN event_id % 103 = 0 THEN 'no event'
  WHEN event_id % 89 = 0 OR event_id % 83 = 0 THEN 'bad time' END"""

PLATFORMS = "(SELECT pl AS platform, * FROM log UNION ALL SELECT 'all' AS platform, * FROM log)"
LEVELS = """(
  SELECT country AS l1, 'all' AS l2, 'all' AS l3, * FROM {0}
  UNION ALL SELECT country, province, 'all', * FROM {0}
  UNION ALL SELECT country, province, city, * FROM {0})"""
FLOW = f"""
  SELECT dt, l1 AS country, l2 AS province, l3 AS city,
    CAST(sum(launches) AS BIGINT) AS nu, max(uv) AS uv, CAST(sum(views) AS BIGINT) AS pv,
    count(*) AS sn, count(*) FILTER (WHERE n = 1) AS "on"
  FROM (
    SELECT dt, l1, l2, l3, sid, count(*) AS n, count(*) FILTER (WHERE en = 'e_l') AS launches,
      count(*) FILTER (WHERE en IN ('e_pv', 'e_bp')) AS views
    FROM {LEVELS.format('log')} GROUP BY ALL)
  JOIN (SELECT dt, l1, l2, l3, count(DISTINCT uid) AS uv
        FROM {LEVELS.format('log')} GROUP BY ALL) USING (dt, l1, l2, l3)
  GROUP BY ALL"""
DEVICES = f"""
  SELECT s.dt, s.platform, s.l1 AS country, s.l2 AS province, s.l3 AS city,
    max(u.users) AS active_users, count(*) AS sessions,
    count(*) FILTER (WHERE s.n = 1) AS bounce_sessions
  FROM (SELECT dt, platform, l1, l2, l3, sid, count(*) AS n
        FROM {LEVELS.format(PLATFORMS)} GROUP BY ALL) s
  JOIN (SELECT dt, platform, l1, l2, l3, count(DISTINCT uid) AS users
        FROM {LEVELS.format(PLATFORMS)} GROUP BY ALL) u USING (dt, platform, l1, l2, l3)
  GROUP BY ALL"""
USERS = f"""
  SELECT dt, platform, count(DISTINCT uid) AS active_users,
    count(*) FILTER (WHERE en = 'e_l') AS new_install_users,
    count(DISTINCT sid) AS session_count,
    count(*) FILTER (WHERE en IN ('e_pv', 'e_bp')) // count(DISTINCT sid) AS session_length
  FROM {PLATFORMS} GROUP BY ALL"""
EVENTS = f"""
  SELECT dt, platform, event_name, count(*) AS times
  FROM (SELECT dt, platform, en AS event_name FROM {PLATFORMS}
        UNION ALL SELECT dt, platform, 'all' FROM {PLATFORMS})
  GROUP BY ALL"""
METRICS = f"""
  SELECT dt, platform, sid, (max(ms) - min(ms)) // 1000 AS visit_seconds,
    count(*) FILTER (WHERE en IN ('e_pv', 'e_bp')) AS visit_steps
  FROM {PLATFORMS} GROUP BY ALL"""

# Written out from the description of the report: "over 4 seconds", not "from 4 seconds".
TIMES = {
    "1s_3s": "s >= 0 AND s <= 3",
    "4s_6s": "s > 4 AND s <= 6",
    "7s_9s": "s >= 7 AND s <= 9",
    "10s_30s": "s >= 10 AND s <= 30",
    "30s_60s": "s > 30 AND s <= 60",
    "1m_3m": "s > 60 AND s <= 180",
    "3m_10m": "s > 180 AND s <= 600",
    "10m_30m": "s > 600 AND s <= 1800",
    "30m": "s > 1800",
}
STEPS = {
    "1_3": "k >= 1 AND k <= 3",
    "4_6": "k >= 4 AND k <= 6",
    "7_9": "k >= 7 AND k <= 9",
    "10_30": "k >= 10 AND k <= 30",
    "30_60": "k > 30 AND k <= 60",
    "60": "k > 60",
}
BUCKETS = {
    **{"time_" + name: test for name, test in TIMES.items()},
    **{"step_" + name: test for name, test in STEPS.items()},
}
COUNTS = f"""
  SELECT dt, platform, count(*) AS session_count,
    {", ".join(f'count(*) FILTER (WHERE {t}) AS "{n}"' for n, t in BUCKETS.items())}
  FROM (SELECT dt, platform, visit_seconds AS s, visit_steps AS k FROM ({METRICS}))
  GROUP BY ALL"""


def share(count: str, total: str) -> str:
    """Two decimals, half up, read off the exact decimal expansion of the double."""
    digits = f"format('{{:.64f}}', {count}::DOUBLE / {total}::DOUBLE)"
    return f"""(CAST(replace(substr({digits}, 1, 4), '.', '') AS INTEGER)
      + CASE WHEN substr({digits}, 5, 1) >= '5' THEN 1 ELSE 0 END) / 100.0::DOUBLE"""


SHARES = f"""
  SELECT dt, platform, session_count,
    {", ".join(f'{share(chr(34) + n + chr(34), "session_count")} AS "{n}"' for n in BUCKETS)}
  FROM ({COUNTS})"""
SUMMARY_TEXT = " || '|' || ".join(
    ["'session_count=' || session_count"]
    + [f"""'{n.split("_", 1)[1]}=' || "{n}" """ for n in BUCKETS]
)
PRODUCTS = """
  SELECT dt AS date, country, province, city, pid AS product_id, count(*) AS browser_count
  FROM log WHERE en = 'e_bp' AND regexp_matches(pid, '\\S') GROUP BY ALL"""
ROLLUP = f"""
  SELECT date, country, province, product_id,
    CAST(sum(browser_count) AS BIGINT) AS browser_count,
    string_agg(city, ',' ORDER BY city) AS city_infos
  FROM ({PRODUCTS}) GROUP BY ALL"""
TOP = f"""
  SELECT date, country, province, CAST(product_id AS BIGINT) AS product_id,
    browser_count AS browser_product_count, city_infos, CAST(rank AS INTEGER) AS rank
  FROM (SELECT *, row_number() OVER (PARTITION BY date, country, province
          ORDER BY browser_count DESC, CAST(product_id AS BIGINT)) AS rank FROM ({ROLLUP}))
  WHERE rank <= 3"""


def week(day: str) -> str:
    """Weeks from Sunday; the week of 1 January is week 1 of the new year."""
    sunday = f"({day} - CAST(dayofweek({day}) AS INTEGER))"
    first = f"make_date(year({day}), 1, 1)"
    start = f"({first} - CAST(dayofweek({first}) AS INTEGER))"
    return f"""CAST(CASE WHEN year({sunday} + 6) > year({day}) THEN 1
      ELSE ({sunday} - {start}) // 7 + 1 END AS INTEGER)"""


def units(day: str) -> str:
    return f"""CAST(year({day}) AS INTEGER) AS year, CAST(quarter({day}) AS INTEGER) AS season,
      CAST(month({day}) AS INTEGER) AS month, {week(day)} AS week,
      CAST(day({day}) AS INTEGER) AS day"""


def date_id(days: str) -> str:
    """Ids of days in the order of the dimension's keys; week and day of month come first."""
    return f"""(SELECT dt AS d, row_number() OVER (ORDER BY year, season, month, week, day) AS
      date_dimension_id FROM (SELECT dt, {units('dt')} FROM (SELECT DISTINCT dt FROM {days})))"""


def sql(name: str, text: str, ctes: str | None = LOG) -> None:
    ORACLE_SQL[name] = (f"WITH {ctes}\n" if ctes else "") + text


EVENT_DESCRIPTION = """CASE en WHEN 'e_l' THEN '全站新用户访问' WHEN 'e_pv' THEN 'web浏览页面'
  WHEN 'e_bp' THEN '浏览商品详情页' WHEN 'e_ba' THEN '加入购物车' WHEN 'all' THEN '所有事件' END"""
EVENT_CATEGORY = """CASE WHEN en IN ('e_l', 'e_pv') THEN '全站产品体验行为'
  WHEN en IN ('e_bp', 'e_ba') THEN '全站购买行为' WHEN en = 'all' THEN '所有行为' END"""

sql(
    "ip_rules",
    """
SELECT CAST(16777216 + n_nationkey * 65536 + part * 16384 AS BIGINT) AS start_num,
  CAST(16777216 + n_nationkey * 65536 + part * 16384 + 16383 AS BIGINT) AS end_num,
  r_name AS country, n_name AS province, 'CITY_' || n_nationkey || '_' || part AS city
FROM nation JOIN region ON n_regionkey = r_regionkey, range(4) AS p(part)
WHERE NOT (n_nationkey = 24 AND part = 3)""",
    None,
)
sql(
    "raw_log_day",
    f"""
SELECT CAST(CASE WHEN event_id % 97 <> 0 THEN 4 ELSE 3 END AS INTEGER) AS n_fields,
  count(*) AS n, CAST(sum(length({LINE})) AS BIGINT) AS n_chars
FROM tracked GROUP BY 1""",
    TRACKED,
)
RECORD = """uid, sid, CAST(ms AS VARCHAR) AS access_time, en, country, province, city, pl,
  CAST(NULL AS VARCHAR) AS b_n, pid, CAST(NULL AS VARCHAR) AS os_n"""
sql("event_log_scan", f"SELECT {RECORD}, ms AS access_time_ms, dt FROM log")
sql("event_log_projection", f"SELECT {RECORD} FROM log")
sql("stream_enriched", f"SELECT {RECORD} FROM log")
sql(
    "parsed_lines",
    f"SELECT {ADDRESS} AS ip, CAST(ms AS VARCHAR) AS access_time, {REQUEST} AS request FROM log",
)
sql(
    "log_params",
    """
SELECT CAST(ms AS VARCHAR) AS access_time, name, value
FROM log, LATERAL (VALUES ('en', en), ('uid', uid), ('sid', sid), ('pl', pl), ('pid', pid))
  AS p(name, value) WHERE value IS NOT NULL""",
)
sql(
    "page_url_params",
    """
SELECT page_id, last(name ORDER BY place) AS name, last(value ORDER BY place) AS value
FROM (
  SELECT page_id, place, url_decode(replace(kv[1], '+', ' ')) AS name,
    url_decode(replace(kv[2], '+', ' ')) AS value
  FROM (
    SELECT page_id, generate_subscripts(items, 1) AS place,
      string_split(rtrim(unnest(items), '='), '=') AS kv
    FROM (SELECT page_id, string_split(parts[2], '&') AS items
          FROM (SELECT page_id, string_split(rtrim(url, '?'), '?') AS parts FROM pages)
          WHERE len(parts) = 2))
  WHERE len(kv) = 2 AND regexp_matches(kv[1], '\\S') AND regexp_matches(kv[2], '\\S'))
GROUP BY page_id, name""",
    None,
)
sql(
    "param_overrides",
    """
SELECT en, pl, country, province, CASE WHEN en = 'e_s' THEN 'Town & ' || pl ELSE city END AS city,
  en = 'e_s' AND pl = 'ios' AS own, count(*) AS n
FROM log GROUP BY ALL""",
)
sql(
    "parse_counts",
    f"""
SELECT count(*) AS n_input, count(*) FILTER (WHERE {FAULT} = 'no four fields') AS n_filtered,
  count(*) FILTER (WHERE {FAULT} <> 'no four fields') AS n_incomplete FROM events""",
    None,
)
sql(
    "rejected_lines",
    f"""
SELECT {FAULT} AS reason, count(*) AS n, CAST(sum(length(
    {ADDRESS} || '|' || CASE WHEN event_id % 89 = 0 THEN '{"9" * 17}'
      WHEN event_id % 83 = 0 THEN 'soon' ELSE CAST(ms AS VARCHAR) END || '|'
    || CASE WHEN event_id % 97 <> 0 THEN 'www.example.com|' ELSE '' END || '/log.gif?'
    || concat_ws('&', CASE WHEN event_id % 103 <> 0 THEN 'en=' || en END,
         CASE WHEN event_id % 101 <> 0 THEN 'uid=' || uid END, 'sid=' || sid, 'pl=' || pl,
         'pid=' || pid))) AS BIGINT) AS n_chars
FROM tracked WHERE {FAULT} IS NOT NULL GROUP BY 1""",
    TRACKED,
)
sql(
    "product_views",
    """
SELECT uid, sid, CAST(ms AS VARCHAR) AS access_time, pid, country, province, city
FROM log WHERE en = 'e_bp' AND regexp_matches(pid, '\\S')""",
)
sql(
    "valid_dates",
    """
SELECT o_orderkey, text,
  try_cast(text AS DATE) IS NOT NULL AND substr(text, 1, 4) <> '0000' AS valid
FROM (SELECT o_orderkey, lpad(CAST(o_orderkey % 2100 AS VARCHAR), 4, '0') || '-'
        || lpad(CAST(o_custkey % 14 AS VARCHAR), 2, '0') || '-'
        || lpad(CAST(o_orderkey % 33 AS VARCHAR), 2, '0') AS text FROM orders)""",
    None,
)
sql(
    "location_level_counts",
    f"""
SELECT dt, platform, l1 AS country, l2 AS province, l3 AS city, count(*) AS n
FROM {LEVELS.format(PLATFORMS)} GROUP BY ALL""",
)
sql(
    "ip_regions",
    f"""
SELECT event_id, {ADDRESS} AS ip, coalesce(country, 'unknown') AS country,
  coalesce(province, 'unknown') AS province, coalesce(city, 'unknown') AS city
FROM tracked LEFT JOIN ({ORACLE_SQL['ip_rules']}) ON number BETWEEN start_num AND end_num""",
    TRACKED,
)
sql(
    "ip_regions_sweep",
    f"""
, moved AS (
  SELECT event_id, CASE WHEN event_id % 3 = 0 THEN '1.4.0.9' ELSE {ADDRESS} END AS ip,
    CASE WHEN event_id % 3 = 0 THEN 17039369 ELSE number END AS number
  FROM tracked)
SELECT event_id, ip, coalesce(country, 'unknown') AS country,
  coalesce(province, 'unknown') AS province, coalesce(city, 'unknown') AS city
FROM moved LEFT JOIN ({ORACLE_SQL['ip_rules']}) ON number BETWEEN start_num AND end_num""",
    TRACKED,
)
sql(
    "location_dimension",
    f"""
, old AS (
  SELECT r_name AS country, n_name AS province, 'all' AS city
  FROM nation JOIN region ON n_regionkey = r_regionkey),
new AS (SELECT country, province, city FROM ({FLOW}) EXCEPT SELECT * FROM old)
SELECT row_number() OVER (ORDER BY country, province, city) AS id, * FROM old
UNION ALL
SELECT (SELECT count(*) FROM old) + row_number() OVER (ORDER BY country, province, city), *
FROM new""",
)
sql(
    "date_dimension",
    f"""
SELECT row_number() OVER (ORDER BY year, season, month, week, day, calendar, type) AS id, *
FROM (SELECT DISTINCT {units('d')}, strftime(d, '%Y-%m-%d') AS calendar, 'day' AS type
      FROM (SELECT CAST(o_orderdate AS DATE) AS d FROM orders))""",
    None,
)
sql(
    "platform_dimension",
    """
SELECT row_number() OVER (ORDER BY platform_name) AS id, platform_name
FROM (SELECT DISTINCT pl AS platform_name FROM log UNION SELECT 'all')""",
)
sql(
    "event_dimension",
    f"""
SELECT row_number() OVER (ORDER BY en) AS id, en AS event_name,
  {EVENT_DESCRIPTION} AS event_description, {EVENT_CATEGORY} AS category
FROM (SELECT DISTINCT en FROM log UNION SELECT 'all')""",
)
sql("session_metrics", METRICS)
sql("session_shares", SHARES)
sql("session_summaries", f"SELECT dt, platform, {SUMMARY_TEXT} AS summary FROM ({COUNTS})")
sql("user_stats", USERS)
sql("device_location_stats", DEVICES)
sql("event_stats", EVENTS)
sql(
    "user_stats_by_month",
    USERS.replace("SELECT dt, platform", "SELECT CAST(date_trunc('month', dt) AS DATE) AS first_day, platform"),
)
sql(
    "location_flow_by_week",
    f"""
SELECT first_day, l1 AS country, l2 AS province, l3 AS city,
  count(*) FILTER (WHERE en = 'e_l') AS nu, count(DISTINCT uid) AS uv,
  count(*) FILTER (WHERE en IN ('e_pv', 'e_bp')) AS pv, count(DISTINCT sid) AS sn
FROM (SELECT *, dt - CAST(extract('dow' FROM dt) AS INTEGER) AS first_day
      FROM {LEVELS.format('log')})
GROUP BY ALL""",
)
for name in (
    "location_flow", "stream_flow", "stream_flow_restarted", "stream_flow_restated", "upserted_flow"
):
    sql(name, FLOW)
sql("area_product_counts", PRODUCTS)
for name in ("area_product_rollup", "product_views_by_sql"):
    sql(name, ROLLUP)
sql("area_top_products", TOP)
WORDS = """
SELECT word, count(*) AS n
FROM (SELECT unnest(string_split(rtrim(text, ' '), ' ')) AS word FROM ({0})
      WHERE NOT (rtrim(text, ' ') = '' AND text <> ''))
GROUP BY word"""
DOCUMENT_LINES = "SELECT regexp_replace(text, '[\\r\\n]+', ' ', 'g') AS text FROM documents"
sql("word_count", WORDS.format("SELECT text FROM documents"), None)
sql(
    "union_word_count",
    WORDS.format(
        "SELECT text FROM documents UNION ALL SELECT text FROM conversations "
        "UNION ALL SELECT text FROM benchmark"
    ),
    None,
)
for name in ("stream_batch_words", "stream_running_words"):
    sql(name, WORDS.format(DOCUMENT_LINES), None)

PLATFORM_IDS = f"""(SELECT platform, row_number() OVER (ORDER BY platform) AS
  platform_dimension_id FROM (SELECT DISTINCT platform FROM {PLATFORMS}))"""


def location_ids(report: str) -> str:
    return f"""(SELECT *, row_number() OVER (ORDER BY country, province, city) AS
      location_dimension_id FROM (SELECT DISTINCT country, province, city FROM ({report})))"""


CREATED = "strftime(dt, '%Y-%m-%d') AS created, dt"
DATED = f"JOIN {date_id('log')} ON d = dt"
sql(
    "session_aggr_stat",
    f"""
SELECT date_dimension_id, platform_dimension_id, session_count,
  {", ".join(f'"{n}"' for n in BUCKETS)}, {CREATED}
FROM ({SHARES}) {DATED} JOIN {PLATFORM_IDS} USING (platform)""",
)
sql(
    "stats_user",
    f"""
SELECT date_dimension_id, platform_dimension_id, active_users, new_install_users,
  session_count, session_length, {CREATED}
FROM ({USERS}) {DATED} JOIN {PLATFORM_IDS} USING (platform)""",
)
sql(
    "stats_device_location",
    f"""
SELECT date_dimension_id, platform_dimension_id, location_dimension_id, active_users,
  sessions, bounce_sessions, {CREATED}
FROM ({DEVICES}) {DATED} JOIN {PLATFORM_IDS} USING (platform)
JOIN {location_ids(DEVICES)} USING (country, province, city)""",
)
sql(
    "stats_event",
    f"""
SELECT date_dimension_id, platform_dimension_id, event_dimension_id, times, {CREATED}
FROM ({EVENTS}) {DATED} JOIN {PLATFORM_IDS} USING (platform)
JOIN (SELECT event_name, row_number() OVER (ORDER BY event_name) AS event_dimension_id
      FROM (SELECT DISTINCT event_name FROM ({EVENTS}))) USING (event_name)""",
)
sql(
    "area_top3_product",
    f"""
SELECT date_dimension_id, location_dimension_id, product_id, browser_product_count,
  city_infos, {CREATED}
FROM (SELECT *, date AS dt, 'all' AS city FROM ({TOP}))
JOIN {date_id(f"(SELECT date AS dt FROM ({TOP}))")} ON d = dt
JOIN {location_ids(f"SELECT country, province, 'all' AS city FROM ({TOP})")}
  USING (country, province, city)""",
)
sql(
    "stats_location_flow",
    f"""
SELECT date_dimension_id, location_dimension_id, nu, uv, pv, sn, "on", {CREATED}
FROM ({FLOW}) {DATED} JOIN {location_ids(FLOW)} USING (country, province, city)""",
)
sql("ip_numbers", "SELECT event_id, CAST(number AS BIGINT) AS number FROM tracked", TRACKED)
sql(
    "date_functions",
    """
SELECT o_orderkey, epoch_ms(d::TIMESTAMP) AS ms, strftime(d, '%Y/%m/%d') AS path,
  epoch_ms((d + 1)::TIMESTAMP) AS next_ms
FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders)""",
    None,
)
sql(
    "date_units",
    f"""
SELECT o_orderkey, {units('d')}
FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders)""",
    None,
)
sql(
    "summary_fields",
    f"""
SELECT dt, platform, CAST(session_count AS VARCHAR) AS session_count,
  CAST(time_30m AS VARCHAR) AS over_30m, CAST(NULL AS VARCHAR) AS none,
  replace({SUMMARY_TEXT}, '|1s_3s=' || time_1s_3s || '|', '|1s_3s=x|') AS edited,
  {SUMMARY_TEXT} AS unchanged
FROM ({COUNTS})""",
)
sql(
    "share_rounding",
    f"""
SELECT l_suppkey, part, whole, {share('part', 'whole')} AS share
FROM (
  SELECT l_suppkey, count(*) FILTER (WHERE l_returnflag = 'R') AS part, count(*) AS whole
  FROM lineitem GROUP BY l_suppkey
  UNION ALL
  SELECT min(l_suppkey), l_partkey % 201, CAST(200 AS BIGINT) FROM lineitem
  GROUP BY l_partkey % 201)""",
    None,
)


def java_hash(text: str) -> str:
    """Polynomial over UTF-16 units; characters past 16 bits count as two."""
    return f"""(list_reduce(list_concat([0::BIGINT], flatten(list_transform(
      string_split({text}, ''), lambda c: CASE
        WHEN c = '' THEN []
        WHEN unicode(c) > 65535 THEN [CAST(55296 + (unicode(c) - 65536) // 1024 AS BIGINT),
          CAST(56320 + (unicode(c) - 65536) % 1024 AS BIGINT)]
        ELSE [CAST(unicode(c) AS BIGINT)] END))),
      lambda a, x: (a * 31 + x) % 4294967296))"""


ROW_KEY = f"""(ms || '_' || CASE WHEN h >= 2147483648 THEN
  CASE WHEN h = 2147483648 THEN -h ELSE 4294967296 - h END ELSE h END)"""
sql(
    "row_keys",
    f"""
SELECT event_id, {ROW_KEY} AS row_key
FROM (SELECT event_id, ms, {java_hash("(uid || en)")} AS h FROM tracked)""",
    TRACKED,
)
sql(
    "text_hashes",
    f"""
SELECT conv_id, turn,
  CAST(CASE WHEN h >= 2147483648 THEN h - 4294967296 ELSE h END AS INTEGER) AS code
FROM (SELECT conv_id, turn, {java_hash("text")} AS h FROM conversations)""",
    None,
)
sql(
    "url_codec",
    """
SELECT doc_id, md5(replace(replace(replace(replace(replace(url_encode(text), '%21', '!'),
  '%27', ''''), '%28', '('), '%29', ')'), '%2A', '*')) AS encoded, true AS same
FROM documents""",
    None,
)
sql(
    "blank_parts",
    """
SELECT lang, regexp_matches(part, '\\S') AS not_blank, count(*) AS n
FROM (SELECT lang, unnest(string_split(text, ' ')) AS part FROM documents) GROUP BY ALL""",
    None,
)
sql(
    "user_agent_platforms",
    """
SELECT event_id, CASE WHEN event_id % 5 IN (0, 3) THEN 'android'
  WHEN event_id % 5 = 1 THEN 'ios' ELSE 'pc' END AS platform FROM events""",
    None,
)
sql(
    "query_strings",
    """
SELECT event_id, 'en=' || en || '&uid=' || uid || '&sid=' || sid || '&pl=' || pl
  || CASE WHEN pid IS NULL THEN '' ELSE '&pid=' || pid END
  || '&tt=it''s%20(a)%20day~%20' || CAST(dt AS VARCHAR) AS text
FROM tracked""",
    TRACKED,
)
SESSIONS = """
  SELECT event_id, uid, ms AS access_time_ms,
    CAST(sum(starts) OVER (PARTITION BY uid ORDER BY ms) AS BIGINT) AS session_no
  FROM (SELECT *, CASE WHEN ms - lag(ms) OVER (PARTITION BY uid ORDER BY ms) <= 120000
          THEN 0 ELSE 1 END AS starts FROM tracked)"""
sql("sessionized_events", SESSIONS, TRACKED)
SPANS = """
SELECT {0}uid, min(access_time_ms) AS start_ms, max(access_time_ms) AS end_ms,
  count(*) AS n_events
FROM ({1}) GROUP BY uid, session_no"""
sql("session_spans", SPANS.format("session_no, ", SESSIONS), TRACKED)
sql("stream_session_spans", SPANS.format("", SESSIONS), TRACKED)
sql(
    "first_visits",
    """
SELECT event_id, uid, ms AS access_time_ms,
  row_number() OVER (PARTITION BY uid ORDER BY ms, event_id) = 1 AS is_first
FROM tracked""",
    TRACKED,
)
sql("stream_sessionized_events", SESSIONS, TRACKED)
sql("stream_ended_sessions", SPANS.format("session_no, ", SESSIONS), TRACKED)
sql(
    "stream_first_visits",
    """
SELECT event_id, uid, ms AS access_time_ms FROM tracked
QUALIFY row_number() OVER (PARTITION BY uid ORDER BY ms, event_id) = 1""",
    TRACKED,
)
sql(
    "event_log_upsert",
    f"""
SELECT {ROW_KEY} AS row_key, last(uid ORDER BY event_id) AS uid,
  last(sid ORDER BY event_id) AS sid, CAST(ms AS VARCHAR) AS access_time,
  last(en ORDER BY event_id) AS en, last(country ORDER BY event_id) AS country,
  last(province ORDER BY event_id) AS province, last(city ORDER BY event_id) AS city,
  last(pl ORDER BY event_id) AS pl,
  CASE WHEN bool_or(event_id % 100 = 1) THEN 'chrome' END AS b_n,
  last(pid ORDER BY event_id) FILTER (WHERE pid IS NOT NULL) AS pid,
  CAST(NULL AS VARCHAR) AS os_n, any_value(dt) AS dt
FROM (SELECT *, {java_hash("(uid || en)")} AS h FROM log) GROUP BY ms, h""",
)
sql(
    "replaced_day",
    f"""
SELECT dt, platform, event_name, CASE WHEN dt = DATE '2024-01-15' THEN -times ELSE times END
  AS times FROM ({EVENTS})""",
)
for name in ("landed_lines", "stream_growing_lines"):
    sql(name, f"SELECT {LINE} AS value, count(*) AS n FROM tracked GROUP BY 1", TRACKED)
ORACLE_SQL["stream_rejected_lines"] = ORACLE_SQL["rejected_lines"]
VISITORS = TRACKED.replace(
    "CAST(e.user_id AS VARCHAR) AS uid",
    "CASE WHEN e.event_id % 3 <> 0 THEN CAST(e.user_id AS VARCHAR) END AS uid",
)
sql(
    "sessionized_visitors",
    f"""
SELECT event_id, uid, access_time_ms, CASE WHEN uid IS NOT NULL THEN session_no END AS session_no
FROM ({SESSIONS})""",
    VISITORS,
)
sql(
    "loaded_files",
    """
SELECT load, uid, access_time, en, 'late-' || load AS b_n
FROM (SELECT DISTINCT uid, CAST(ms AS VARCHAR) AS access_time, en FROM log),
  (VALUES (1), (2)) AS l(load)""",
)
sql(
    "stream_flow_report",
    f"""
SELECT CAST(dt AS VARCHAR) AS calendar, 'day' AS type, country, province, city, nu, uv, pv, sn,
  "on", CAST(dt AS VARCHAR) AS created, dt FROM ({FLOW})""",
)
