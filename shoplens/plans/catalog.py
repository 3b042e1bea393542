"""Named queries: (spark, sf_dir) -> DataFrame, and their DuckDB oracles.

Every query reads the driver's tables (through :class:`RetailTables`) in
full; parameters such as dates are fixed so results can be compared.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplens import schemas
from shoplens.functions import columns as C
from shoplens.operators import alerts, clean, dedup, ingest, metrics, sale_detail, search
from shoplens.operators.keyed import latest_per_key
from shoplens.operators.keyword import KeywordIndex
from shoplens.plans.oracle_views import ORDER_COLUMNS_SQL, with_views
from shoplens.plans.tables import RetailTables
from shoplens.session import work_path
from shoplens.sources import changefeed, fixtures
from shoplens.sources.topics import TOPIC_FILE_SCHEMA, append_topic_files, read_keyed_files, read_topic_files, unique_messages, write_topic_files
from shoplens.streaming import jobs
from shoplens.streaming.replay import AT_ONCE, replay
from shoplens.streaming.sinks import AppendTable, LogTable

# Fixed query parameters (chosen dates present in the fixtures).
DAU_DAY = "2024-01-15"
GMV_DAY = "1996-09-17"

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn: Callable[[RetailTables], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: fn(RetailTables(spark, sf_dir))
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


# --- daily active devices -------------------------------------------------

@register("dau_first_seen", with_views("SELECT * FROM dau", "dau"))
def dau_first_seen(t: RetailTables) -> DataFrame:
    return t.dau


@register("dau_total", with_views(
    f"SELECT count(*) AS dau FROM dau WHERE log_date = '{DAU_DAY}'", "dau"))
def dau_total(t: RetailTables) -> DataFrame:
    return metrics.dau_total(t.dau_of(DAU_DAY), DAU_DAY)


@register("dau_hours", with_views(
    f"SELECT log_hour, count(*) AS dau FROM dau WHERE log_date = '{DAU_DAY}' GROUP BY log_hour", "dau"))
def dau_hours(t: RetailTables) -> DataFrame:
    return metrics.dau_hours(t.dau_of(DAU_DAY), DAU_DAY)


_HOUR_TABLE_SQL = """
SELECT h.hour AS hour, coalesce(y.value, 0.0) AS yesterday, coalesce(d.value, 0.0) AS today
FROM (SELECT lpad(CAST(range AS VARCHAR), 2, '0') AS hour FROM range(24)) h
LEFT JOIN series y ON y.hour = h.hour AND y.day = 'yesterday'
LEFT JOIN series d ON d.hour = h.hour AND d.day = 'today'
"""


def _series_sql(date_col: str, hour_col: str, value: str, table: str, day: str) -> str:
    return f"""
      SELECT CASE WHEN {date_col} = '{day}' THEN 'today' ELSE 'yesterday' END AS day,
             {hour_col} AS hour, {value} AS value
      FROM {table} WHERE {date_col} IN ('{day}', '{metrics.yesterday_of(day)}') GROUP BY 1, 2"""


@register("realtime_hours_dau", with_views(
    _HOUR_TABLE_SQL, "dau",
    extra={"series": _series_sql("log_date", "log_hour", "CAST(count(*) AS DOUBLE)", "dau", DAU_DAY)}))
def realtime_hours_dau(t: RetailTables) -> DataFrame:
    return metrics.hour_table(metrics.realtime_hours(metrics.CARD_DAU, t.dau_of(DAU_DAY, metrics.yesterday_of(DAU_DAY)), t.bare_orders, DAU_DAY))


@register("dau_incremental", with_views("""
    SELECT b.mid, b.uid, b.appid, b.area, b.os, b.ch, b.type, b.vs, b.log_date, b.log_hour, b.ts FROM (
      SELECT *, row_number() OVER (PARTITION BY log_date, mid ORDER BY ts, uid, appid, area, os, ch, type, vs, log_hour) AS rn
      FROM startup_log WHERE log_hour >= '12') b
    WHERE b.rn = 1 AND NOT EXISTS (
      SELECT 1 FROM startup_log a WHERE a.log_hour < '12' AND a.log_date = b.log_date AND a.mid = b.mid)
    """, "startup_log"))
def dau_incremental(t: RetailTables) -> DataFrame:
    """Second micro-batch of each day (afternoon) against the devices the
    first batch (morning) already counted: only unseen devices come out."""
    morning = t.startup_logs.where(F.col("log_hour") < "12")
    afternoon = t.startup_logs.where(F.col("log_hour") >= "12")
    seen = dedup.seen_devices(dedup.first_visit_per_day(morning))
    return dedup.dau_increment(afternoon, seen)


@register("new_devices", with_views("""
    SELECT first_date AS log_date, count(*) AS new_mid
    FROM (SELECT mid, min(log_date) AS first_date FROM dau GROUP BY mid) GROUP BY first_date
    """, "dau"))
def new_devices(t: RetailTables) -> DataFrame:
    return dedup.new_devices(t.dau)


@register("batch_counts", with_views(
    "SELECT log_date, count(*) AS n_rows FROM startup_log GROUP BY log_date", "startup_log"))
def batch_counts(t: RetailTables) -> DataFrame:
    """Rows passed per day-batch of startup logs (the per-batch console count)."""
    return t.startup_logs.groupBy("log_date").agg(F.count(F.lit(1)).alias("n_rows"))


# --- orders and revenue ---------------------------------------------------

@register("order_clean", with_views(f"SELECT {ORDER_COLUMNS_SQL} FROM order_info", "order_info"))
def order_clean(t: RetailTables) -> DataFrame:
    return t.orders.select(*schemas.ORDER_INFO_COLUMNS)


@register("gmv_total", with_views(
    f"SELECT CAST(sum(CAST(total_amount AS DECIMAL(28,4))) AS DOUBLE) AS order_amount "
    f"FROM order_info WHERE create_date = '{GMV_DAY}'", "order_info"))
def gmv_total(t: RetailTables) -> DataFrame:
    return metrics.gmv_total(t.orders_of(GMV_DAY), GMV_DAY)


@register("gmv_hours", with_views(
    f"SELECT create_hour, CAST(sum(CAST(total_amount AS DECIMAL(28,4))) AS DOUBLE) AS order_amount "
    f"FROM order_info WHERE create_date = '{GMV_DAY}' GROUP BY create_hour", "order_info"))
def gmv_hours(t: RetailTables) -> DataFrame:
    return metrics.gmv_hours(t.orders_of(GMV_DAY), GMV_DAY)


@register("realtime_total", with_views(f"""
    SELECT 'dau' AS id, 'daily active devices' AS name, CAST(count(*) AS DOUBLE) AS value
      FROM dau WHERE log_date = '{DAU_DAY}'
    UNION ALL
    SELECT 'new_mid', 'new devices', CAST(count(*) AS DOUBLE)
      FROM (SELECT mid FROM dau GROUP BY mid HAVING min(log_date) = '{DAU_DAY}')
    UNION ALL
    SELECT 'order_amount', 'order amount', CAST(sum(CAST(total_amount AS DECIMAL(28,4))) AS DOUBLE)
      FROM order_info WHERE create_date = '{DAU_DAY}'
    """, "dau", "order_info"))
def realtime_total(t: RetailTables) -> DataFrame:
    return metrics.realtime_total(t.dau, t.orders_of(DAU_DAY), DAU_DAY)


@register("realtime_total_gmv_day", with_views(f"""
    SELECT 'dau' AS id, 'daily active devices' AS name, CAST(count(*) AS DOUBLE) AS value
      FROM dau WHERE log_date = '{GMV_DAY}'
    UNION ALL
    SELECT 'new_mid', 'new devices', CAST(count(*) AS DOUBLE)
      FROM (SELECT mid FROM dau GROUP BY mid HAVING min(log_date) = '{GMV_DAY}')
    UNION ALL
    SELECT 'order_amount', 'order amount', CAST(sum(CAST(total_amount AS DECIMAL(28,4))) AS DOUBLE)
      FROM order_info WHERE create_date = '{GMV_DAY}'
    """, "dau", "order_info"))
def realtime_total_gmv_day(t: RetailTables) -> DataFrame:
    """Cards on a day with orders but no device logs (DAU 0, revenue set)."""
    return metrics.realtime_total(t.dau, t.orders_of(GMV_DAY), GMV_DAY)


@register("realtime_hours_gmv", with_views(
    _HOUR_TABLE_SQL, "order_info",
    extra={"series": _series_sql("create_date", "create_hour",
                                 "CAST(sum(CAST(total_amount AS DECIMAL(28,4))) AS DOUBLE)", "order_info", GMV_DAY)}))
def realtime_hours_gmv(t: RetailTables) -> DataFrame:
    return metrics.hour_table(metrics.realtime_hours(metrics.CARD_ORDER_AMOUNT, t.dau, t.orders_of(GMV_DAY, metrics.yesterday_of(GMV_DAY)), GMV_DAY))


@register("realtime_hours_series", with_views(
    "SELECT * FROM series", "dau",
    extra={"series": _series_sql("log_date", "log_hour", "CAST(count(*) AS DOUBLE)", "dau", DAU_DAY)}))
def realtime_hours_series(t: RetailTables) -> DataFrame:
    """The raw (day, hour, value) answer before zero-filling."""
    return metrics.realtime_hours(metrics.CARD_DAU, t.dau_of(DAU_DAY, metrics.yesterday_of(DAU_DAY)), t.bare_orders, DAU_DAY)


@register("hours_map", with_views("""
    SELECT day, CAST(to_json(map_from_entries(list(struct_pack(k := hour, v := value) ORDER BY hour)))
                     AS VARCHAR) AS hours
    FROM series GROUP BY day""", "dau",
    extra={"series": _series_sql("log_date", "log_hour", "CAST(count(*) AS DOUBLE)", "dau", DAU_DAY)}))
def hours_map(t: RetailTables) -> DataFrame:
    """(day, hours): the hour -> value map of today and yesterday, as JSON text."""
    m = metrics.hours_map(metrics.realtime_hours(metrics.CARD_DAU, t.dau_of(DAU_DAY, metrics.yesterday_of(DAU_DAY)), t.bare_orders, DAU_DAY))
    return m.select("day", F.to_json("hours").alias("hours"))


@register("day_over_day", with_views("""
    SELECT d.day AS day, d.value AS value, p.value AS prev_value,
           CASE WHEN p.value <> 0 THEN (d.value - p.value) / p.value * 100.0 END AS pct_change
    FROM daily d LEFT JOIN daily p ON CAST(p.day AS DATE) + 1 = CAST(d.day AS DATE)
    """, "order_info", extra={"daily": """
      SELECT create_date AS day, CAST(sum(CAST(total_amount AS DECIMAL(28,4))) AS DOUBLE) AS value
      FROM order_info GROUP BY create_date"""}))
def day_over_day(t: RetailTables) -> DataFrame:
    """Daily revenue with the previous day's value and the change in percent."""
    daily = metrics.daily_series(t.bare_orders, "create_date", metrics.money_sum("total_amount"))
    return metrics.day_over_day(daily)


@register("order_upsert", with_views(f"SELECT {ORDER_COLUMNS_SQL} FROM order_info", "order_info"))
def order_upsert(t: RetailTables) -> DataFrame:
    """Order topic delivered twice (a replay after restart): keyed upsert by
    id keeps one row per order, the one with the highest ``seq``."""
    rows = t.topic(schemas.ORDER_INFO_TOPIC)
    replayed = rows.unionByName(rows)
    parsed = clean.parse_orders(replayed)
    return latest_per_key(parsed.drop("ingest_ts"), ["id"], ["seq"]).select(*schemas.ORDER_INFO_COLUMNS)


# --- ingest and change feed ----------------------------------------------

_LOG_TOPIC_COUNTS_SQL = f"""
    SELECT '{schemas.STARTUP_TOPIC}' AS topic, count(*) AS n_rows FROM events WHERE event_type = 'signup'
    UNION ALL SELECT '{schemas.EVENT_TOPIC}', count(*) FROM events WHERE event_type <> 'signup'
    """


@register("log_route", _LOG_TOPIC_COUNTS_SQL)
def log_route(t: RetailTables) -> DataFrame:
    stamped = ingest.stamp_log(t.raw_log_lines, "stamp_ms")
    return ingest.route_logs(stamped).groupBy("topic").agg(F.count(F.lit(1)).alias("n_rows"))


@register("log_stamp_archive", with_views(
    "SELECT strftime(ts, '%Y-%m-%d') AS log_date, count(*) AS n_rows FROM events GROUP BY 1"))
def log_stamp_archive(t: RetailTables) -> DataFrame:
    """Stamp every posted line, append it to the day-rolled archive, read the
    archive back: rows per day folder."""
    path = work_path(t.spark, "log_archive")
    ingest.archive_logs(ingest.stamp_log(t.raw_log_lines, "stamp_ms"), path)
    return (t.spark.read.text(path).groupBy("log_date")
            .agg(F.count(F.lit(1)).alias("n_rows")).select(F.col("log_date").cast("string"), "n_rows"))


def _topic_lines(t: RetailTables, topic: str) -> DataFrame:
    lines = t.raw_log_lines
    if topic == schemas.STARTUP_TOPIC:  # the others need not be parsed
        lines = ingest.computed_once(lines.withColumnRenamed("value", "_text"), value=F.col("_text"))
        lines = lines.select("value", "stamp_ms").where(ingest.may_start())
    return ingest.route_logs(ingest.stamp_log(lines, "stamp_ms")).where(F.col("topic") == topic)


def _routed_lines(t: RetailTables, topic: str) -> DataFrame:
    return _topic_lines(t, topic).select("value")


@register("startup_parse", with_views(
    "SELECT mid, uid, appid, area, os, ch, type, vs, ts, log_date, log_hour FROM startup_log", "startup_log"))
def startup_parse(t: RetailTables) -> DataFrame:
    return clean.parse_startup(_routed_lines(t, schemas.STARTUP_TOPIC))


@register("event_parse", with_views(
    "SELECT mid, uid, appid, area, os, type, evid, pgid, npgid, itemid, ts, log_date, log_hour FROM event_log",
    "event_log"))
def event_parse(t: RetailTables) -> DataFrame:
    return clean.parse_event(_routed_lines(t, schemas.EVENT_TOPIC))


@register("cdc_route", f"""
    SELECT '{schemas.ORDER_INFO_TOPIC}' AS topic, count(*) AS n_rows FROM orders
    UNION ALL SELECT '{schemas.ORDER_DETAIL_TOPIC}', count(*) FROM lineitem
    UNION ALL SELECT '{schemas.USER_INFO_TOPIC}', count(*) + count(*) FILTER (WHERE c_custkey % 10 = 3)
    FROM customer
    """)
def cdc_route(t: RetailTables) -> DataFrame:
    return t.routed_changes.groupBy("topic").agg(F.count(F.lit(1)).alias("n_rows"))


@register("cdc_roundtrip_orders", with_views(f"SELECT {ORDER_COLUMNS_SQL} FROM order_info", "order_info"))
def cdc_roundtrip_orders(t: RetailTables) -> DataFrame:
    """Order rows -> change feed -> topic JSON -> parsed and cleaned again."""
    return clean.parse_orders(t.topic(schemas.ORDER_INFO_TOPIC)).select(*schemas.ORDER_INFO_COLUMNS)


@register("user_latest", with_views("SELECT * FROM user_info", "user_info"))
def user_latest(t: RetailTables) -> DataFrame:
    """Latest user row per id from the user topic's inserts and updates."""
    return t.users


# --- coupon alerts --------------------------------------------------------

# Fixture density: a 30 s window holds about one event, so the registered
# queries use a 6 h window sliding by 1 h (the function defaults stay 30 s / 5 s).
ALERT_WINDOW, ALERT_SLIDE = "6 hours", "1 hour"
_ALERT_WINDOW_MS, _ALERT_SLIDE_MS = 6 * 3600 * 1000, 3600 * 1000

# Per window and device, members and events by id; a missing user is one user.
_ALERT_SQL_OF = """
  SELECT mid, ws AS window_start, ws + {window} AS window_end,
         list_sort(list_distinct(list(uid) FILTER (WHERE evid = 'coupon'))) AS uid_list,
         list_sort(list_distinct(list(itemid) FILTER (WHERE evid = 'coupon'))) AS item_list,
         array_to_string(uid_list, ',') AS uids, array_to_string(item_list, ',') AS item_ids,
         CAST(count(DISTINCT coalesce(uid, '-')) FILTER (WHERE evid = 'coupon') AS INTEGER) AS n_users,
         coalesce(bool_or(evid = 'clickItem'), false) AS has_veto,
         count(*) AS n_events, any_value(events) AS events, any_value(event_list) AS event_list, ws + {window} AS ts
  FROM (SELECT e.*, (e.ts // {slide} - r.i) * {slide} AS ws
        FROM {events} e, (SELECT range AS i FROM range(0, {window} // {slide})) r)
  JOIN (SELECT mid, ws, string_agg(evid || ':' || CAST(n AS VARCHAR), ',' ORDER BY evid) AS events,
               list(struct_pack(evid := evid, n := n) ORDER BY evid) AS event_list
        FROM (SELECT mid, ws, coalesce(evid, 'null') AS evid, count(*) AS n
              FROM (SELECT e.*, (e.ts // {slide} - r.i) * {slide} AS ws
                    FROM {events} e, (SELECT range AS i FROM range(0, {window} // {slide})) r)
              GROUP BY ALL) GROUP BY mid, ws) USING (mid, ws)
  GROUP BY mid, ws
"""
_ALERT_SQL = _ALERT_SQL_OF.format(window=_ALERT_WINDOW_MS, slide=_ALERT_SLIDE_MS, events="event_log")
_ALERT_COLUMNS = "mid, window_start, window_end, uids, item_ids, n_users, has_veto, n_events, events, ts"


def _alert_counts(t: RetailTables) -> DataFrame:
    return alerts.alert_counts(alerts.with_event_time(t.event_logs), ALERT_WINDOW, ALERT_SLIDE)


def _alert_windows(t: RetailTables) -> DataFrame:
    return alerts.alert_windows(alerts.with_event_time(t.event_logs), ALERT_WINDOW, ALERT_SLIDE)


def _with_members(t: RetailTables, found: DataFrame) -> DataFrame:
    return alerts.with_members(found, alerts.with_event_time(t.event_logs), ALERT_WINDOW, ALERT_SLIDE)


@register("coupon_alert_candidates", with_views(
    f"SELECT {_ALERT_COLUMNS} FROM w WHERE n_users >= 3", "event_log", extra={"w": _ALERT_SQL}))
def coupon_alert_candidates(t: RetailTables) -> DataFrame:
    return alerts.render(_with_members(t, alerts.alert_candidates(_alert_counts(t))))


@register("coupon_alert_windows", with_views(
    f"SELECT {_ALERT_COLUMNS} FROM w WHERE n_users >= 3 AND NOT has_veto", "event_log", extra={"w": _ALERT_SQL}))
def coupon_alert_windows(t: RetailTables) -> DataFrame:
    return alerts.render(_alert_windows(t))


@register("coupon_alert_latest", with_views("""
    SELECT * EXCLUDE (rn, uid_list, item_list, event_list) FROM (
      SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY ts DESC, window_start DESC) AS rn
      FROM (SELECT *, mid || CAST(ts // 60000 AS VARCHAR) AS doc_id FROM w WHERE n_users >= 3 AND NOT has_veto))
    WHERE rn = 1""", "event_log", extra={"w": _ALERT_SQL}))
def coupon_alert_latest(t: RetailTables) -> DataFrame:
    return alerts.render(alerts.latest_per_document(_alert_windows(t)))


# --- orders x details x users ---------------------------------------------

AGE_AS_OF = "2020-03-01"
JOIN_WITHIN_S = 300

_SALE_COLS_SQL = """
  d.id AS order_detail_id, o.id AS order_id, o.order_status AS order_status, o.create_time AS create_time,
  o.user_id AS user_id, d.sku_id AS sku_id, TRY_CAST(d.order_price AS DOUBLE) AS sku_price,
  d.sku_name AS sku_name, o.create_date AS dt"""

_PAIRS_SQL = f"""
  SELECT {_SALE_COLS_SQL}
  FROM order_detail d JOIN order_info o ON d.order_id = o.id
   AND d.ingest_ts BETWEEN o.ingest_ts - INTERVAL {JOIN_WITHIN_S} SECOND AND o.ingest_ts + INTERVAL {JOIN_WITHIN_S} SECOND
"""

_SALE_DETAIL_SQL = f"""
  SELECT s.order_detail_id, s.order_id, s.order_status, s.create_time, s.user_id, s.sku_id,
         u.gender AS user_gender,
         coalesce(CAST(date_diff('day', CAST(u.birthday AS DATE), DATE '{AGE_AS_OF}') // 365 AS INTEGER), 0) AS user_age,
         u.user_level AS user_level, s.sku_price, s.sku_name, s.dt
  FROM pairs s LEFT JOIN user_info u ON s.user_id = u.id
"""


@register("order_detail_interval", with_views("SELECT * FROM pairs", "order_info", "order_detail",
                                              extra={"pairs": _PAIRS_SQL}))
def order_detail_interval(t: RetailTables) -> DataFrame:
    """Order x line pairs whose arrivals are at most 300 s apart, each once."""
    return sale_detail.join_within(t.bare_orders, t.details, JOIN_WITHIN_S)


@register("order_detail_full_outer", with_views(f"""
    SELECT d.id AS order_detail_id, coalesce(o.id, d.order_id) AS order_id, o.order_status AS order_status,
           o.create_time AS create_time, o.user_id AS user_id, d.sku_id AS sku_id,
           TRY_CAST(d.order_price AS DOUBLE) AS sku_price, d.sku_name AS sku_name, o.create_date AS dt
    FROM order_detail d FULL OUTER JOIN order_info o ON d.order_id = o.id""", "order_info", "order_detail"))
def order_detail_full_outer(t: RetailTables) -> DataFrame:
    return sale_detail.join_all(t.bare_orders, t.details)


@register("unmatched_orders", with_views(f"""
    SELECT {ORDER_COLUMNS_SQL} FROM order_info o
    WHERE NOT EXISTS (SELECT 1 FROM order_detail d WHERE d.order_id = o.id)""", "order_info", "order_detail"))
def unmatched_orders(t: RetailTables) -> DataFrame:
    return sale_detail.unmatched_orders(t.orders, t.details).select(*schemas.ORDER_INFO_COLUMNS)


@register("unmatched_details", with_views("""
    SELECT d.id, d.order_id, d.sku_name, d.sku_id, d.order_price, NULL::VARCHAR AS img_url, d.sku_num
    FROM order_detail d WHERE NOT EXISTS (SELECT 1 FROM order_info o WHERE o.id = d.order_id)""",
    "order_info", "order_detail"))
def unmatched_details(t: RetailTables) -> DataFrame:
    return sale_detail.unmatched_details(t.bare_orders, t.details).select(*schemas.ORDER_DETAIL.fieldNames())


@register("orders_missed_interval", with_views(f"""
    SELECT {ORDER_COLUMNS_SQL} FROM order_info o
    WHERE NOT EXISTS (SELECT 1 FROM order_detail d WHERE d.order_id = o.id
      AND d.ingest_ts BETWEEN o.ingest_ts - INTERVAL {JOIN_WITHIN_S} SECOND
                          AND o.ingest_ts + INTERVAL {JOIN_WITHIN_S} SECOND)""", "order_info", "order_detail"))
def orders_missed_interval(t: RetailTables) -> DataFrame:
    """Orders that met no line within 300 s (they leave the join cache unmatched)."""
    return sale_detail.unmatched_orders_within(t.orders, t.details, JOIN_WITHIN_S).select(
        *schemas.ORDER_INFO_COLUMNS)


@register("sale_detail", with_views(_SALE_DETAIL_SQL, "order_info", "order_detail", "user_info",
                                    extra={"pairs": _PAIRS_SQL}))
def sale_detail_table(t: RetailTables) -> DataFrame:
    """The wide sale_detail table: interval-joined pairs plus user fields."""
    return sale_detail.build_sale_detail(t.bare_orders, t.details, t.users, AGE_AS_OF, JOIN_WITHIN_S)


# --- search page and province map -----------------------------------------

SEARCH_DAY, SEARCH_KEYWORD, PAGE_START, PAGE_LENGTH = GMV_DAY, "", 5, 10
SEARCH_DAY_KW, SEARCH_KEYWORD_KW = "1996-09-17", "Red"
_SALE_DETAIL_VIEWS = ("order_info", "order_detail", "user_info")
_SALE_EXTRA = {"pairs": _PAIRS_SQL, "sale": _SALE_DETAIL_SQL}


def _sales(t: RetailTables) -> DataFrame:
    return sale_detail.build_sale_detail(t.bare_orders, t.details, t.users, AGE_AS_OF, JOIN_WITHIN_S)


@register("sale_search_page", with_views(f"""
    SELECT * FROM sale WHERE dt = '{SEARCH_DAY}' ORDER BY order_detail_id
    LIMIT {PAGE_LENGTH} OFFSET {PAGE_START}""", *_SALE_DETAIL_VIEWS, extra=_SALE_EXTRA))
def sale_search_page(t: RetailTables) -> DataFrame:
    return search.search_page(search.filter_sales(_sales(t), SEARCH_DAY, SEARCH_KEYWORD), PAGE_START, PAGE_LENGTH)


@register("sale_search_keyword", with_views(f"""
    SELECT * FROM sale WHERE dt = '{SEARCH_DAY_KW}' AND contains(lower(sku_name), lower('{SEARCH_KEYWORD_KW}'))""",
    *_SALE_DETAIL_VIEWS, extra=_SALE_EXTRA))
def sale_search_keyword(t: RetailTables) -> DataFrame:
    """All hits of a keyword search on one day (no paging)."""
    return search.filter_sales(_sales(t), SEARCH_DAY_KW, SEARCH_KEYWORD_KW)


@register("sale_search_total", with_views(
    f"SELECT count(*) AS total FROM sale WHERE dt = '{SEARCH_DAY}'", *_SALE_DETAIL_VIEWS, extra=_SALE_EXTRA))
def sale_search_total(t: RetailTables) -> DataFrame:
    return search.search_total(search.filter_sales(_sales(t), SEARCH_DAY, SEARCH_KEYWORD))


@register("sale_gender_share", with_views("""
    SELECT user_gender, n, round(n * 100.0 / sum(n) OVER (), 2) AS pct
    FROM (SELECT user_gender, count(*) AS n FROM sale GROUP BY user_gender)""",
    *_SALE_DETAIL_VIEWS, extra=_SALE_EXTRA))
def sale_gender_share(t: RetailTables) -> DataFrame:
    """Gender shares over every sale row (the search with no day filter)."""
    return search.gender_share(_sales(t))


@register("sale_age_share", with_views("""
    SELECT age_band, n, round(n * 100.0 / sum(n) OVER (), 2) AS pct
    FROM (SELECT CASE WHEN user_age < 20 THEN 'under 20' WHEN user_age < 30 THEN '20 to 29'
                      WHEN user_age >= 30 THEN '30 and over' ELSE 'unknown' END AS age_band, count(*) AS n FROM sale GROUP BY 1)""",
    *_SALE_DETAIL_VIEWS, extra=_SALE_EXTRA))
def sale_age_share(t: RetailTables) -> DataFrame:
    return search.age_share(_sales(t))


@register("sale_day_shares", with_views(f"""
    SELECT 'gender' AS dim, user_gender AS label, n, round(n * 100.0 / sum(n) OVER (), 2) AS pct
    FROM (SELECT user_gender, count(*) AS n FROM sale WHERE dt = '{SEARCH_DAY}' GROUP BY user_gender)
    UNION ALL
    SELECT 'age', age_band, n, round(n * 100.0 / sum(n) OVER (), 2)
    FROM (SELECT CASE WHEN user_age < 20 THEN 'under 20' WHEN user_age < 30 THEN '20 to 29'
                      WHEN user_age >= 30 THEN '30 and over' ELSE 'unknown' END AS age_band, count(*) AS n
          FROM sale WHERE dt = '{SEARCH_DAY}' GROUP BY 1)""", *_SALE_DETAIL_VIEWS, extra=_SALE_EXTRA))
def sale_day_shares(t: RetailTables) -> DataFrame:
    """The two pie charts of one search: gender and age shares of the day."""
    return search.shares(search.filter_sales(_sales(t), SEARCH_DAY, SEARCH_KEYWORD))


@register("user_age_bands", with_views(f"""
    SELECT CASE WHEN a < 20 THEN 'under 20' WHEN a < 30 THEN '20 to 29' WHEN a >= 30 THEN '30 and over' ELSE 'unknown' END AS age_band,
           count(*) AS n
    FROM (SELECT date_diff('day', CAST(birthday AS DATE), DATE '{AGE_AS_OF}') // 365 AS a FROM user_info)
    GROUP BY 1""", "user_info"))
def user_age_bands(t: RetailTables) -> DataFrame:
    """Users per age band at the as-of date."""
    return (t.users.groupBy(C.age_band(C.age_years("birthday", F.lit(AGE_AS_OF))).alias("age_band"))
            .agg(F.count(F.lit(1)).alias("n")))


@register("province_sales", with_views("""
    SELECT s.province_id, n.n_name AS province, s.order_count, s.order_amount,
           least(greatest(CAST(floor(s.order_count / 100) * 100 AS BIGINT), 0), 500) AS band
    FROM (SELECT province_id, count(*) AS order_count,
                 CAST(sum(CAST(total_amount AS DECIMAL(28,4))) AS DOUBLE) AS order_amount
          FROM order_info GROUP BY province_id) s
    LEFT JOIN nation n ON CAST(n.n_nationkey AS VARCHAR) = s.province_id""", "order_info"))
def province_sales(t: RetailTables) -> DataFrame:
    return search.province_sales(t.orders, t.raw("nation"))


# --- streaming replays ------------------------------------------------------

def _stamped_lines(t: RetailTables, topic: str) -> DataFrame:
    return _topic_lines(t, topic).select(
        "value", F.timestamp_millis("stamp_ms").alias("ingest_ts"), (F.col("stamp_ms") / 1000.0).alias("_t"))


def _topic_messages(t: RetailTables, topic: str) -> DataFrame:
    return t.topic(topic).withColumn("_t", F.unix_seconds("ingest_ts").cast("double"))


@register("dau_stream", with_views("SELECT * FROM dau", "dau"))
def dau_stream(t: RetailTables) -> DataFrame:
    """Startup topic replayed through the streaming DAU job (earliest row per
    day and device in the state store, written as it changes)."""
    spark = t.spark
    topic, ckpt = work_path(spark, "topics", "start"), work_path(spark, "ckpt", "dau")
    table = AppendTable(work_path(spark, "tables", "dau"), partition_by=["log_date"])
    replay({topic: (_stamped_lines(t, schemas.STARTUP_TOPIC), "_t")},
           lambda: jobs.dau_job(read_topic_files(spark, topic), table, ckpt, available_now=True))
    return jobs.read_dau(table.read(spark))


@register("order_upsert_stream", with_views(f"SELECT {ORDER_COLUMNS_SQL} FROM order_info", "order_info"))
def order_upsert_stream(t: RetailTables) -> DataFrame:
    """Order topic replayed through the streaming upsert job: versions
    appended through the file sink, latest per id on read. (A live table is
    partitioned by ``create_date``; this replay squeezes six years of orders
    into four batches, a handful per day, so it is left unpartitioned.)"""
    spark = t.spark
    topic, ckpt = work_path(spark, "topics", "orders"), work_path(spark, "ckpt", "orders")
    table = LogTable(work_path(spark, "tables", "orders"), keys=["id"], order_by=["seq"])
    replay({topic: (_topic_messages(t, schemas.ORDER_INFO_TOPIC), "_t")},
           lambda: jobs.order_job(read_topic_files(spark, topic), table, ckpt, available_now=True))
    return table.read(spark).select(*schemas.ORDER_INFO_COLUMNS)


@register("coupon_alert_stream", with_views("""
    SELECT * EXCLUDE (rn, uid_list, item_list, event_list) FROM (
      SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY ts DESC, window_start DESC) AS rn
      FROM (SELECT *, mid || CAST(ts // 60000 AS VARCHAR) AS doc_id FROM w WHERE n_users >= 3 AND NOT has_veto))
    WHERE rn = 1""", "event_log", extra={"w": _ALERT_SQL}))
def coupon_alert_stream(t: RetailTables) -> DataFrame:
    """Event topic replayed through the count job and the claim job; the
    reader applies the alert test and collects members of the alerts only."""
    spark = t.spark
    counts, topic = _alert_count_stream(t)
    claims, ckpt = work_path(spark, "tables", "claims"), work_path(spark, "ckpt", "claims")
    jobs.claim_job(read_topic_files(spark, topic), claims, ckpt, available_now=True).awaitTermination()
    return alerts.render(jobs.read_alerts(spark, counts, claims, ALERT_WINDOW, ALERT_SLIDE))


#: An event lies in several windows, and each is a row of the state.
EVENTS_AT_ONCE = AT_ONCE // 4


def _alert_count_stream(t: RetailTables) -> tuple[str, str]:
    """Replay the event topic through the count job: (table, topic) folders.

    After the data, one heartbeat event (a clock tick a day later, on its own
    device, with no coupon user so it can never alert) moves the watermark
    past the last windows, as the passing of time does in a live stream; one
    more run emits them."""
    spark = t.spark
    topic, ckpt, out = (work_path(spark, "topics", "event"), work_path(spark, "ckpt", "alert_counts"),
                        work_path(spark, "tables", "alert_counts"))
    lines = _stamped_lines(t, schemas.EVENT_TOPIC)

    def run():
        return jobs.alert_count_job(read_topic_files(spark, topic, 1), out, ckpt, ALERT_WINDOW, ALERT_SLIDE,
                                    watermark="1 hour", available_now=True)

    replay({topic: (lines, "_t")}, run, at_once=EVENTS_AT_ONCE)
    _tick(spark, topic, {"mid": "__heartbeat__", "evid": "heartbeat"}, run)
    return out, topic


def _arrivals(spark: SparkSession, *topics: str) -> DataFrame:
    """When the messages of topics arrived (no text is read or derived again)."""
    return reduce(DataFrame.unionByName, [jobs.read_or_empty(spark, TOPIC_FILE_SCHEMA, path).select("ingest_ts") for path in topics])


def _tick(spark, topic: str, fields: dict[str, str], run) -> None:
    """One message a day after the last, then two more runs."""
    tick_ms = F.col("last") + F.lit(86_400_000)
    heartbeat = _arrivals(spark, topic).agg(F.max(F.unix_millis("ingest_ts")).alias("last")).select(
        F.to_json(F.struct(*[F.lit(v).alias(k) for k, v in fields.items()], tick_ms.alias("ts"))).alias("value"),
        F.timestamp_millis(tick_ms).alias("ingest_ts"))
    append_topic_files(heartbeat, topic)
    for _ in range(2):
        run().awaitTermination()


@register("sale_detail_stream", with_views(_SALE_DETAIL_SQL, "order_info", "order_detail", "user_info",
                                           extra={"pairs": _PAIRS_SQL}))
def sale_detail_stream(t: RetailTables) -> DataFrame:
    """Order and detail topics replayed through the stream-stream interval
    join job; users are looked up for each micro-batch."""
    users = t.users.checkpoint(eager=True)  # built once, read by every batch
    return _sale_detail_stream(t, lambda i: users)


def _sale_detail_stream(t: RetailTables, users_at) -> DataFrame:
    """``users_at(i)``: the user table during the i-th replayed chunk."""
    spark, chunk = t.spark, [0]
    o_topic, d_topic = work_path(spark, "topics", "orders"), work_path(spark, "topics", "details")
    ckpt = work_path(spark, "ckpt", "sale_detail")
    table = AppendTable(work_path(spark, "tables", "sale_detail"), partition_by=["dt_month"])

    def run():
        return jobs.sale_detail_job(read_topic_files(spark, o_topic, 1), read_topic_files(spark, d_topic, 1),
                                    lambda: users_at(chunk[0]), table, ckpt, AGE_AS_OF, JOIN_WITHIN_S, available_now=True)

    replay({o_topic: (_topic_messages(t, schemas.ORDER_INFO_TOPIC), "_t"),
            d_topic: (_topic_messages(t, schemas.ORDER_DETAIL_TOPIC), "_t")}, run, at_once=AT_ONCE, keep=False,
           starting=lambda i: chunk.__setitem__(0, i))
    return table.read(spark).select(*schemas.SALE_DETAIL_COLUMNS)  # drops the dt_month partition


@register("coupon_alert_documents", with_views("""
    SELECT doc_id, CAST(to_json(struct_pack(mid := mid, uids := uid_list, itemIds := item_list, events := event_list,
                                            ts := ts)) AS VARCHAR) AS doc
    FROM (SELECT * EXCLUDE (rn) FROM (
      SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY ts DESC, window_start DESC) AS rn
      FROM (SELECT *, mid || CAST(ts // 60000 AS VARCHAR) AS doc_id FROM w WHERE n_users >= 3 AND NOT has_veto))
    WHERE rn = 1)""", "event_log", extra={"w": _ALERT_SQL}))
def coupon_alert_documents(t: RetailTables) -> DataFrame:
    """Alert documents as the keyed index stores them: (doc_id, JSON text)."""
    return alerts.to_documents(alerts.latest_per_document(_alert_windows(t)))


@register("topic_files_route", _LOG_TOPIC_COUNTS_SQL)
def topic_files_route(t: RetailTables) -> DataFrame:
    """Stamped log lines written through the file topic sink (one folder per
    topic) and read back: messages per topic."""
    path = work_path(t.spark, "topic_sink")
    write_topic_files(ingest.route_logs(ingest.stamp_log(t.raw_log_lines, "stamp_ms")), path)
    return (t.spark.read.text(path).groupBy(F.col("topic").cast("string").alias("topic"))
            .agg(F.count(F.lit(1)).alias("n_rows")))


@register("order_detail_interval_stream", with_views("SELECT * FROM pairs", "order_info", "order_detail",
                                                     extra={"pairs": _PAIRS_SQL}))
def order_detail_interval_stream(t: RetailTables) -> DataFrame:
    """Order and detail topics replayed through the stream-stream interval join."""
    spark = t.spark
    o_topic, d_topic = work_path(spark, "topics", "orders"), work_path(spark, "topics", "details")
    ckpt, out = work_path(spark, "ckpt", "pairs"), work_path(spark, "tables", "pairs")
    replay({o_topic: (_topic_messages(t, schemas.ORDER_INFO_TOPIC), "_t"),
            d_topic: (_topic_messages(t, schemas.ORDER_DETAIL_TOPIC), "_t")},
           lambda: jobs.interval_join_job(read_topic_files(spark, o_topic, 1), read_topic_files(spark, d_topic, 1),
                                          out, ckpt, JOIN_WITHIN_S, available_now=True), at_once=AT_ONCE, keep=False)
    return spark.read.parquet(out)


@register("dau_stream_state", with_views("SELECT * FROM dau", "dau"))
def dau_stream_state(t: RetailTables) -> DataFrame:
    """Startup topic replayed through the closed-days DAU job; a message two
    days later closes the last day."""
    spark = t.spark
    topic, ckpt = work_path(spark, "topics", "start"), work_path(spark, "ckpt", "dau_final")
    out = work_path(spark, "tables", "dau_final")
    lines = _stamped_lines(t, schemas.STARTUP_TOPIC)

    def run():
        return jobs.dau_final_job(read_topic_files(spark, topic), out, ckpt, available_now=True)

    replay({topic: (lines, "_t")}, run)
    for _ in range(2):
        _tick(spark, topic, {"mid": "__heartbeat__"}, run)
    return jobs.read_dau_final(spark, out).where(F.col("mid") != "__heartbeat__")


_ANSWER_SQL = """
    SELECT CAST(to_json(struct_pack(
      yesterday := coalesce(map_from_entries(list(struct_pack(k := hour, v := value) ORDER BY hour) FILTER (WHERE day = 'yesterday')), MAP {}),
      today := coalesce(map_from_entries(list(struct_pack(k := hour, v := value) ORDER BY hour) FILTER (WHERE day = 'today')), MAP {})))
      AS VARCHAR) AS answer
    FROM series"""


@register("realtime_hours_answer", with_views(
    _ANSWER_SQL, "dau",
    extra={"series": _series_sql("log_date", "log_hour", "CAST(count(*) AS DOUBLE)", "dau", DAU_DAY)}))
def realtime_hours_answer(t: RetailTables) -> DataFrame:
    """The realtime-hours answer as the service returns it: one JSON text."""
    return metrics.hours_answer(metrics.realtime_hours(metrics.CARD_DAU, t.dau_of(DAU_DAY, metrics.yesterday_of(DAU_DAY)), t.bare_orders, DAU_DAY))


@register("dau_hours_from_table", with_views(
    f"SELECT log_hour, count(*) AS dau FROM dau WHERE log_date = '{DAU_DAY}' GROUP BY log_hour", "dau"))
def dau_hours_from_table(t: RetailTables) -> DataFrame:
    """The dashboard path: the DAU table is written partitioned by day, and
    the hourly question reads it back, so the scan prunes to one day folder."""
    table = AppendTable(work_path(t.spark, "tables", "dau_batch"), partition_by=["log_date"])
    table.write_batch(t.dau, 0)
    return metrics.dau_hours(table.read(t.spark), DAU_DAY)


@register("sale_search_page_from_table", with_views(f"""
    SELECT * FROM sale WHERE dt = '{SEARCH_DAY}' ORDER BY order_detail_id
    LIMIT {PAGE_LENGTH} OFFSET {PAGE_START}""", *_SALE_DETAIL_VIEWS, extra=_SALE_EXTRA))
def sale_search_page_from_table(t: RetailTables) -> DataFrame:
    """The dashboard path of the search: sale_detail is written as the index
    the page reads, partitioned by month (``dt_month``; days are sparse, a
    month folder holds ~30 of them), and one page of one day is read back:
    the month filter prunes the scan to one folder, the day filter runs on
    its rows."""
    table = AppendTable(work_path(t.spark, "tables", "sale_detail"), partition_by=["dt_month"])
    table.write_batch(_sales(t).withColumn("dt_month", F.substring("dt", 1, 7)), 0)
    month = table.read(t.spark).where(F.col("dt_month") == SEARCH_DAY[:7])
    hits = search.filter_sales(month, SEARCH_DAY, SEARCH_KEYWORD)
    return search.search_page(hits, PAGE_START, PAGE_LENGTH).select(*schemas.SALE_DETAIL_COLUMNS)


_ALERT_COUNT_COLS = "mid, window_start, window_end, n_users, has_veto, n_events, events, ts"


@register("coupon_alert_counts", with_views(
    f"SELECT {_ALERT_COUNT_COLS} FROM w WHERE n_users >= 3 AND NOT has_veto", "event_log",
    extra={"w": _ALERT_SQL}))
def coupon_alert_counts(t: RetailTables) -> DataFrame:
    """Alerts from the counts alone (no member is collected)."""
    return alerts.render(alerts.coupon_alerts(_alert_counts(t)))


@register("coupon_alert_members", with_views(f"""
    SELECT DISTINCT c.mid, c.ws AS window_start, c.uid, c.itemid
    FROM (SELECT e.*, (e.ts // {_ALERT_SLIDE_MS} - r.i) * {_ALERT_SLIDE_MS} AS ws
          FROM event_log e, (SELECT range AS i FROM range(0, {_ALERT_WINDOW_MS // _ALERT_SLIDE_MS})) r
          WHERE e.evid = 'coupon') c
    JOIN (SELECT mid, window_start FROM w WHERE n_users >= 3 AND NOT has_veto) a
      ON a.mid = c.mid AND a.window_start = c.ws""", "event_log", extra={"w": _ALERT_SQL}))
def coupon_alert_members(t: RetailTables) -> DataFrame:
    """The coupon claims behind each alert, as rows (the long form of the sets)."""
    ev = alerts.with_event_time(t.event_logs)
    found = alerts.coupon_alerts(alerts.alert_counts(ev, ALERT_WINDOW, ALERT_SLIDE))
    return alerts.alert_members(ev, found, ALERT_WINDOW, ALERT_SLIDE)


@register("coupon_alert_count_stream", with_views(
    f"SELECT {_ALERT_COUNT_COLS} FROM w WHERE n_users >= 3 AND NOT has_veto", "event_log",
    extra={"w": _ALERT_SQL}))
def coupon_alert_count_stream(t: RetailTables) -> DataFrame:
    """Event topic replayed through the chained-aggregation count job."""
    counts, _ = _alert_count_stream(t)
    return alerts.render(alerts.coupon_alerts(t.spark.read.parquet(counts)))


@register("orders_missed_interval_stream", with_views(f"""
    SELECT {ORDER_COLUMNS_SQL} FROM order_info o
    WHERE NOT EXISTS (SELECT 1 FROM order_detail d WHERE d.order_id = o.id
      AND d.ingest_ts BETWEEN o.ingest_ts - INTERVAL {JOIN_WITHIN_S} SECOND
                          AND o.ingest_ts + INTERVAL {JOIN_WITHIN_S} SECOND)""", "order_info", "order_detail"))
def orders_missed_interval_stream(t: RetailTables) -> DataFrame:
    """Order and detail topics replayed through the left-outer interval join:
    the orders whose lines never arrived within 300 s. A heartbeat message on
    each topic a day after the data closes the last orders' intervals."""
    spark = t.spark
    o_topic, d_topic = work_path(spark, "topics", "orders"), work_path(spark, "topics", "details")
    ckpt, out = work_path(spark, "ckpt", "missed"), work_path(spark, "tables", "missed")
    orders, details = _topic_messages(t, schemas.ORDER_INFO_TOPIC), _topic_messages(t, schemas.ORDER_DETAIL_TOPIC)

    def run():
        return jobs.unmatched_orders_job(read_topic_files(spark, o_topic), read_topic_files(spark, d_topic),
                                         out, ckpt, JOIN_WITHIN_S, available_now=True)

    replay({o_topic: (orders, "_t"), d_topic: (details, "_t")}, run)
    _close_intervals(spark, o_topic, d_topic, run)
    return spark.read.parquet(out).where(F.col("id") != "__heartbeat__").select(*schemas.ORDER_INFO_COLUMNS)


# --- rows that can fail: odd values, several versions, message text ---------

@register("hours_of_odd_times", with_views("""
    SELECT hour, coalesce(sum(value) FILTER (WHERE day = 'yesterday'), 0) AS yesterday,
           coalesce(sum(value) FILTER (WHERE day = 'today'), 0) AS today
    FROM (SELECT CASE WHEN create_date = '1996-09-17' THEN 'today' ELSE 'yesterday' END AS day,
                 CASE WHEN okey % 5 = 0 THEN 'unknown' ELSE create_hour END AS hour,
                 CAST(CAST(total_amount AS DECIMAL(28,4)) AS DOUBLE) AS value
          FROM order_info WHERE create_date IN ('1996-09-17', '1996-09-16')
          UNION ALL SELECT '', lpad(CAST(range AS VARCHAR), 2, '0'), 0 FROM range(24))
    GROUP BY hour""", "order_info"))
def hours_of_odd_times(t: RetailTables) -> DataFrame:
    """Hours of orders of which some have no time and some an hour of one
    digit: the columns still add up to the day's revenue."""
    text = fixtures.order_info_text(t.raw("orders"), None)
    key = F.col("id").cast("bigint")
    date, time = F.substring("create_time", 1, 10), F.substring("create_time", 12, 8)
    odd = F.when(key % 5 == 0, date).when(key % 5 == 1, F.concat(date, F.lit(" "), F.regexp_replace(time, "^0", ""))).otherwise(F.col("create_time"))
    orders = clean.clean_orders(text.withColumn("create_time", odd))
    return metrics.hour_table(metrics.realtime_hours(metrics.CARD_ORDER_AMOUNT, t.dau, orders, GMV_DAY))


@register("hours_answer_empty_day", with_views(
    _ANSWER_SQL, "order_info",
    extra={"series": _series_sql("create_date", "create_hour", "CAST(sum(CAST(total_amount AS DECIMAL(28,4))) AS DOUBLE)",
                                 "(SELECT * FROM order_info WHERE create_date <> '1996-09-16')", GMV_DAY)}))
def hours_answer_empty_day(t: RetailTables) -> DataFrame:
    """The hours answer when the day before has no rows: its key stays."""
    orders = t.bare_orders.where(F.col("create_date") != "1996-09-16")
    return metrics.hours_answer(metrics.realtime_hours(metrics.CARD_ORDER_AMOUNT, t.dau, orders, GMV_DAY))


@register("coupon_alert_odd_events", with_views(
    f"SELECT {_ALERT_COLUMNS} FROM w WHERE n_users >= 3 AND NOT has_veto", "event_log",
    extra={"odd": """SELECT mid, CASE WHEN CAST(uid AS BIGINT) % 7 = 0 THEN NULL ELSE uid END AS uid,
                            CASE WHEN evid <> 'clickItem' THEN evid WHEN CAST(itemid AS BIGINT) % 3 = 0 THEN 'share'
                                 WHEN CAST(itemid AS BIGINT) % 3 = 1 THEN NULL ELSE 'addComment' END AS evid, itemid, ts
                     FROM event_log""",
           "w": _ALERT_SQL_OF.format(window=_ALERT_WINDOW_MS, slide=_ALERT_SLIDE_MS, events="odd")}))
def coupon_alert_odd_events(t: RetailTables) -> DataFrame:
    """Alerts where events have no user, an id outside the known ones, or none."""
    item, evid = F.col("itemid").cast("bigint"), F.col("evid")
    odd = t.event_logs.withColumns({
        "uid": F.when(F.col("uid").cast("bigint") % 7 != 0, F.col("uid")),
        "evid": F.when(evid != "clickItem", evid).when(item % 3 == 0, "share").when(item % 3 == 2, "addComment"),
    })
    return alerts.render(alerts.alert_windows(alerts.with_event_time(odd), ALERT_WINDOW, ALERT_SLIDE))


@register("coupon_alert_shared_minute", with_views("""
    SELECT doc_id, window_start, window_end, n_users, events FROM (
      SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY ts DESC, window_start DESC) AS rn
      FROM (SELECT *, mid || CAST(ts // 60000 AS VARCHAR) AS doc_id FROM w WHERE n_users >= 3 AND NOT has_veto))
    WHERE rn = 1""", "event_log", extra={
    "odd": "SELECT mid, uid, evid, itemid, ts // 720 AS ts FROM event_log",
    "w": _ALERT_SQL_OF.format(window=30_000, slide=5_000, events="odd")}))
def coupon_alert_shared_minute(t: RetailTables) -> DataFrame:
    """Documents of windows that end in the same minute (30 s by 5 s, on a
    clock run 720 times faster): the last write wins."""
    fast = alerts.with_event_time(t.event_logs.withColumn("ts", F.floor(F.col("ts") / 720).cast("bigint")))
    latest = alerts.latest_per_document(alerts.coupon_alerts(alerts.alert_counts(fast)))
    return alerts.render(latest).select("doc_id", "window_start", "window_end", "n_users", "events")


@register("order_upsert_versions", with_views("""
    SELECT id, CASE WHEN okey % 2 = 0 THEN 'V3' ELSE 'V2' END AS order_status, total_amount FROM order_info""", "order_info"))
def order_upsert_versions(t: RetailTables) -> DataFrame:
    """Three versions of an order, delivered out of order and with a repeat:
    the one with the highest ``seq`` stays (odd keys lack the third)."""
    rows = t.bare_orders.select("id", "total_amount", F.col("id").cast("bigint").alias("k"))
    version = lambda n: rows.select("id", F.lit(f"V{n}").alias("order_status"), "total_amount", F.lit(n).alias("seq"))
    third = rows.where("k % 2 = 0").select("id", F.lit("V3").alias("order_status"), "total_amount", F.lit(3).alias("seq"))
    return latest_per_key(third.unionByName(version(1)).unionByName(version(2)).unionByName(version(1)), ["id"], ["seq"]).drop("seq")


@register("unmatched_details_of_some", with_views("""
    SELECT d.id, d.order_id, d.sku_name, d.sku_id, d.order_price, NULL::VARCHAR AS img_url, d.sku_num
    FROM order_detail d WHERE NOT EXISTS (SELECT 1 FROM order_info o WHERE o.id = d.order_id AND o.order_status <> 'F')""",
    "order_info", "order_detail"))
def unmatched_details_of_some(t: RetailTables) -> DataFrame:
    """Details whose order never came: finished orders are left out."""
    some = t.bare_orders.where(F.col("order_status") != "F")
    return sale_detail.unmatched_details(some, t.details).select(*schemas.ORDER_DETAIL.fieldNames())


_LOG_TEXT_SQL = """
    SELECT '{start}' AS topic, '{{"mid":"' || mid || '","uid":"' || uid || '","appid":"' || appid || '","area":"' || area || '","os":"' || os
           || '","ch":"' || ch || '","type":"' || type || '","vs":"' || vs || '","ts":' || CAST(ts AS VARCHAR) || '}}' AS value FROM startup_log
    UNION ALL
    SELECT '{event}', '{{"mid":"' || mid || '","uid":"' || uid || '","appid":"' || appid || '","area":"' || area || '","os":"' || os
           || '","type":"' || type || '","evid":"' || evid || '","pgid":"' || pgid || '","npgid":"' || npgid || '","itemid":"' || itemid
           || '","ts":' || CAST(ts AS VARCHAR) || '}}' FROM event_log
    """.format(start=schemas.STARTUP_TOPIC, event=schemas.EVENT_TOPIC)


@register("log_archive_text", with_views(f"SELECT value FROM ({_LOG_TEXT_SQL})", "startup_log", "event_log"))
def log_archive_text(t: RetailTables) -> DataFrame:
    """The text of every archived line."""
    path = work_path(t.spark, "log_archive")
    ingest.archive_logs(ingest.stamp_log(t.raw_log_lines, "stamp_ms"), path)
    return t.spark.read.text(path).select("value")


@register("log_ingest_stream", with_views(
    f"SELECT * FROM ({_LOG_TEXT_SQL}) UNION ALL SELECT '{schemas.REJECTED_TOPIC}', 'broken ' || CAST(event_id AS VARCHAR) FROM events WHERE event_id % 10 = 0",
    "startup_log", "event_log"))
def log_ingest_stream(t: RetailTables) -> DataFrame:
    """Posted lines, some of them malformed, through the ingest job: the text
    of each topic's messages."""
    spark = t.spark
    posted, out, ckpt = work_path(spark, "topics", "posted"), work_path(spark, "topics", "logs"), work_path(spark, "ckpt", "ingest")
    bad = t.raw("events").where("event_id % 10 = 0").select(
        F.concat(F.lit("broken "), F.col("event_id").cast("string")).alias("value"), F.unix_millis(F.col("ts").cast("timestamp")).alias("stamp_ms"))
    lines = t.raw_log_lines.unionByName(bad).select(
        "value", F.timestamp_millis("stamp_ms").alias("ingest_ts"), (F.col("stamp_ms") / 1000.0).alias("_t"))
    replay({posted: (lines, "_t")}, lambda: jobs.ingest_job(read_topic_files(spark, posted), out, ckpt, F.unix_millis("ingest_ts"), available_now=True))
    return spark.read.parquet(out).select(F.col("topic").cast("string").alias("topic"), "value")


@register("cdc_stream", with_views(f"""
    SELECT '{schemas.USER_INFO_TOPIC}' AS topic, CAST(c_custkey AS VARCHAR) AS key, c_custkey * 4 + v AS seq,
           '{{"id":"' || CAST(c_custkey AS VARCHAR) || '","login_name":"' || login_name || '","user_level":"'
           || CASE WHEN v = 1 THEN '6' ELSE level END || '","birthday":"' || birthday || '","gender":"' || gender || '"}}' AS value
    FROM (SELECT c.c_custkey, c.c_name AS login_name, u.birthday, u.gender,
                 CASE c_mktsegment WHEN 'AUTOMOBILE' THEN '1' WHEN 'BUILDING' THEN '2' WHEN 'FURNITURE' THEN '3'
                                   WHEN 'HOUSEHOLD' THEN '4' WHEN 'MACHINERY' THEN '5' END AS level
          FROM customer c JOIN user_info u ON u.id = CAST(c.c_custkey AS VARCHAR)), (SELECT range AS v FROM range(2))
    WHERE v = 0 OR c_custkey % 10 = 3
    UNION ALL
    SELECT '{schemas.ORDER_DETAIL_TOPIC}', id, CAST(order_id AS BIGINT) * 4,
           '{{"id":"' || id || '","order_id":"' || order_id || '","sku_name":"' || sku_name || '","sku_id":"' || sku_id
           || '","order_price":"' || order_price || '","img_url":null,"sku_num":"' || sku_num || '"}}' FROM order_detail""",
    "user_info", "order_detail"))
def cdc_stream(t: RetailTables) -> DataFrame:
    """User and detail change envelopes through the change-feed job: key, own
    number and text of each message."""
    spark = t.spark
    feed, out, ckpt = work_path(spark, "topics", "feed"), work_path(spark, "topics", "changes"), work_path(spark, "ckpt", "changes")
    rows = changefeed.table_envelopes(changefeed.keyed_users(t.users_text), "user_info").unionByName(
        changefeed.table_envelopes(changefeed.keyed_details(t.details), "order_detail"))
    lines = rows.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value"), "ingest_ts", F.unix_seconds("ingest_ts").cast("double").alias("_t"))
    replay({feed: (lines, "_t")}, lambda: jobs.change_job(read_topic_files(spark, feed), out, ckpt, available_now=True), keep=False)
    return spark.read.parquet(out).select(F.col("topic").cast("string").alias("topic"), "key", "seq", "value")


@register("sale_detail_user_updates_stream", with_views(f"""
    SELECT s.order_detail_id, s.order_id, s.user_id, u.gender AS user_gender, CASE WHEN o.q < 2 THEN u.user_level ELSE '9' END AS user_level
    FROM pairs s LEFT JOIN user_info u ON s.user_id = u.id
    JOIN (SELECT id, least(CAST(floor((epoch(ingest_ts) - lo) / ((hi - lo) / 4)) AS INTEGER), 3) AS q
          FROM (SELECT *, (SELECT min(x) FROM bounds) AS lo, (SELECT max(x) FROM bounds) AS hi FROM order_detail)) o ON o.id = s.order_detail_id""",
    "order_info", "order_detail", "user_info",
    extra={"pairs": _PAIRS_SQL,
           "bounds": "SELECT epoch(ingest_ts) AS x FROM order_info UNION ALL SELECT epoch(ingest_ts) + CASE WHEN CAST(id AS BIGINT) % 10 = 3 THEN 60 ELSE 0 END FROM order_info UNION ALL SELECT epoch(ingest_ts) FROM order_detail UNION ALL SELECT epoch(ingest_ts) + 60 FROM order_detail WHERE CAST(order_id AS BIGINT) % 10 = 3"}))
def sale_detail_user_updates_stream(t: RetailTables) -> DataFrame:
    """Every user's level changes halfway through the replay: pairs that meet
    later carry the new one."""
    users = t.users.checkpoint(eager=True)
    later = users.withColumn("user_level", F.lit("9"))
    rows = _sale_detail_stream(t, lambda i: users if i < 2 else later)
    return rows.select("order_detail_id", "order_id", "user_id", "user_gender", "user_level")


@register("sale_search_answer", with_views(f"""
    SELECT (SELECT count(*) FROM hits) AS total,
           (SELECT coalesce(list(dim || ':' || coalesce(label, '') || ':' || CAST(n AS VARCHAR) ORDER BY dim, label), []) FROM (
              SELECT 'gender' AS dim, user_gender AS label, count(*) AS n FROM hits GROUP BY 2
              UNION ALL SELECT 'age', CASE WHEN user_age < 20 THEN 'under 20' WHEN user_age < 30 THEN '20 to 29'
                                           WHEN user_age >= 30 THEN '30 and over' ELSE 'unknown' END, count(*) FROM hits GROUP BY 2)) AS stat,
           (SELECT coalesce(list(order_detail_id ORDER BY order_detail_id), []) FROM (SELECT order_detail_id FROM hits ORDER BY 1 LIMIT {PAGE_LENGTH} OFFSET {PAGE_START})) AS detail
    """, *_SALE_DETAIL_VIEWS, extra={**_SALE_EXTRA, "hits": f"SELECT * FROM sale WHERE dt = '{SEARCH_DAY}'"}))
def sale_search_answer(t: RetailTables) -> DataFrame:
    """The whole answer of one search from one filtered set."""
    hits = search.filter_sales(_sales(t), SEARCH_DAY, SEARCH_KEYWORD).checkpoint()
    answer = search.search_answer(hits, PAGE_START, PAGE_LENGTH)
    stat = F.from_json("stat", "array<struct<dim: string, label: string, n: bigint, pct: double>>")
    return answer.select(
        "total", F.transform(stat, lambda x: F.concat_ws(":", x["dim"], F.coalesce(x["label"], F.lit("")), x["n"].cast("string"))).alias("stat"),
        F.from_json("detail", "array<struct<order_detail_id: string>>")["order_detail_id"].alias("detail"))


@register("sale_search_next_page", with_views(f"""
    SELECT * FROM sale WHERE dt = '{SEARCH_DAY}' ORDER BY order_detail_id LIMIT {PAGE_LENGTH} OFFSET {PAGE_LENGTH}""",
    *_SALE_DETAIL_VIEWS, extra=_SALE_EXTRA))
def sale_search_next_page(t: RetailTables) -> DataFrame:
    """The second page by keyset: the rows after the first page's last."""
    hits = search.filter_sales(_sales(t), SEARCH_DAY, SEARCH_KEYWORD).checkpoint()
    last = search.search_page_after(hits, None, PAGE_LENGTH).agg(F.max("order_detail_id")).first()[0]
    return search.search_page_after(hits, last, PAGE_LENGTH)


# --- keyed tables kept by streams ------------------------------------------

_DOCUMENT_SQL = ORACLES["coupon_alert_documents"]


@register("alert_document_stream", _DOCUMENT_SQL)
def alert_document_stream(t: RetailTables) -> DataFrame:
    """Event topic replayed through the document job, then once more as a whole
    by a second writer: the table still holds one document per device and
    minute, and is read as it stands."""
    spark = t.spark
    topic, ckpt, again = work_path(spark, "topics", "event"), work_path(spark, "ckpt", "documents"), work_path(spark, "ckpt", "documents2")
    table = jobs.alert_table(work_path(spark, "tables", "documents"), buckets=4, merge_every=8)
    lines = _stamped_lines(t, schemas.EVENT_TOPIC)

    def run(checkpoint=ckpt, writer="first"):
        table.vacuum(spark)
        return jobs.alert_document_job(read_topic_files(spark, topic, 1), table, checkpoint, ALERT_WINDOW, ALERT_SLIDE,
                                       watermark="1 hour", writer=writer, available_now=True)

    replay({topic: (lines, "_t")}, run, n_chunks=2, at_once=EVENTS_AT_ONCE)
    _tick(spark, topic, {"mid": "__heartbeat__", "evid": "heartbeat"}, run)
    for _ in range(2):
        run(again, "second").awaitTermination()
    table.merge(spark)
    return alerts.to_documents(table.read(spark))


def _order_versions(t: RetailTables) -> DataFrame:
    """Order messages in four deliveries (``_t``): the first version of all, a
    later one of even keys with 100 more, a late copy of the first version, and
    a third one of every third key with another status."""
    text = fixtures.order_info_text(t.raw("orders"), None).drop("ingest_ts")
    key = F.col("id").cast("bigint")

    def version(n: int, seq: int, rows: DataFrame) -> DataFrame:
        return rows.select(F.to_json(F.struct(*rows.columns)).alias("value"), (key * 10 + seq).alias("seq"),
                           F.lit(None).cast("timestamp").alias("ingest_ts"), F.lit(float(n)).alias("_t"))

    dearer = (F.col("total_amount").cast("decimal(18,2)") + 100).cast("decimal(18,2)").cast("string")
    second = version(1, 2, text.where(key % 2 == 0).withColumn("total_amount", dearer))
    third = version(3, 3, text.where(key % 3 == 0).withColumn("order_status", F.lit("V3")))
    return version(0, 1, text).unionByName(second).unionByName(version(2, 1, text.where(key % 5 == 0))).unionByName(third)


def _order_table(t: RetailTables, merge_every: int):
    spark = t.spark
    topic, ckpt = work_path(spark, "topics", "orders"), work_path(spark, "ckpt", "order_table")
    table = jobs.order_table(work_path(spark, "tables", "orders"), merge_every, part_chars=7)

    def run(checkpoint=ckpt, writer="first"):
        return jobs.order_table_job(read_topic_files(spark, topic), table, checkpoint, writer, available_now=True)

    replay({topic: (_order_versions(t), "_t")}, run)
    return table, run


_LATEST_ORDER_SQL = """
    SELECT id, create_date, create_hour, CASE WHEN okey % 3 = 0 THEN 'V3' ELSE order_status END AS order_status,
           total_amount + CASE WHEN okey % 2 = 0 AND okey % 3 <> 0 THEN 100 ELSE 0 END AS total_amount FROM order_info"""


@register("order_snapshot_stream", with_views("""
    SELECT phase, id, create_date, order_status, round(total_amount, 2) AS total_amount
    FROM latest, (SELECT unnest(['deltas', 'replayed', 'merged']) AS phase)""", "order_info", extra={"latest": _LATEST_ORDER_SQL}))
def order_snapshot_stream(t: RetailTables) -> DataFrame:
    """The order table as readers see it with open deltas, after the whole topic
    was delivered again by another writer, and after a merge: always the
    versions with the highest ``seq``."""
    spark = t.spark
    table, run = _order_table(t, merge_every=3)

    def seen(phase: str) -> DataFrame:
        return table.read(spark).select(F.lit(phase).alias("phase"), "id", "create_date", "order_status", F.round("total_amount", 2).alias("total_amount"))

    before = seen("deltas").checkpoint(eager=True)
    run(work_path(spark, "ckpt", "order_table2"), "second").awaitTermination()
    between = seen("replayed").checkpoint(eager=True)
    table.merge(spark)
    return before.unionByName(between).unionByName(seen("merged"))


@register("gmv_hours_kept", with_views("""
    SELECT create_hour, CAST(sum(CAST(total_amount AS DECIMAL(28,4))) AS DOUBLE) AS order_amount
    FROM latest WHERE create_date = '1996-09-17' GROUP BY create_hour""", "order_info", extra={"latest": _LATEST_ORDER_SQL}))
def gmv_hours_kept(t: RetailTables) -> DataFrame:
    """Revenue by hour from the sums that the order table's merges keep: orders
    that changed after their hour was counted are taken back and added again;
    no order is read."""
    table, _ = _order_table(t, merge_every=1)
    return metrics.gmv_hours_of_totals(table.read_totals(t.spark, "hours"), GMV_DAY)


@register("realtime_total_kept", with_views(f"""
    SELECT 'dau' AS id, 'daily active devices' AS name, CAST((SELECT count(*) FROM dau WHERE log_date = '{DAU_DAY}') AS DOUBLE) AS value
    UNION ALL SELECT 'new_mid', 'new devices', CAST((SELECT count(*) FROM (
      SELECT mid, min(log_date) AS d FROM dau GROUP BY mid) WHERE d = '{DAU_DAY}') AS DOUBLE)
    UNION ALL SELECT 'order_amount', 'order amount', (SELECT CAST(sum(CAST(total_amount AS DECIMAL(28,4))) AS DOUBLE) FROM order_info
      WHERE create_date = '{DAU_DAY}')""", "dau", "order_info"))
def realtime_total_kept(t: RetailTables) -> DataFrame:
    """The metric cards with new devices from the first-day table: the days
    arrive latest first, so every earlier row is a backfill that moves a device
    to its true first day. The card reads one count, no history."""
    spark = t.spark
    topic, ckpt = work_path(spark, "topics", "start"), work_path(spark, "ckpt", "first_day")
    table = jobs.first_day_table(work_path(spark, "tables", "first_day"), buckets=4)
    lines = _stamped_lines(t, schemas.STARTUP_TOPIC).withColumn("_t", -F.col("_t"))
    replay({topic: (lines, "_t")}, lambda: jobs.first_day_job(read_topic_files(spark, topic), table, ckpt, available_now=True))
    return metrics.realtime_total(t.dau_of(DAU_DAY), t.orders_of(DAU_DAY), DAU_DAY, table.read_totals(spark, "new_mid"))


@register("dau_late_stream", with_views("SELECT * FROM dau", "dau"))
def dau_late_stream(t: RetailTables) -> DataFrame:
    """Startup topic into the keyed DAU table, a third of the rows delivered
    after everything else: rows of days long over reach their day's table, and
    an earlier row replaces the device's row."""
    spark = t.spark
    topic, ckpt = work_path(spark, "topics", "start"), work_path(spark, "ckpt", "dau_table")
    table = jobs.dau_table(work_path(spark, "tables", "dau"), merge_every=3)
    late = F.xxhash64("value") % 3 == 0
    lines = _stamped_lines(t, schemas.STARTUP_TOPIC).withColumn("_t", F.when(late, F.col("_t") + F.lit(1e9)).otherwise(F.col("_t")))
    replay({topic: (lines, "_t")}, lambda: jobs.dau_table_job(read_topic_files(spark, topic), table, ckpt, available_now=True))
    return table.read(spark)


@register("dau_once_stream", with_views("SELECT log_date, mid, log_date = strftime(make_timestamp(ts * 1000), '%Y-%m-%d') AS own_day, "
                                        "1::BIGINT AS n_rows FROM dau", "dau"))
def dau_once_stream(t: RetailTables) -> DataFrame:
    """Startup topic through the emit-once job: one row per (day, device) in the
    files themselves; ``n_rows`` counts them without resolving any."""
    spark = t.spark
    topic, ckpt, out = work_path(spark, "topics", "start"), work_path(spark, "ckpt", "dau_once"), work_path(spark, "tables", "dau_once")
    replay({topic: (_stamped_lines(t, schemas.STARTUP_TOPIC), "_t")},
           lambda: jobs.dau_once_job(read_topic_files(spark, topic), out, ckpt, available_now=True))
    rows = spark.read.schema(jobs.DAU_SCHEMA).parquet(out)
    return rows.groupBy("log_date", "mid").agg(F.bool_and(C.log_date("ts") == F.col("log_date")).alias("own_day"), F.count(F.lit(1)).alias("n_rows"))


_WITHIN_SQL = f"""d.order_id = o.id AND d.ingest_ts BETWEEN o.ingest_ts - INTERVAL {JOIN_WITHIN_S} SECOND
                                                      AND o.ingest_ts + INTERVAL {JOIN_WITHIN_S} SECOND"""


@register("order_detail_full_outer_stream", with_views(f"""
    SELECT d.id AS order_detail_id, coalesce(o.id, d.order_id) AS order_id, o.order_status, o.create_time, o.user_id, d.sku_id,
           TRY_CAST(d.order_price AS DOUBLE) AS sku_price, d.sku_name, o.create_date AS dt
    FROM order_detail d FULL OUTER JOIN present o ON {_WITHIN_SQL}""", "order_info", "order_detail",
    extra={"present": "SELECT * FROM order_info WHERE okey % 7 <> 0"}))
def order_detail_full_outer_stream(t: RetailTables) -> DataFrame:
    """Order and detail topics, a seventh of the orders missing, through the
    streaming full outer join: pairs, late orders and orphan lines."""
    spark = t.spark
    o_topic, d_topic = work_path(spark, "topics", "orders"), work_path(spark, "topics", "details")
    ckpt, out = work_path(spark, "ckpt", "full_outer"), work_path(spark, "tables", "full_outer")
    orders = _topic_messages(t, schemas.ORDER_INFO_TOPIC).where(F.get_json_object("value", "$.id").cast("bigint") % 7 != 0)
    details = _topic_messages(t, schemas.ORDER_DETAIL_TOPIC)

    def run():
        return jobs.full_outer_job(read_topic_files(spark, o_topic, 1), read_topic_files(spark, d_topic, 1), out, ckpt, JOIN_WITHIN_S, available_now=True)

    replay({o_topic: (orders, "_t"), d_topic: (details, "_t")}, run, n_chunks=2, at_once=AT_ONCE, keep=False)
    _close_intervals(spark, o_topic, d_topic, run)
    return spark.read.parquet(out).where(F.col("order_id") != "__heartbeat__")


def _close_intervals(spark: SparkSession, o_topic: str, d_topic: str, run) -> None:
    """A message on each topic a day after the data, then two more runs."""
    last = _arrivals(spark, o_topic, d_topic).agg(F.max("ingest_ts").alias("last")).checkpoint()  # before the topics grow
    tick = (F.col("last") + F.expr("INTERVAL 1 DAY")).alias("ingest_ts")
    beat = F.lit("__heartbeat__")
    append_topic_files(last.select(F.to_json(F.struct(beat.alias("id"))).alias("value"), tick), o_topic)
    append_topic_files(last.select(F.to_json(F.struct(beat.alias("id"), beat.alias("order_id"))).alias("value"), tick), d_topic)
    for _ in range(2):
        run().awaitTermination()


_USER_VERSION_SQL = """
    SELECT id, user_level, birthday, gender, TIMESTAMP '1990-01-01' AS at, 1 AS seq FROM user_info
    UNION ALL SELECT id, 'later', birthday, CASE gender WHEN 'M' THEN 'F' ELSE 'M' END, TIMESTAMP '1996-01-01', 2 FROM user_info
    WHERE CAST(id AS BIGINT) % 2 = 0"""
_AS_OF_SQL = f"""
    SELECT p.order_detail_id, p.order_id, p.order_status, p.create_time, p.user_id, p.sku_id, u.gender AS user_gender,
           coalesce(CAST(date_diff('day', CAST(u.birthday AS DATE), DATE '{AGE_AS_OF}') // 365 AS INTEGER), 0) AS user_age,
           u.user_level, p.sku_price, p.sku_name, p.dt
    FROM (SELECT d.id AS order_detail_id, o.id AS order_id, o.order_status, o.create_time, o.user_id, d.sku_id,
                 TRY_CAST(d.order_price AS DOUBLE) AS sku_price, d.sku_name, o.create_date AS dt, greatest(o.ingest_ts, d.ingest_ts) AS at
          FROM order_detail d JOIN order_info o ON {_WITHIN_SQL}) p
    ASOF LEFT JOIN versions u ON p.user_id = u.id AND p.at >= u.at"""


def _user_versions(t: RetailTables) -> DataFrame:
    """User changes with arrival: all in 1990, even ones again in 1996."""
    rows = t.users.select(*schemas.USER_INFO.fieldNames())
    first = rows.select("*", F.lit(1).cast("bigint").alias("seq"), F.lit("1990-01-01").cast("timestamp").alias("ingest_ts"))
    other = F.when(F.col("gender") == "M", "F").otherwise("M")
    second = rows.where(F.col("id").cast("bigint") % 2 == 0).withColumns({"user_level": F.lit("later"), "gender": other})
    return first.unionByName(second.select("*", F.lit(2).cast("bigint").alias("seq"), F.lit("1996-01-01").cast("timestamp").alias("ingest_ts")))


@register("sale_detail_as_of", with_views(_AS_OF_SQL, "order_info", "order_detail", "user_info", extra={"versions": _USER_VERSION_SQL}))
def sale_detail_as_of(t: RetailTables) -> DataFrame:
    """Sales with their user as of the sale."""
    pairs = sale_detail.join_within(t.bare_orders, t.details, JOIN_WITHIN_S, sale_time=True)
    return sale_detail.enrich_users_as_of(pairs, _user_versions(t), AGE_AS_OF)


@register("sale_detail_as_of_stream", with_views(_AS_OF_SQL, "order_info", "order_detail", "user_info", extra={"versions": _USER_VERSION_SQL}))
def sale_detail_as_of_stream(t: RetailTables) -> DataFrame:
    """Order, detail and user topics replayed by arrival through the job that
    keeps user versions in its state; no user table is read."""
    spark = t.spark
    topics = {n: work_path(spark, "topics", n) for n in ("orders", "details", "users")}
    table, ckpt = AppendTable(work_path(spark, "tables", "sale_as_of"), partition_by=["dt_month"]), work_path(spark, "ckpt", "sale_as_of")
    users = _user_versions(t)
    changes = users.select(F.to_json(F.struct(*schemas.USER_INFO.fieldNames())).alias("value"), "seq", "ingest_ts",
                           F.unix_seconds("ingest_ts").cast("double").alias("_t"))

    def run():
        o, d, u = (read_topic_files(spark, topics[n], 1) for n in ("orders", "details", "users"))
        return jobs.sale_detail_as_of_job(o, d, u, table, ckpt, AGE_AS_OF, JOIN_WITHIN_S, available_now=True)

    replay({topics["orders"]: (_topic_messages(t, schemas.ORDER_INFO_TOPIC), "_t"),
            topics["details"]: (_topic_messages(t, schemas.ORDER_DETAIL_TOPIC), "_t"), topics["users"]: (changes, "_t")}, run, n_chunks=2,
           at_once=AT_ONCE, keep=False)
    return table.read(spark).select(*schemas.SALE_DETAIL_COLUMNS)


# --- messages sent twice, counts of micro-batches ---------------------------

@register("change_feed_replayed_stream", with_views(f"SELECT {ORDER_COLUMNS_SQL}, 1::BIGINT AS n_rows FROM order_info", "order_info"))
def change_feed_replayed_stream(t: RetailTables) -> DataFrame:
    """The order feed sent twice (the change job started again without its
    checkpoint) and read through the reader that drops repeats by the change's
    own number: every order once."""
    spark = t.spark
    feed, out = work_path(spark, "topics", "feed"), work_path(spark, "topics", "changes")
    rows = changefeed.table_envelopes(changefeed.keyed_orders(t.orders_text), "order_info")
    append_topic_files(rows.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value"), "ingest_ts"), feed)
    for _ in range(2):
        jobs.change_job(read_topic_files(spark, feed), out, work_path(spark, "ckpt", "changes"), available_now=True).awaitTermination()
    once = unique_messages(read_keyed_files(spark, f"{out}/topic={schemas.ORDER_INFO_TOPIC}"))
    path = work_path(spark, "tables", "orders")
    writer = clean.parse_orders(once).select(*schemas.ORDER_INFO_COLUMNS).writeStream.format("parquet").option("path", path)
    jobs._start(writer.outputMode("append"), work_path(spark, "ckpt", "orders"), 5, True, "unique_orders").awaitTermination()
    rows = spark.read.parquet(path)
    return rows.groupBy(*schemas.ORDER_INFO_COLUMNS).agg(F.count(F.lit(1)).alias("n_rows"))


@register("dau_batch_rows_stream", with_views("""
    SELECT q AS batch, count(DISTINCT (log_date, mid)) AS n_rows FROM (
      SELECT *, least(CAST(floor((ts / 1000.0 - lo) / ((hi - lo) / 2)) AS INTEGER), 1) AS q
      FROM startup_log, (SELECT min(ts) / 1000.0 AS lo, max(ts) / 1000.0 AS hi FROM startup_log)) GROUP BY q""", "startup_log"))
def dau_batch_rows_stream(t: RetailTables) -> DataFrame:
    """Rows that each micro-batch of the DAU job put out, as its progress
    reports them, beside the micro-batch's number."""
    spark, queries = t.spark, []
    topic, ckpt = work_path(spark, "topics", "start"), work_path(spark, "ckpt", "dau")
    table = AppendTable(work_path(spark, "tables", "dau"), partition_by=["log_date"])

    def run():
        queries.append(jobs.dau_job(read_topic_files(spark, topic), table, ckpt, available_now=True))
        return queries[-1]

    replay({topic: (_stamped_lines(t, schemas.STARTUP_TOPIC), "_t")}, run, n_chunks=2)
    counts = [(i, sum(jobs.observed_rows(q))) for i, q in enumerate(queries)]
    return spark.createDataFrame(counts, "batch int, n_rows bigint")


# --- keyword index ----------------------------------------------------------

WORDS, WORDS_FROM, WORDS_TO = "Ring RED", "1996-08-20", "1996-10-10"


@register("sale_search_words", with_views(f"""
    SELECT * FROM sale WHERE dt BETWEEN '{WORDS_FROM}' AND '{WORDS_TO}'
      AND list_has_all(string_split(lower(sku_name), ' '), ['red', 'ring'])""", *_SALE_DETAIL_VIEWS, extra=_SALE_EXTRA))
def sale_search_words(t: RetailTables) -> DataFrame:
    """A search for two words over some weeks through the index: postings of the
    words first, then the sales in the folders that hold hits."""
    index = KeywordIndex(work_path(t.spark, "tables", "sale_index"), buckets=4)
    index.write_batch(_sales(t), 0)
    return index.search(t.spark, WORDS, WORDS_FROM, WORDS_TO).select(*schemas.SALE_DETAIL_COLUMNS)


@register("sale_search_far_page", with_views("""
    SELECT * FROM sale ORDER BY order_detail_id LIMIT 20 OFFSET (SELECT count(*) // 2 FROM sale)""", *_SALE_DETAIL_VIEWS, extra=_SALE_EXTRA))
def sale_search_far_page(t: RetailTables) -> DataFrame:
    """The page in the middle of all sales: found by the counts of sorted ranges."""
    hits = search.sort_hits(_sales(t), work_path(t.spark, "tables", "sorted_sales"), ranges=32)
    return hits.page(sum(n for _, n in hits.counts) // 2, 20)
