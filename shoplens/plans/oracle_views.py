"""DuckDB SQL for the entity views, used by the oracle queries.

These restate the fixture formulas of FIXTURES.md part B in plain SQL over
the driver's tables, independently of the Spark code, so the oracle checks
the Spark derivation too.
"""

from __future__ import annotations

CTES: dict[str, str] = {}

CTES["ev"] = """
  SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events
"""

CTES["startup_log"] = """
  SELECT 'mid_' || CAST(user_id AS VARCHAR) AS mid,
         CAST(user_id AS VARCHAR) AS uid,
         'shop' AS appid,
         'area_' || CAST(k % 10 AS VARCHAR) AS area,
         CASE WHEN k % 10 < 3 THEN 'ios' ELSE 'android' END AS os,
         CASE WHEN k % 10 < 3 THEN 'appstore' ELSE 'channel_' || CAST(k % 7 AS VARCHAR) END AS ch,
         'startup' AS type,
         '1.' || CAST(k % 4 AS VARCHAR) AS vs,
         epoch_us(ts) // 1000 AS ts,
         strftime(ts, '%Y-%m-%d') AS log_date,
         strftime(ts, '%H') AS log_hour
  FROM ev WHERE event_type = 'signup'
"""

CTES["event_log"] = """
  SELECT 'mid_' || CAST(k % 20 AS VARCHAR) AS mid,
         CAST(user_id AS VARCHAR) AS uid,
         'shop' AS appid,
         'area_' || CAST(k % 10 AS VARCHAR) AS area,
         CASE WHEN k % 10 < 3 THEN 'ios' ELSE 'android' END AS os,
         'event' AS type,
         CASE event_type WHEN 'purchase' THEN 'coupon' WHEN 'click' THEN 'clickItem'
                         WHEN 'view' THEN 'addCart' WHEN 'error' THEN 'addComment' END AS evid,
         CAST(k % 50 + 1 AS VARCHAR) AS pgid,
         CAST((k + event_id) % 50 + 1 AS VARCHAR) AS npgid,
         CAST(event_id % 50 AS VARCHAR) AS itemid,
         epoch_us(ts) // 1000 AS ts,
         strftime(ts, '%Y-%m-%d') AS log_date,
         strftime(ts, '%H') AS log_hour
  FROM ev WHERE event_type <> 'signup'
"""

CTES["dau"] = """
  SELECT mid, uid, appid, area, os, ch, type, vs, log_date, log_hour, ts FROM (
    SELECT *, row_number() OVER (PARTITION BY log_date, mid ORDER BY ts, uid, appid, area, os, ch, type, vs, log_hour) AS rn
    FROM startup_log) WHERE rn = 1
"""

CTES["orders_text"] = """
  SELECT CAST(o_orderkey AS VARCHAR) AS id,
         CAST(c_nationkey AS VARCHAR) AS province_id,
         c_name AS consignee,
         '1' || lpad(CAST((o_custkey * 7919) % 10000000000 AS VARCHAR), 10, '0') AS consignee_tel,
         o_orderstatus AS order_status,
         CAST(o_custkey AS VARCHAR) AS user_id,
         CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS total_amount,
         strftime(o_orderdate + to_seconds((o_orderkey * 7919) % 86400), '%Y-%m-%d %H:%M:%S') AS create_time,
         o_orderkey AS okey
  FROM orders LEFT JOIN customer ON o_custkey = c_custkey
"""

CTES["order_info"] = """
  SELECT id, province_id, consignee, NULL::VARCHAR AS order_comment,
         left(consignee_tel, 4) || '*******' AS consignee_tel,
         order_status, NULL::VARCHAR AS payment_way, user_id, NULL::VARCHAR AS img_url,
         TRY_CAST(total_amount AS DOUBLE) AS total_amount,
         NULL::VARCHAR AS expire_time, NULL::VARCHAR AS delivery_address, create_time,
         NULL::VARCHAR AS operate_time, NULL::VARCHAR AS tracking_no, NULL::VARCHAR AS parent_order_id,
         NULL::VARCHAR AS out_trade_no, NULL::VARCHAR AS trade_body,
         split_part(create_time, ' ', 1) AS create_date,
         split_part(split_part(create_time, ' ', 2), ':', 1) AS create_hour,
         CAST(create_time AS TIMESTAMP) AS ingest_ts, okey
  FROM orders_text
"""

ORDER_COLUMNS_SQL = ("id, province_id, consignee, order_comment, consignee_tel, order_status, payment_way, "
                     "user_id, img_url, total_amount, expire_time, delivery_address, create_time, operate_time, "
                     "tracking_no, parent_order_id, out_trade_no, trade_body, create_date, create_hour")

CTES["order_detail"] = """
  SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) || '-' || CAST(l_partkey AS VARCHAR)
           || '-' || CAST(l_suppkey AS VARCHAR) || '-' || CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) AS id,
         CAST(l_orderkey AS VARCHAR) AS order_id,
         p_name AS sku_name,
         CAST(l_partkey AS VARCHAR) AS sku_id,
         CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) AS order_price,
         CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) AS sku_num,
         o_orderdate + to_seconds((l_orderkey * 7919) % 86400)
           + to_seconds((((l_orderkey * 31 + l_linenumber * 97 + l_partkey) % 601) - 300) * 2) AS ingest_ts
  FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN part ON l_partkey = p_partkey
"""

CTES["user_info"] = """
  SELECT CAST(c_custkey AS VARCHAR) AS id,
         c_name AS login_name,
         CASE WHEN c_custkey % 10 = 3 THEN '6' ELSE
           CASE c_mktsegment WHEN 'AUTOMOBILE' THEN '1' WHEN 'BUILDING' THEN '2' WHEN 'FURNITURE' THEN '3'
                             WHEN 'HOUSEHOLD' THEN '4' WHEN 'MACHINERY' THEN '5' END END AS user_level,
         strftime(DATE '1955-01-01' + CAST((c_custkey * 7919) % 19000 AS INTEGER), '%Y-%m-%d') AS birthday,
         CASE WHEN c_custkey % 2 = 0 THEN 'M' ELSE 'F' END AS gender
  FROM customer
"""

# Order of definition = dependency order.
_ORDER = list(CTES)


def with_views(body: str, *names: str, extra: dict[str, str] | None = None) -> str:
    """``WITH`` clause holding the named views (and what they depend on),
    followed by ``extra`` query-specific views in the given order."""
    needed: set[str] = set()
    deps = {
        "startup_log": ["ev"], "event_log": ["ev"], "dau": ["startup_log"],
        "order_info": ["orders_text"],
    }

    def add(n: str) -> None:
        if n in needed:
            return
        needed.add(n)
        for d in deps.get(n, []):
            add(d)

    for n in names:
        add(n)
    parts = [f"{n} AS ({CTES[n]})" for n in _ORDER if n in needed]
    parts += [f"{n} AS ({q})" for n, q in (extra or {}).items()]
    if not parts:
        return body
    return "WITH " + ",\n".join(parts) + "\n" + body
