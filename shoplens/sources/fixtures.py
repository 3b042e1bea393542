"""Map the driver's star-schema tables onto the pipeline's entities.

The reference reads app logs and database change rows from topics. Here the
same entities are *derived by Spark* from the given parquet tables (formulas
in FIXTURES.md part B), so every downstream query grows with the tables.

All derivations are narrow projections except two equi-joins (orders with
customers, lines with parts and their order's date). Those joins are declared without
hints: Catalyst prunes the columns, pushes filters into the scans, and picks a
broadcast only when the side is under ``spark.sql.autoBroadcastJoinThreshold``
(AQE re-checks with runtime sizes); beyond it, a sort-merge join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Neutral values of the log fixtures: area_<n>, channel_<n>, version 1.<n>.
N_AREAS, N_CHANNELS, N_VERSIONS = 10, 7, 4
APP_ID = "shop"
# Fixture event type -> app event id.
EVENT_IDS = {"purchase": "coupon", "click": "clickItem", "view": "addCart", "error": "addComment"}
# Market segment -> user level.
USER_LEVELS = {"AUTOMOBILE": "1", "BUILDING": "2", "FURNITURE": "3", "HOUSEHOLD": "4", "MACHINERY": "5"}


# Schemas of the driver's tables that the pipeline reads. Giving them up
# front skips schema inference (a footer read per table and query); any
# other table is read with inference.
TABLE_SCHEMAS = {
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
              "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
                "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, "
                "l_linestatus STRING, l_shipdate TIMESTAMP_NTZ",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read
    if name in TABLE_SCHEMAS:
        reader = reader.schema(TABLE_SCHEMAS[name])
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _k(props: str = "props") -> Column:
    return F.get_json_object(F.col(props), "$.k").try_cast("int")


def _epoch_ms(ts: str) -> Column:
    return F.unix_millis(F.col(ts).cast("timestamp"))


def _log_common(k: Column) -> dict[str, Column]:
    is_ios = (k % 10) < 3
    return {
        "appid": F.lit(APP_ID),
        "area": F.concat(F.lit("area_"), (k % N_AREAS).cast("string")),
        "os": F.when(is_ios, F.lit("ios")).otherwise(F.lit("android")),
    }


def startup_logs(events: DataFrame) -> DataFrame:
    """startup_log rows: signup events, one device per user."""
    k = _k()
    common = _log_common(k)
    return events.where(F.col("event_type") == "signup").select(
        F.concat(F.lit("mid_"), F.col("user_id").cast("string")).alias("mid"),
        F.col("user_id").cast("string").alias("uid"),
        common["appid"].alias("appid"),
        common["area"].alias("area"),
        common["os"].alias("os"),
        F.when(common["os"] == "ios", F.lit("appstore")).otherwise(F.concat(F.lit("channel_"), (k % N_CHANNELS).cast("string"))).alias("ch"),
        F.lit("startup").alias("type"),
        F.concat(F.lit("1."), (k % N_VERSIONS).cast("string")).alias("vs"),
        _epoch_ms("ts").alias("ts"),
    )


def event_logs(events: DataFrame) -> DataFrame:
    """event_log rows: every non-signup event on one of 20 shared devices."""
    k = _k()
    common = _log_common(k)
    evid = F.lit(None).cast("string")
    for source, target in EVENT_IDS.items():
        evid = F.when(F.col("event_type") == source, F.lit(target)).otherwise(evid)
    return events.where(F.col("event_type") != "signup").select(
        F.concat(F.lit("mid_"), (k % 20).cast("string")).alias("mid"),
        F.col("user_id").cast("string").alias("uid"),
        common["appid"].alias("appid"),
        common["area"].alias("area"),
        common["os"].alias("os"),
        F.lit("event").alias("type"),
        evid.alias("evid"),
        ((k % 50) + 1).cast("string").alias("pgid"),
        (((k + F.col("event_id")) % 50) + 1).cast("string").alias("npgid"),
        (F.col("event_id") % 50).cast("string").alias("itemid"),
        _epoch_ms("ts").alias("ts"),
    )


def _create_time(orderdate: Column, orderkey: Column) -> Column:
    """Order creation time: order day plus a key-derived second of that day."""
    seconds = F.unix_seconds(orderdate.cast("timestamp")) + (orderkey * 7919) % 86400
    return F.timestamp_seconds(seconds)


def _money_text(c: Column) -> Column:
    return c.cast("decimal(18,2)").cast("string")


def order_info_text(orders: DataFrame, customer: DataFrame | None) -> DataFrame:
    """order_info after-images as the change feed carries them (all text),
    plus ``ingest_ts``: the order's arrival time, equal to its creation time.
    Without ``customer`` the rows lack ``province_id`` and ``consignee``, and
    nothing is joined."""
    o, of_customer = orders, []
    if customer is not None:
        cust = customer.select("c_custkey", "c_name", "c_nationkey")
        o = orders.join(cust, orders.o_custkey == cust.c_custkey, "left")
        of_customer = [F.col("c_nationkey").cast("string").alias("province_id"), F.col("c_name").alias("consignee")]
    o = o.withColumn("_created", _create_time(F.col("o_orderdate"), F.col("o_orderkey")))
    null = F.lit(None).cast("string")
    return o.select(
        F.col("o_orderkey").cast("string").alias("id"),
        *of_customer,
        null.alias("order_comment"),
        F.concat(F.lit("1"), F.lpad(((F.col("o_custkey") * 7919) % 10000000000).cast("string"), 10, "0"))
        .alias("consignee_tel"),
        F.col("o_orderstatus").alias("order_status"),
        null.alias("payment_way"),
        F.col("o_custkey").cast("string").alias("user_id"),
        null.alias("img_url"),
        _money_text(F.col("o_totalprice")).alias("total_amount"),
        null.alias("expire_time"),
        null.alias("delivery_address"),
        F.date_format(F.col("_created"), "yyyy-MM-dd HH:mm:ss").alias("create_time"),
        null.alias("operate_time"),
        null.alias("tracking_no"),
        null.alias("parent_order_id"),
        null.alias("out_trade_no"),
        null.alias("trade_body"),
        F.col("_created").alias("ingest_ts"),
    )


def order_detail_text(lineitem: DataFrame, orders: DataFrame, part: DataFrame) -> DataFrame:
    """order_detail after-images (text) plus ``ingest_ts``, the line's arrival time.

    Arrival = order creation time shifted by a key-derived -600..+600 s, so
    about half of the lines arrive within 300 s of their order. Parts are
    joined first and the order date last, on the *text* order id: the rows
    leave hash-partitioned by ``order_id``, which the order/line joins
    downstream key on, so the line side is not shuffled again.
    """
    o = orders.select(F.col("o_orderkey").cast("string").alias("order_id"), "o_orderdate")
    p = part.select("p_partkey", "p_name")
    li = (lineitem.join(p, lineitem.l_partkey == p.p_partkey, "left")
          .withColumn("order_id", F.col("l_orderkey").cast("string"))
          .join(o, "order_id", "left"))
    shift = ((((F.col("l_orderkey") * 31 + F.col("l_linenumber") * 97 + F.col("l_partkey")) % 601) - 300) * 2)
    arrival = F.timestamp_seconds(
        F.unix_seconds(_create_time(F.col("o_orderdate"), F.col("l_orderkey"))) + shift)
    return li.select(
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"),
                    F.col("l_partkey").cast("string"), F.col("l_suppkey").cast("string"),
                    F.col("l_quantity").cast("int").cast("string")).alias("id"),
        F.col("order_id"),
        F.col("p_name").alias("sku_name"),
        F.col("l_partkey").cast("string").alias("sku_id"),
        _money_text(F.col("l_extendedprice")).alias("order_price"),
        F.lit(None).cast("string").alias("img_url"),
        F.col("l_quantity").cast("int").cast("string").alias("sku_num"),
        arrival.alias("ingest_ts"),
    )


def user_info_text(customer: DataFrame) -> DataFrame:
    """user_info rows from customers (birthday and gender derived from the key)."""
    level = F.lit(None).cast("string")
    for segment, lvl in USER_LEVELS.items():
        level = F.when(F.col("c_mktsegment") == segment, F.lit(lvl)).otherwise(level)
    birthday = F.date_add(F.lit("1955-01-01").cast("date"), ((F.col("c_custkey") * 7919) % 19000).cast("int"))
    return customer.select(
        F.col("c_custkey").cast("string").alias("id"),
        F.col("c_name").alias("login_name"),
        level.alias("user_level"),
        F.date_format(birthday, "yyyy-MM-dd").alias("birthday"),
        F.when(F.col("c_custkey") % 2 == 0, F.lit("M")).otherwise(F.lit("F")).alias("gender"),
    )


def raw_log_lines(events: DataFrame) -> DataFrame:
    """Posted log text (JSON without ``ts``) and the ingest time that the
    logging service stamps on it, for startup and event logs together."""
    starts = startup_logs(events)
    evs = event_logs(events)
    s = starts.select(
        F.to_json(F.struct(*[c for c in starts.columns if c != "ts"])).alias("value"),
        F.col("ts").alias("stamp_ms"))
    e = evs.select(
        F.to_json(F.struct(*[c for c in evs.columns if c != "ts"])).alias("value"),
        F.col("ts").alias("stamp_ms"))
    return s.unionByName(e)
