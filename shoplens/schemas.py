"""Entity schemas and topic names.

value that arrives as JSON text is declared STRING first and cast later with
``try_cast`` so that quoted numbers from the change feed are kept.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Topic and index names the pipeline routes to.
REJECTED_TOPIC = "REJECTED_LINES"
STARTUP_TOPIC = "gmall_start"
EVENT_TOPIC = "gmall_event"
ORDER_INFO_TOPIC = "gmall_order_info"
ORDER_DETAIL_TOPIC = "gmall_order_detail"
USER_INFO_TOPIC = "gmall_user_info"
COUPON_ALERT_INDEX = "gmall_coupon_alert"

# Event ids used by the coupon alert.
COUPON_EVENT = "coupon"
CLICK_EVENT = "clickItem"


def _strings(*names: str) -> list[T.StructField]:
    return [T.StructField(n, T.StringType()) for n in names]


STARTUP_LOG = T.StructType(
    _strings("mid", "uid", "appid", "area", "os", "ch", "type", "vs")
    + [T.StructField("ts", T.LongType())]
)

EVENT_LOG = T.StructType(
    _strings("mid", "uid", "appid", "area", "os", "type", "evid", "pgid", "npgid", "itemid")
    + [T.StructField("ts", T.LongType())]
)

# All order columns as text: the change feed quotes numbers, and from_json with
# DOUBLE would turn "12.5" into NULL. total_amount is cast after parsing.
ORDER_INFO_TEXT = T.StructType(
    _strings(
        "id", "province_id", "consignee", "order_comment", "consignee_tel",
        "order_status", "payment_way", "user_id", "img_url", "total_amount",
        "expire_time", "delivery_address", "create_time", "operate_time",
        "tracking_no", "parent_order_id", "out_trade_no", "trade_body",
    )
)

ORDER_INFO_COLUMNS = [
    "id", "province_id", "consignee", "order_comment", "consignee_tel",
    "order_status", "payment_way", "user_id", "img_url", "total_amount",
    "expire_time", "delivery_address", "create_time", "operate_time",
    "tracking_no", "parent_order_id", "out_trade_no", "trade_body",
    "create_date", "create_hour",
]

ORDER_DETAIL = T.StructType(
    _strings("id", "order_id", "sku_name", "sku_id", "order_price", "img_url", "sku_num")
)

USER_INFO = T.StructType(_strings("id", "login_name", "user_level", "birthday", "gender"))

SALE_DETAIL_COLUMNS = [
    "order_detail_id", "order_id", "order_status", "create_time", "user_id",
    "sku_id", "user_gender", "user_age", "user_level", "sku_price", "sku_name", "dt",
]

# Change-feed envelope: one entry holds a list of rows, each a list of
# (column name, after-image value) pairs; all values are text.
CHANGE_COLUMN = T.StructType([T.StructField("name", T.StringType()),
                              T.StructField("value", T.StringType())])
CHANGE_ENVELOPE = T.StructType([
    T.StructField("entry_type", T.StringType()),
    T.StructField("table", T.StringType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("row_datas", T.ArrayType(T.ArrayType(CHANGE_COLUMN))),
    T.StructField("seq", T.LongType()),
    T.StructField("ingest_ts", T.TimestampType()),
])
