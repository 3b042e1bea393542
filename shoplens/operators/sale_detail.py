"""Orders joined with their detail lines and users: the sale_detail table (Q7).

The reference caches each side for 300 s in an external store so that a line
arriving up to 300 s before or after its order still meets it. Here that is
an interval equi-join on the order id with the two arrival times at most
``within`` apart; on streams the same condition plus watermarks bounds the
join state (:mod:`shoplens.streaming.jobs`).

Skew: an order id is unique on the order side, so a hot order with many lines
joins 1 x N; AQE's skew handling splits the large detail partition and
copies the single order row. Full and anti joins are arranged so the skewed
(detail) side is always the side Spark can split or pre-aggregate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shoplens import schemas
from shoplens.functions import columns as C

ORDER_FIELDS = ["id", "order_status", "create_time", "user_id", "create_date", "ingest_ts"]
DETAIL_FIELDS = ["id", "order_id", "sku_id", "sku_name", "order_price", "ingest_ts"]


def _orders(orders: DataFrame) -> DataFrame:
    return orders.select(*[F.col(c).alias(f"o_{c}") for c in ORDER_FIELDS])


def _details(details: DataFrame) -> DataFrame:
    return details.select(*[F.col(c).alias(f"d_{c}") for c in DETAIL_FIELDS])


def _merged(o_id: Column | None = None) -> list[Column]:
    """Columns of a sale row from the prefixed order (o_*) and detail (d_*) sides."""
    return [
        F.col("d_id").alias("order_detail_id"),
        (o_id if o_id is not None else F.col("o_id")).alias("order_id"),
        F.col("o_order_status").alias("order_status"),
        F.col("o_create_time").alias("create_time"),
        F.col("o_user_id").alias("user_id"),
        F.col("d_sku_id").alias("sku_id"),
        C.safe_double(F.col("d_order_price")).alias("sku_price"),
        F.col("d_sku_name").alias("sku_name"),
        F.col("o_create_date").alias("dt"),
    ]


def interval_condition(within_seconds: int) -> Column:
    """Detail arrival within ``within_seconds`` of its order's arrival, either side."""
    w = F.expr(f"INTERVAL {int(within_seconds)} SECONDS")
    return ((F.col("d_order_id") == F.col("o_id"))
            & F.col("d_ingest_ts").between(F.col("o_ingest_ts") - w, F.col("o_ingest_ts") + w))


def join_within(orders: DataFrame, details: DataFrame, within_seconds: int = 300, sale_time: bool = False) -> DataFrame:
    """Each (order, detail) pair whose arrivals are at most ``within_seconds``
    apart, once; with ``sale_time`` also ``sale_ts``, the later arrival."""
    more = [F.greatest("o_ingest_ts", "d_ingest_ts").alias("sale_ts")] if sale_time else []
    return _details(details).join(_orders(orders), interval_condition(within_seconds), "inner").select(*_merged(), *more)


def join_full_within(orders: DataFrame, details: DataFrame, within_seconds: int = 300) -> DataFrame:
    """The pairs of :func:`join_within`, the orders without a line within the
    interval (line columns NULL) and the lines without an order within it
    (order columns NULL but for the id). On streams the two outer halves come
    once the watermark shows that no partner can still arrive."""
    joined = _details(details).join(_orders(orders), interval_condition(within_seconds), "full_outer")
    return joined.select(*_merged(F.coalesce("o_id", "d_order_id")))


def join_all(orders: DataFrame, details: DataFrame) -> DataFrame:
    """Full outer join on order id, with no time bound.

    Written as (details LEFT JOIN orders) UNION (orders with no detail): the
    left join lets AQE split a hot order's lines, and the anti join probes
    the *distinct* detail order ids, so a hot id is one row there.
    """
    d, o = _details(details), _orders(orders)
    matched = d.join(o, F.col("d_order_id") == F.col("o_id"), "left").select(
        *_merged(F.coalesce(F.col("o_id"), F.col("d_order_id"))))
    lonely = _orders(unmatched_orders(orders, details)).withColumns(
        {f"d_{c}": F.lit(None).cast("string") for c in DETAIL_FIELDS})
    lonely_rows = lonely.select(*_merged())
    return matched.unionByName(lonely_rows)


def unmatched_orders(orders: DataFrame, details: DataFrame) -> DataFrame:
    """Orders without any detail line."""
    ids = details.select(F.col("order_id").alias("id")).distinct()
    return orders.join(ids, "id", "left_anti")


def unmatched_details(orders: DataFrame, details: DataFrame) -> DataFrame:
    """Detail lines whose order never arrived."""
    return details.join(orders.select(F.col("id").alias("order_id")), "order_id", "left_anti")


def unmatched_orders_within(orders: DataFrame, details: DataFrame, within_seconds: int = 300) -> DataFrame:
    """Orders that met no detail inside the interval (the left-outer half a
    stream emits once the watermark passes the order's time + interval)."""
    hits = _details(details).join(_orders(orders).select("o_id", "o_ingest_ts"), interval_condition(within_seconds),
                                  "inner").select(F.col("o_id").alias("id")).distinct()
    return orders.join(hits, "id", "left_anti")


def orders_without_partner(orders: DataFrame, details: DataFrame, within_seconds: int = 300) -> DataFrame:
    """Orders that met no line within the interval, as the left-outer half of
    the interval join (the form a stream emits once the watermark passes the
    order's arrival + interval). Returns the order's own columns."""
    o = orders.select(*[F.col(c).alias(f"o_{c}") for c in orders.columns])
    d = _details(details).select("d_id", "d_order_id", "d_ingest_ts")
    joined = o.join(d, interval_condition(within_seconds), "left_outer")
    return joined.where(F.col("d_id").isNull()).select(*[F.col(f"o_{c}").alias(c) for c in orders.columns])


def enrich_users(sales: DataFrame, users: DataFrame, as_of: str | Column) -> DataFrame:
    """Add user gender, level and age (whole 365-day years at ``as_of``).

    ``users`` must hold one row per id (see the latest-row upsert). A sale
    without a known user keeps age 0 and NULL gender and level.
    """
    as_of_col = as_of if isinstance(as_of, Column) else F.lit(as_of)
    u = users.select(
        F.col("id").alias("u_id"),
        F.col("gender").alias("user_gender"),
        F.col("user_level"),
        C.age_years(F.col("birthday"), as_of_col).alias("u_age"),
    )
    joined = sales.join(u, F.col("user_id") == F.col("u_id"), "left")
    return joined.withColumn("user_age", F.coalesce(F.col("u_age"), F.lit(0))).select(*schemas.SALE_DETAIL_COLUMNS)


def enrich_users_as_of(sales: DataFrame, versions: DataFrame, as_of: str | Column) -> DataFrame:
    """As :func:`enrich_users`, with the user as it was when the sale happened.

    ``sales`` has ``sale_ts``; ``versions`` holds every change of a user with
    its arrival ``ingest_ts`` and ``seq``. A sale takes the last version that
    had arrived by then; a sale before a user's first version has no user. A
    version is valid until the next one's arrival, so each sale meets one.
    """
    as_of_col = as_of if isinstance(as_of, Column) else F.lit(as_of)
    following = Window.partitionBy("id").orderBy("ingest_ts", "seq")  # a user's own changes
    u = versions.select(F.col("id").alias("u_id"), F.col("gender").alias("user_gender"), "user_level",
                        C.age_years(F.col("birthday"), as_of_col).alias("u_age"), F.col("ingest_ts").alias("u_from"),
                        F.lead("ingest_ts").over(following).alias("u_until"))
    then = (F.col("user_id") == F.col("u_id")) & (F.col("sale_ts") >= F.col("u_from")) & (
        F.col("u_until").isNull() | (F.col("sale_ts") < F.col("u_until")))
    joined = sales.join(u, then, "left")
    return joined.withColumn("user_age", F.coalesce(F.col("u_age"), F.lit(0))).select(*schemas.SALE_DETAIL_COLUMNS)


def build_sale_detail(orders: DataFrame, details: DataFrame, users: DataFrame, as_of: str,
                      within_seconds: int = 300) -> DataFrame:
    return enrich_users(join_within(orders, details, within_seconds), users, as_of)
