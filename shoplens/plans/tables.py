"""The pipeline's tables, derived lazily from one fixture folder.

Each property returns a DataFrame *plan*; nothing runs until a query acts on
it. Queries that need the same intermediate share the plan, and Spark's
exchange reuse removes duplicate shuffles inside one query.
"""

from __future__ import annotations

import datetime as dt
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplens import schemas
from shoplens.operators import clean, dedup, ingest
from shoplens.operators.keyed import latest_per_key
from shoplens.sources import changefeed, fixtures


def _days(col: str, days: tuple[str, ...]) -> Column:
    """Range on a raw time column that covers the days."""
    after = (dt.date.fromisoformat(max(days)) + dt.timedelta(days=1)).isoformat()
    return (F.col(col) >= F.lit(min(days)).cast("timestamp_ntz")) & (F.col(col) < F.lit(after).cast("timestamp_ntz"))


class RetailTables:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def raw(self, name: str) -> DataFrame:
        return fixtures.read_table(self.spark, self.sf_dir, name)

    # --- app logs ---------------------------------------------------------
    @cached_property
    def startup_logs(self) -> DataFrame:
        return clean.with_log_time(fixtures.startup_logs(self.raw("events")))

    @cached_property
    def event_logs(self) -> DataFrame:
        return clean.with_log_time(fixtures.event_logs(self.raw("events")))

    @cached_property
    def raw_log_lines(self) -> DataFrame:
        return fixtures.raw_log_lines(self.raw("events"))

    @cached_property
    def dau(self) -> DataFrame:
        return dedup.first_visit_per_day(self.startup_logs)

    # --- database rows ----------------------------------------------------
    @cached_property
    def orders_text(self) -> DataFrame:
        """order_info text rows plus ``ingest_ts`` (arrival = creation time)."""
        return fixtures.order_info_text(self.raw("orders"), self.raw("customer"))

    @cached_property
    def orders(self) -> DataFrame:
        """Clean order rows with ``ingest_ts`` = creation time (arrival)."""
        return clean.clean_orders(self.orders_text)

    @cached_property
    def bare_orders(self) -> DataFrame:
        """Clean order rows without their customer's columns: one scan."""
        return clean.clean_orders(fixtures.order_info_text(self.raw("orders"), None))

    def orders_of(self, *days: str) -> DataFrame:
        """``bare_orders`` of these days; the range reaches the scan."""
        rows = self.raw("orders").where(_days("o_orderdate", days))
        return clean.clean_orders(fixtures.order_info_text(rows, None))

    def dau_of(self, *days: str) -> DataFrame:
        """The DAU rows of these days; the range reaches the scan."""
        logs = fixtures.startup_logs(self.raw("events").where(_days("ts", days)))
        return dedup.first_visit_per_day(clean.with_log_time(logs))

    @cached_property
    def details(self) -> DataFrame:
        """order_detail rows with ``ingest_ts`` (arrival time)."""
        return fixtures.order_detail_text(self.raw("lineitem"), self.raw("orders"), self.raw("part"))

    @cached_property
    def users_text(self) -> DataFrame:
        return fixtures.user_info_text(self.raw("customer"))

    @cached_property
    def envelopes(self) -> DataFrame:
        return changefeed.fixture_envelopes(self.orders_text, self.details, self.users_text)

    @cached_property
    def routed_changes(self) -> DataFrame:
        return ingest.route_changes(self.envelopes)

    def topic(self, name: str) -> DataFrame:
        """Messages of one topic: the routed change feed of the table that
        feeds it (same rows as filtering the full feed, smaller plan)."""
        envelopes = {
            schemas.ORDER_INFO_TOPIC: lambda: changefeed.table_envelopes(
                changefeed.keyed_orders(self.orders_text), "order_info"),
            schemas.ORDER_DETAIL_TOPIC: lambda: changefeed.table_envelopes(
                changefeed.keyed_details(self.details), "order_detail"),
            schemas.USER_INFO_TOPIC: lambda: changefeed.table_envelopes(
                changefeed.keyed_users(self.users_text), "user_info"),
        }[name]()
        routed = ingest.route_changes(envelopes)
        return routed.where(F.col("topic") == name).drop("topic")

    @cached_property
    def users(self) -> DataFrame:
        """Latest user row per id from the user topic (inserts and updates)."""
        parsed = clean.parse_users(self.topic(schemas.USER_INFO_TOPIC))
        return latest_per_key(parsed.drop("ingest_ts", "key"), ["id"], ["seq"]).drop("seq")
