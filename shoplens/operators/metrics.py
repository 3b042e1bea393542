"""Dashboard answers: metric cards, today-vs-yesterday by hour (Q1-Q3).

Each reads the result tables (DAU, order_info) filtered on their date column,
so on a date-partitioned table only one or two partitions are scanned.
Money is summed as DECIMAL(28,4) and returned as DOUBLE: exact for amounts of
up to four decimals and independent of the order in which partial sums are
merged. An amount that is no finite number below 1e24 counts as missing.
"""

from __future__ import annotations

import datetime as _dt
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplens.functions import columns as C
from shoplens.operators.dedup import first_seen_day

# Metric card ids.
CARD_DAU = "dau"
CARD_NEW_MID = "new_mid"
CARD_ORDER_AMOUNT = "order_amount"
# Label of rows without an hour, so that hours always add up to the day.
NO_HOUR = "unknown"

CARD_NAMES = {
    CARD_DAU: "daily active devices",
    CARD_NEW_MID: "new devices",
    CARD_ORDER_AMOUNT: "order amount",
}


def money_sum(c: Column | str) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return F.sum(col.try_cast("decimal(28,4)")).cast("double")


def dau_total(dau: DataFrame, day: str) -> DataFrame:
    """One row (dau): active devices on ``day``; 0 on an empty day."""
    return dau.where(F.col("log_date") == day).agg(F.count(F.lit(1)).alias("dau"))


def dau_hours(dau: DataFrame, day: str) -> DataFrame:
    """(log_hour, dau) for hours with at least one new device."""
    return (dau.where(F.col("log_date") == day).groupBy("log_hour")
            .agg(F.count(F.lit(1)).alias("dau")))


def gmv_total(orders: DataFrame, day: str) -> DataFrame:
    """One row (order_amount): revenue of ``day``; NULL on an empty day."""
    return orders.where(F.col("create_date") == day).agg(money_sum("total_amount").alias("order_amount"))


def gmv_hours(orders: DataFrame, day: str) -> DataFrame:
    """(create_hour, order_amount) per hour of ``day``."""
    return (orders.where(F.col("create_date") == day).groupBy("create_hour")
            .agg(money_sum("total_amount").alias("order_amount")))


def gmv_contribution(orders: DataFrame) -> DataFrame:
    """What an order adds to its hour: amount and count."""
    amount = F.col("total_amount").try_cast("decimal(28,4)")
    return orders.select("create_date", "create_hour", F.coalesce(amount, F.lit(0).cast("decimal(28,4)")).alias("order_amount"),
                         amount.isNotNull().cast("bigint").alias("n_amounts"), F.lit(1).cast("bigint").alias("n_orders"))


def gmv_hours_of_totals(totals: DataFrame, day: str) -> DataFrame:
    """(create_hour, order_amount) as :func:`gmv_hours`, from sums that are kept
    by hour; hours that no order is left in are gone."""
    hours = totals.where((F.col("create_date") == day) & (F.col("n_orders") > 0))
    return hours.select("create_hour", F.when(F.col("n_amounts") > 0, F.col("order_amount")).cast("double").alias("order_amount"))


def new_mid_of_totals(totals: DataFrame, day: str) -> DataFrame:
    """One row (new_mid) as :func:`new_mid_total`, from counts that are kept by day."""
    return totals.where(F.col("log_date") == day).agg(F.coalesce(F.sum("new_mid"), F.lit(0)).cast("bigint").alias("new_mid"))


def new_mid_total(dau: DataFrame, day: str) -> DataFrame:
    """One row (new_mid): devices first seen on ``day`` (the card the
    dashboard shows; the reference fills it with a constant)."""
    return (first_seen_day(dau.where(F.col("log_date") <= day)).where(F.col("first_date") == day)
            .agg(F.count(F.lit(1)).alias("new_mid")))


def realtime_total(dau: DataFrame, orders: DataFrame, day: str | None = None, new_mids: DataFrame | None = None) -> DataFrame:
    """Metric cards (id, name, value) for ``day`` (default today): DAU, new
    devices, revenue. ``new_mids``: counts of new devices that are kept by day
    (log_date, new_mid); with it no history of ``dau`` is read."""
    day = day or today(dau.sparkSession)
    def card(df: DataFrame, card_id: str, value_col: str) -> DataFrame:
        return df.select(F.lit(card_id).alias("id"), F.lit(CARD_NAMES[card_id]).alias("name"),
                         F.col(value_col).cast("double").alias("value"))

    return (card(dau_total(dau, day), CARD_DAU, "dau")
            .unionByName(card(new_mid_total(dau, day) if new_mids is None else new_mid_of_totals(new_mids, day), CARD_NEW_MID, "new_mid"))
            .unionByName(card(gmv_total(orders, day), CARD_ORDER_AMOUNT, "order_amount")))


def _hour_series(df: DataFrame, date_col: str, hour_col: str, value: Column, day: str) -> DataFrame:
    """(day, hour, value) for ``day`` and the day before, one filtered scan."""
    yday = yesterday_of(day)
    return (df.where(F.col(date_col).isin(day, yday))
            .groupBy(F.when(F.col(date_col) == day, F.lit("today")).otherwise(F.lit("yesterday"))
                     .alias("day"), F.coalesce(F.col(hour_col), F.lit(NO_HOUR)).alias("hour"))
            .agg(value.alias("value")))


def today(spark: SparkSession) -> str:
    """Today's date (session time zone) as ``yyyy-MM-dd``: the default day of
    the dashboard when the caller gives none."""
    return _dt.datetime.now(ZoneInfo(spark.conf.get("spark.sql.session.timeZone"))).date().isoformat()


def yesterday_of(day: str) -> str:
    """The day before a ``yyyy-MM-dd`` parameter (a literal, so the date
    filter still prunes partitions)."""
    return (_dt.date.fromisoformat(day) - _dt.timedelta(days=1)).isoformat()


def realtime_hours(metric_id: str, dau: DataFrame, orders: DataFrame, day: str | None = None) -> DataFrame:
    """(day, hour, value) rows for ``day`` (default today) and the day before.

    ``metric_id`` is ``dau`` or ``order_amount``; any other id gives no rows
    (the service answers with two null maps).
    """
    day = day or today(dau.sparkSession)
    if metric_id == CARD_DAU:
        return _hour_series(dau, "log_date", "log_hour", F.count(F.lit(1)).cast("double"), day)
    if metric_id == CARD_ORDER_AMOUNT:
        return _hour_series(orders, "create_date", "create_hour", money_sum("total_amount"), day)
    return dau.sparkSession.createDataFrame([], "day string, hour string, value double")


def _hour_entries(hour: Column, value: Column) -> Column:
    """hour -> value map; a day has its 24 hours and those rows carry."""
    return F.map_from_entries(F.array_sort(F.collect_list(F.when(hour.isNotNull(), F.struct(hour, value)))))


def hours_map(series: DataFrame) -> DataFrame:
    """(day, hours): hour -> value map per day."""
    return series.groupBy("day").agg(_hour_entries(F.col("hour"), F.col("value")).alias("hours"))


def hours_answer(series: DataFrame) -> DataFrame:
    """One row (answer): the service's JSON text
    ``{"yesterday":{"HH":v,...},"today":{"HH":v,...}}``; a day without rows
    has an empty map."""
    def of(day: str) -> Column:
        is_day = F.col("day") == day
        return _hour_entries(F.when(is_day, F.col("hour")).alias("hour"), F.col("value").alias("value")).alias(day)

    return series.agg(of("yesterday"), of("today")).select(F.to_json(F.struct("yesterday", "today")).alias("answer"))


def cards_answer(cards: DataFrame) -> DataFrame:
    """One row (answer): the metric cards as a JSON array of {id, name, value}."""
    return cards.agg(F.to_json(F.array_sort(F.collect_list(F.struct("id", "name", "value")))).alias("answer"))


def hour_spine(spark: SparkSession) -> DataFrame:
    """The 24 hour labels 00..23."""
    return spark.range(24).select(F.lpad(F.col("id").cast("string"), 2, "0").alias("hour"))


def hour_table(series: DataFrame) -> DataFrame:
    """(hour, yesterday, today): the 24 hours, missing ones as 0, and any other
    hour that rows carry, so the columns add up to the day's totals."""
    pivot = series.groupBy("hour").agg(
        F.sum(F.when(F.col("day") == "yesterday", F.col("value"))).alias("yesterday"),
        F.sum(F.when(F.col("day") == "today", F.col("value"))).alias("today"))
    return (hour_spine(series.sparkSession).join(pivot, "hour", "full_outer")
            .select("hour", F.coalesce("yesterday", F.lit(0.0)).alias("yesterday"),
                    F.coalesce("today", F.lit(0.0)).alias("today")))


def daily_series(df: DataFrame, date_col: str, value: Column) -> DataFrame:
    """(day, value) per date present in ``df``."""
    return df.groupBy(F.col(date_col).alias("day")).agg(value.alias("value"))


def day_over_day(daily: DataFrame) -> DataFrame:
    """(day, value, prev_value, pct_change) with the previous calendar day's
    value. A self-join on the shifted date rather than a ``lag`` window, which
    would need all days in one partition."""
    prev = daily.select(F.date_format(F.date_add(F.try_to_date("day", "yyyy-MM-dd"), 1), "yyyy-MM-dd")
                        .alias("day"), F.col("value").alias("prev_value"))
    return (daily.join(prev, "day", "left")
            .select("day", "value", "prev_value",
                    C.pct_change("value", "prev_value").alias("pct_change")))
