"""Daily active devices: keep the first visit of each device per day.

Batch meaning: the earliest startup row per (log_date, mid). The streaming
job reaches the same table batch by batch: earliest row inside the batch,
minus devices already seen that day (anti join against the seen table).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplens.operators.keyed import first_per_key

DAU_KEYS = ("log_date", "mid")
DAU_COLUMNS = ["mid", "uid", "appid", "area", "os", "ch", "type", "vs", "log_date", "log_hour", "ts"]


def first_visit_per_day(startups: DataFrame) -> DataFrame:
    """Earliest startup row per (log_date, mid); equal ``ts`` ties go to the
    smallest remaining columns (uid first), so the answer is stable."""
    rows = startups.select(*DAU_COLUMNS)
    return first_per_key(rows, DAU_KEYS, ["ts", "uid"])


def seen_devices(dau: DataFrame) -> DataFrame:
    """The set of (log_date, mid) already counted: distinct keys."""
    return dau.select(*DAU_KEYS).distinct()


def drop_seen(rows: DataFrame, seen: DataFrame) -> DataFrame:
    """Rows whose device was not yet seen on that day (left anti join)."""
    return rows.join(seen.select(*DAU_KEYS), list(DAU_KEYS), "left_anti")


def dau_increment(batch: DataFrame, seen: DataFrame) -> DataFrame:
    """New DAU rows contributed by one batch of startup logs.

    The earliest row per key is taken first (map-side combined), then the
    seen keys are removed: the same rows as filtering first, but a hot
    device reaches the anti join as one row, not as all of its rows."""
    return drop_seen(first_visit_per_day(batch), seen)


def first_seen_day(dau: DataFrame) -> DataFrame:
    """(mid, first_date): the first day each device was ever active."""
    return dau.groupBy("mid").agg(F.min("log_date").alias("first_date"))


def new_devices(dau: DataFrame) -> DataFrame:
    """(log_date, new_mid): devices whose first active day is that date."""
    return (first_seen_day(dau).groupBy(F.col("first_date").alias("log_date"))
            .agg(F.count(F.lit(1)).alias("new_mid")))


FIRST_DAY = "mid string, log_date string"


def new_mid_contribution(first_days: DataFrame) -> DataFrame:
    """What a device's first day adds to its day's new devices."""
    return first_days.select("log_date", F.lit(1).cast("bigint").alias("new_mid"))
