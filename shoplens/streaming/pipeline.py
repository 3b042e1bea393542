"""Start the whole pipeline: every job reading its topic, writing its table.

``source(topic)`` returns the streaming DataFrame of one topic — the Kafka
source in production (:func:`kafka_source`), file-backed topics in tests.
Tables and checkpoints live under ``base_path`` (a shared folder on a
cluster, e.g. under ``spark.checkpoint.dir``); one checkpoint per job.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from shoplens import schemas
from shoplens.operators import clean
from shoplens.sources.topics import read_topic
from shoplens.streaming import jobs
from shoplens.streaming.sinks import AppendTable
from shoplens.streaming.snapshots import SnapshotTable

Source = Callable[[str], DataFrame]
#: Rows of the user table: the parsed row and the message's metadata.
USER_VERSIONS = T.StructType([T.StructField("seq", T.LongType()), T.StructField("ingest_ts", T.TimestampType()), *schemas.USER_INFO.fields])


def kafka_source(spark: SparkSession, bootstrap_servers: str) -> Source:
    return lambda topic: read_topic(spark, bootstrap_servers, topic)


@dataclass
class Tables:
    """The pipeline's result tables under one base folder. ``part_chars``: 10
    keeps orders by day, 7 by month (where days hold few rows)."""
    base: str
    part_chars: int = 10

    @property
    def dau(self) -> SnapshotTable:
        return jobs.dau_table(f"{self.base}/tables/dau")

    @property
    def dau_final(self) -> str:
        """Output folder of the closed days' DAU job (parquet file sink)."""
        return f"{self.base}/tables/dau_final"

    @property
    def first_days(self) -> SnapshotTable:
        return jobs.first_day_table(f"{self.base}/tables/first_day")

    @property
    def orders(self) -> SnapshotTable:
        return jobs.order_table(f"{self.base}/tables/order_info", part_chars=self.part_chars)

    @property
    def users(self) -> SnapshotTable:
        return SnapshotTable(f"{self.base}/tables/user_info", USER_VERSIONS, keys=["id"], order_by=["seq"])

    @property
    def alert_documents(self) -> SnapshotTable:
        return jobs.alert_table(f"{self.base}/tables/{schemas.COUPON_ALERT_INDEX}")

    @property
    def sale_detail(self) -> AppendTable:
        return AppendTable(f"{self.base}/tables/sale_detail", partition_by=["dt_month"])

    def checkpoint(self, job: str) -> str:
        return f"{self.base}/checkpoints/{job}"


def user_job(lines: DataFrame, table: SnapshotTable, checkpoint: str, trigger_seconds: int = 5,
             available_now: bool = False) -> StreamingQuery:
    """User change rows (inserts and updates) -> the table of current users."""
    return jobs.table_job(clean.parse_users(lines), table, checkpoint, "users", "stream", trigger_seconds, available_now)


def start_all(spark: SparkSession, source: Source, base: str, as_of: str, available_now: bool = False,
              alert_window: str = "30 seconds", alert_slide: str = "5 seconds",
              alert_watermark: str = "1 minute", join_watermark: str = "10 minutes",
              dau_lateness: str = "1 hour", log_lines: DataFrame | None = None,
              envelopes: DataFrame | None = None, users_as_of_sale: bool = False,
              part_chars: int = 10) -> dict[str, StreamingQuery]:
    """Start the DAU, order, user, alert and sale_detail jobs.

    A sale takes its user from the table of current users when it is processed;
    with ``users_as_of_sale`` from the user versions that had arrived by the
    sale's time, kept in the join job's own state.

    ``log_lines`` (posted log text) and ``envelopes`` (change feed text) also
    start the ingest jobs, which write the topics under ``base``. All topics
    and tables may be empty at the start.
    """
    t = Tables(base, part_chars)
    now = {"available_now": available_now}
    queries = {}
    if log_lines is not None:
        queries["ingest"] = jobs.ingest_job(log_lines, f"{base}/topics/logs", t.checkpoint("ingest"), **now)
    if envelopes is not None:
        queries["changes"] = jobs.change_job(envelopes, f"{base}/topics/changes", t.checkpoint("changes"), **now)
    queries |= {
        "dau": jobs.dau_table_job(source(schemas.STARTUP_TOPIC), t.dau, t.checkpoint("dau"), **now),
        "dau_final": jobs.dau_final_job(source(schemas.STARTUP_TOPIC), t.dau_final, t.checkpoint("dau_final"), dau_lateness, **now),
        "first_days": jobs.first_day_job(source(schemas.STARTUP_TOPIC), t.first_days, t.checkpoint("first_days"), **now),
        "orders": jobs.order_table_job(source(schemas.ORDER_INFO_TOPIC), t.orders, t.checkpoint("orders"), **now),
        "users": user_job(source(schemas.USER_INFO_TOPIC), t.users, t.checkpoint("users"), **now),
        "alerts": jobs.alert_document_job(source(schemas.EVENT_TOPIC), t.alert_documents, t.checkpoint("alerts"),
                                          alert_window, alert_slide, alert_watermark, **now),
    }
    if available_now:  # a drained run: later rows see all users of this run
        queries["users"].awaitTermination()
    orders, details = source(schemas.ORDER_INFO_TOPIC), source(schemas.ORDER_DETAIL_TOPIC)
    if users_as_of_sale:
        queries["sale_detail"] = jobs.sale_detail_as_of_job(
            orders, details, source(schemas.USER_INFO_TOPIC), t.sale_detail, t.checkpoint("sale_detail"), as_of, watermark=join_watermark, **now)
    else:
        queries["sale_detail"] = jobs.sale_detail_job(
            orders, details, lambda: t.users.read(spark), t.sale_detail, t.checkpoint("sale_detail"), as_of, watermark=join_watermark, **now)
    return queries
