"""Structured Streaming jobs: ``readStream`` -> the batch transforms -> sink.

Every job uses the same DataFrame functions as the batch queries. State and
offsets live in the query's checkpoint folder (one per job, under the shared
``spark.checkpoint.dir``), and every sink is replay-safe, so a restarted job
or a lost executor re-runs a micro-batch without double-writing.

Triggers default to the reference's cadence (5 s; 3 s for the join job);
``available_now=True`` drains the input and stops, for replays and tests.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from shoplens import schemas
from shoplens.functions import columns as C
from shoplens.operators import alerts, clean, dedup, ingest, metrics, sale_detail
from shoplens.session import setting, state_partitions
from shoplens.sources import changefeed
from shoplens.streaming import users as user_state
from shoplens.streaming.sinks import AppendTable, LogTable
from shoplens.streaming.snapshots import SnapshotTable, Totals

DAU_SCHEMA = T.StructType([T.StructField(c, T.LongType() if c == "ts" else T.StringType()) for c in dedup.DAU_COLUMNS])
ORDER_SCHEMA = T.StructType([*[T.StructField(c, T.DoubleType() if c == "total_amount" else T.StringType()) for c in schemas.ORDER_INFO_COLUMNS],
                             T.StructField("seq", T.LongType())])
ALERT_COUNT = ("mid string, window_start bigint, window_end bigint, n_users int, has_veto boolean, n_events bigint, "
               "event_counts array<struct<evid: string, n: bigint>>, ts bigint")
ALERT_DOCUMENT = "doc_id string, " + ALERT_COUNT.replace("has_veto boolean, ", "") + ", uids array<string>, item_ids array<string>"
#: Micro-batches whose state files a checkpoint keeps. Spark's default of 100 holds
#: every row that passed through the state in that time; a restart needs the last.
KEPT_BATCHES = "spark.sql.streaming.minBatchesToRetain"
CODEC = "spark.sql.parquet.compression.codec"


def read_or_empty(spark, schema: str, path: str) -> DataFrame:
    """A parquet table that no job may have written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], schema)


def _start(writer, checkpoint: str, trigger_seconds: int, available_now: bool, name: str) -> StreamingQuery:
    writer = writer.option("checkpointLocation", checkpoint).queryName(name)
    if available_now:
        writer = writer.trigger(availableNow=True)
    else:
        writer = writer.trigger(processingTime=f"{trigger_seconds} seconds")
    spark = SparkSession.active()
    kept, codec = spark.conf.get(KEPT_BATCHES), spark.conf.get(CODEC)
    with (setting(spark, "spark.sql.shuffle.partitions", str(state_partitions(spark))),
          setting(spark, KEPT_BATCHES, "4" if kept == "100" else kept),  # an owner's choice stays
          setting(spark, CODEC, "zstd" if codec == "snappy" else codec)):
        return writer.start()


def table_job(rows: DataFrame, table: SnapshotTable, checkpoint: str, name: str, writer: str = "stream",
              trigger_seconds: int = 5, available_now: bool = False) -> StreamingQuery:
    """A stream of rows -> a keyed table, merged on write. A micro-batch that
    is replayed is left out; ``writer`` names the stream for that."""
    def each(batch: DataFrame, batch_id: int) -> None:
        table.write_batch(batch, batch_id, writer)

    return _start(rows.writeStream.outputMode("append").foreachBatch(each), checkpoint, trigger_seconds, available_now, name)


# --- ingest -----------------------------------------------------------------

def ingest_job(lines: DataFrame, path: str, checkpoint: str, stamp_ms: Column | str | None = None,
               trigger_seconds: int = 5, available_now: bool = False) -> StreamingQuery:
    """Posted log lines -> stamped messages, one folder per topic (malformed
    lines in the rejected topic) and, below it, per day: topic and day-rolled
    archive in one exactly-once write. ``stamp_ms``: default the present."""
    stamped = ingest.route_logs(ingest.stamp_log(lines, ingest.now_ms() if stamp_ms is None else stamp_ms))
    out = stamped.select("topic", C.log_date("ts").alias("log_date"), "value", F.lit(None).cast("bigint").alias("seq"),
                         F.timestamp_millis("ts").alias("ingest_ts"))
    writer = out.writeStream.format("parquet").option("path", path).partitionBy("topic", "log_date").outputMode("append")
    return _start(writer, checkpoint, trigger_seconds, available_now, "ingest")


def change_job(lines: DataFrame, path: str, checkpoint: str,
               trigger_seconds: int = 5, available_now: bool = False) -> StreamingQuery:
    """Change envelopes (JSON text) -> keyed messages, one folder per topic."""
    routed = ingest.route_changes(changefeed.parse_envelopes(lines.select("value")))
    writer = routed.writeStream.format("parquet").option("path", path).partitionBy("topic").outputMode("append")
    return _start(writer, checkpoint, trigger_seconds, available_now, "changes")


# --- daily active devices ---------------------------------------------------

def first_visits(lines: DataFrame, lateness: str) -> DataFrame:
    """Startup lines -> the earliest row per (day, device), as a windowed
    ``min`` in the state store.

    The 1-day window only bounds the state: it lets the watermark drop days
    that are over. The day itself is ``log_date`` in the session's time zone,
    so a day that spans two windows may give a device two rows, of which the
    reader takes the earliest (:func:`read_dau`). Rows later than ``lateness``
    are dropped by the watermark and counted (:func:`late_rows_dropped`);
    ``dau_rows`` observes the rows that come out of each micro-batch.
    """
    rows = clean.parse_startup(lines).select(*dedup.DAU_COLUMNS)
    rows = rows.withColumn("event_time", F.timestamp_millis("ts")).withWatermark("event_time", lateness)
    rest = [c for c in dedup.DAU_COLUMNS if c not in ("ts", "uid", *dedup.DAU_KEYS)]
    first = F.min(F.struct("ts", "uid", *rest)).alias("_row")
    firsts = rows.groupBy(F.window("event_time", "1 day"), *dedup.DAU_KEYS).agg(first)
    return firsts.select(*dedup.DAU_KEYS, "_row.*").select(*dedup.DAU_COLUMNS).observe("dau_rows", F.count(F.lit(1)).alias("rows"))


def dau_job(lines: DataFrame, table: AppendTable, checkpoint: str, lateness: str = "1 hour",
            trigger_seconds: int = 5, available_now: bool = False) -> StreamingQuery:
    """Startup lines -> first visits, written as they change (update mode), so
    the current day can be read at any time. A batch costs its own rows: the
    table is never read or listed here."""
    def each(batch: DataFrame, batch_id: int) -> None:
        table.write_batch(batch, batch_id)

    writer = first_visits(lines, lateness).writeStream.outputMode("update").foreachBatch(each)
    return _start(writer, checkpoint, trigger_seconds, available_now, "dau")


def dau_final_job(lines: DataFrame, path: str, checkpoint: str, lateness: str = "1 hour",
                  trigger_seconds: int = 5, available_now: bool = False) -> StreamingQuery:
    """Startup lines -> first visits of days that are over (append mode), once
    each, through the file sink's commit log."""
    writer = (first_visits(lines, lateness).writeStream.format("parquet").option("path", path)
              .partitionBy("log_date").outputMode("append"))
    return _start(writer, checkpoint, trigger_seconds, available_now, "dau_final")


def dau_once_job(lines: DataFrame, path: str, checkpoint: str, within: str = "25 hours",
                 trigger_seconds: int = 5, available_now: bool = False) -> StreamingQuery:
    """Startup lines -> one row per (day, device), written at first sight.

    ``dropDuplicatesWithinWatermark`` remembers a device until ``within`` after
    its event time; a day's rows lie less than a day apart, so with 25 hours
    none is written twice, and the table needs no resolving. Rows more than
    ``within`` late are dropped (:func:`dau_table_job` keeps them). Of rows in
    one micro-batch any may be the one that is kept."""
    rows = clean.parse_startup(lines).select(*dedup.DAU_COLUMNS)
    rows = rows.withColumn("event_time", F.timestamp_millis("ts")).withWatermark("event_time", within)
    once = rows.dropDuplicatesWithinWatermark(list(dedup.DAU_KEYS)).select(*dedup.DAU_COLUMNS)
    writer = once.writeStream.format("parquet").option("path", path).partitionBy("log_date").outputMode("append")
    return _start(writer, checkpoint, trigger_seconds, available_now, "dau_once")


def dau_table(path: str, merge_every: int = 12) -> SnapshotTable:
    """The first visit of each device and day, by day."""
    return SnapshotTable(path, DAU_SCHEMA, keys=list(dedup.DAU_KEYS), order_by=["ts", "uid"], part="log_date",
                         merge_every=merge_every, first=True)


def dau_table_job(lines: DataFrame, table: SnapshotTable, checkpoint: str, writer: str = "stream",
                  trigger_seconds: int = 5, available_now: bool = False) -> StreamingQuery:
    """Startup lines -> the keyed DAU table. No row is too late: there is no
    watermark and no state, a late row goes to its own day, and a merge rewrites
    the days that got rows. A batch is reduced to its first visits first."""
    rows = clean.parse_startup(lines).select(*dedup.DAU_COLUMNS).where(F.col("log_date").isNotNull())

    def each(batch: DataFrame, batch_id: int) -> None:
        table.write_batch(dedup.first_visit_per_day(batch), batch_id, writer)

    return _start(rows.writeStream.outputMode("append").foreachBatch(each), checkpoint, trigger_seconds, available_now, "dau_table")


def first_day_table(path: str, buckets: int = 16) -> SnapshotTable:
    """The first active day of each device, with the new devices of each day."""
    return SnapshotTable(path, T.StructType.fromDDL(dedup.FIRST_DAY), keys=["mid"], order_by=["log_date"], buckets=buckets, first=True,
                         totals={"new_mid": Totals(["log_date"], ["new_mid"], dedup.new_mid_contribution)})


def first_day_job(lines: DataFrame, table: SnapshotTable, checkpoint: str, writer: str = "stream",
                  trigger_seconds: int = 60, available_now: bool = False) -> StreamingQuery:
    """Startup lines -> the first-day table. A row of an earlier day that comes
    later moves its device: one new device less on the old day, one more on the
    new one."""
    rows = clean.parse_startup(lines).select("mid", "log_date").where(F.col("log_date").isNotNull())

    def each(batch: DataFrame, batch_id: int) -> None:
        table.write_batch(dedup.first_seen_day(batch).select("mid", F.col("first_date").alias("log_date")), batch_id, writer)

    return _start(rows.writeStream.outputMode("append").foreachBatch(each), checkpoint, trigger_seconds, available_now, "first_day")


def read_dau(versions: DataFrame) -> DataFrame:
    """The DAU table from what either job wrote: the earliest row per key."""
    return dedup.first_visit_per_day(versions)


def read_dau_final(spark, path: str) -> DataFrame:
    """The final job's table, with ``log_date`` kept as text."""
    schema = ", ".join(f"{c} {'bigint' if c == 'ts' else 'string'}" for c in dedup.DAU_COLUMNS)
    return read_dau(spark.read.schema(schema).parquet(path).select(*dedup.DAU_COLUMNS))


# --- order table ------------------------------------------------------------

def order_job(lines: DataFrame, table: LogTable, checkpoint: str,
              trigger_seconds: int = 5, available_now: bool = False) -> StreamingQuery:
    """Order lines -> cleaned order versions appended through the file sink;
    readers take the latest version per id (upsert meaning)."""
    return _start(table.writer(clean.parse_orders(lines)), checkpoint, trigger_seconds, available_now, "orders")


def order_table(path: str, merge_every: int = 12, part_chars: int = 10) -> SnapshotTable:
    """The latest version of each order, by day of creation (7 characters: by
    month), with revenue by hour."""
    return SnapshotTable(path, ORDER_SCHEMA, keys=["id"], order_by=["seq"], part="create_date", part_chars=part_chars, merge_every=merge_every,
                         totals={"hours": Totals(["create_date", "create_hour"], ["order_amount", "n_amounts", "n_orders"],
                                                 metrics.gmv_contribution)})


def order_table_job(lines: DataFrame, table: SnapshotTable, checkpoint: str, writer: str = "stream",
                    trigger_seconds: int = 5, available_now: bool = False) -> StreamingQuery:
    """Order lines -> the keyed order table."""
    return table_job(clean.parse_orders(lines), table, checkpoint, "order_table", writer, trigger_seconds, available_now)


# --- coupon alerts ----------------------------------------------------------

def alert_count_job(lines: DataFrame, path: str, checkpoint: str, window: str = "30 seconds",
                    slide: str = "5 seconds", watermark: str = "1 minute",
                    coupon_event: str = schemas.COUPON_EVENT, veto_event: str = schemas.CLICK_EVENT,
                    trigger_seconds: int = 5, available_now: bool = False) -> StreamingQuery:
    """Event lines -> final counts per (window, device), appended once.

    The batch form's three aggregations chained on event time (append mode);
    no group holds a device's users. A window is written once the watermark
    passes its end. All windows are written, so a reader may ask for any
    ``min_users``.
    """
    events = alerts.with_event_time(clean.parse_event(lines)).withWatermark("event_time", watermark)
    # the windows after the first are tumbling ones of the slide's length: [end - slide, end)
    ends = lambda w: F.window(F.window_time(w), slide).alias("w_end")
    by_event = alerts.per_user(events, window, slide).groupBy(ends("window"), "mid", "evid").agg(*alerts.event_totals())
    g = by_event.groupBy(ends("w_end"), "mid").agg(*alerts.window_totals(coupon_event, veto_event))
    length_ms = alerts.interval_ms(window)
    end_ms = F.unix_millis(F.col("w_end.end"))
    out = g.select("mid", (end_ms - length_ms).alias("window_start"), end_ms.alias("window_end"),
                   "n_users", "has_veto", "n_events", "event_counts", end_ms.alias("ts"))
    writer = out.writeStream.format("parquet").option("path", path).outputMode("append")
    return _start(writer, checkpoint, trigger_seconds, available_now, "alert_counts")


def alert_table(path: str, buckets: int = 16, merge_every: int = 1) -> SnapshotTable:
    """Alert documents, one per device and minute of the alert time."""
    return SnapshotTable(path, T.StructType.fromDDL(ALERT_DOCUMENT), keys=["doc_id"], order_by=["ts", "window_start"], buckets=buckets,
                         merge_every=merge_every)


def alert_document_job(lines: DataFrame, table: SnapshotTable, checkpoint: str, window: str = "30 seconds",
                       slide: str = "5 seconds", watermark: str = "1 minute", coupon_event: str = schemas.COUPON_EVENT,
                       veto_event: str = schemas.CLICK_EVENT, min_users: int = 3, writer: str = "stream",
                       trigger_seconds: int = 5, available_now: bool = False) -> StreamingQuery:
    """Event lines -> alert documents with their users and items, one per device
    and minute (last write wins).

    The aggregations of :func:`alert_count_job`, which also carry the coupon
    users and their items up; the state of a window holds what its document
    would. Vetoed and small windows end here, and the rest is merged into the
    table, so its readers resolve nothing."""
    events = alerts.with_event_time(clean.parse_event(lines)).withWatermark("event_time", watermark)
    ends = lambda w: F.window(F.window_time(w), slide).alias("w_end")
    by_user = alerts.per_user(events, window, slide, alerts.claimed_items(coupon_event))
    by_event = by_user.groupBy(ends("window"), "mid", "evid").agg(*alerts.event_totals(), alerts.claiming_users(coupon_event))
    g = by_event.groupBy(ends("w_end"), "mid").agg(*alerts.window_totals(coupon_event, veto_event),
                                                   F.flatten(F.collect_list("members")).alias("members"))
    length_ms = alerts.interval_ms(window)
    end_ms = F.unix_millis(F.col("w_end.end"))
    windows = g.select("mid", (end_ms - length_ms).alias("window_start"), end_ms.alias("window_end"), "n_users", "has_veto",
                       "n_events", "event_counts", *alerts.member_sets(), end_ms.alias("ts"))
    documents = alerts.with_doc_id(alerts.coupon_alerts(windows, min_users))
    return table_job(documents, table, checkpoint, "alert_documents", writer, trigger_seconds, available_now)


CLAIM_SCHEMA = "mid string, uid string, evid string, itemid string, ts bigint, log_date string"


def claim_job(lines: DataFrame, path: str, checkpoint: str, coupon_event: str = schemas.COUPON_EVENT,
              trigger_seconds: int = 5, available_now: bool = False) -> StreamingQuery:
    """Event lines -> the coupon claims, appended by day: the members of alerts."""
    claims = clean.parse_event(lines).where(F.col("evid") == coupon_event)
    writer = (claims.select("mid", "uid", "evid", "itemid", "ts", "log_date").writeStream.format("parquet")
              .option("path", path).partitionBy("log_date").outputMode("append"))
    return _start(writer, checkpoint, trigger_seconds, available_now, "claims")


def read_alerts(spark, counts_path: str, claims_path: str, window: str = "30 seconds", slide: str = "5 seconds",
                coupon_event: str = schemas.COUPON_EVENT, min_users: int = 3) -> DataFrame:
    """The alerts, at most one per device and minute (latest wins), with their
    users and items. ``window``, ``slide`` and ``coupon_event`` as in the jobs.
    Tables that hold nothing yet give no alerts. :func:`alert_document_job`
    keeps the documents themselves; this reader is for other ``min_users``."""
    found = alerts.coupon_alerts(read_or_empty(spark, ALERT_COUNT, counts_path), min_users)
    claims = alerts.with_event_time(read_or_empty(spark, CLAIM_SCHEMA, claims_path))
    return alerts.latest_per_document(alerts.with_members(found, claims, window, slide, coupon_event))


# --- orders x details ---------------------------------------------------------

def interval_join_job(order_lines: DataFrame, detail_lines: DataFrame, path: str, checkpoint: str,
                      within_seconds: int = 300, watermark: str = "10 minutes", trigger_seconds: int = 3,
                      available_now: bool = False) -> StreamingQuery:
    """Order and detail streams -> matched pairs appended to parquet at ``path``.

    Stream-stream inner join on order id with arrivals at most
    ``within_seconds`` apart; both sides carry a watermark on their arrival
    time, so Spark drops join state once no partner can still arrive. Each
    pair is emitted once, exactly-once through the sink's commit log.
    """
    writer = _pairs(order_lines, detail_lines, within_seconds, watermark).writeStream.format("parquet").option("path", path)
    return _start(writer.outputMode("append"), checkpoint, trigger_seconds, available_now, "order_detail_join")


def _pairs(order_lines: DataFrame, detail_lines: DataFrame, within_seconds: int, watermark: str, sale_time: bool = False) -> DataFrame:
    orders = clean.parse_orders(order_lines).withWatermark("ingest_ts", watermark)
    details = clean.parse_details(detail_lines).withWatermark("ingest_ts", watermark)
    return sale_detail.join_within(orders, details, within_seconds, sale_time)


def full_outer_job(order_lines: DataFrame, detail_lines: DataFrame, path: str, checkpoint: str, within_seconds: int = 300,
                   watermark: str = "10 minutes", trigger_seconds: int = 3, available_now: bool = False) -> StreamingQuery:
    """Pairs, orders without a line and lines without an order, each once.

    Stream-stream full outer join: pairs come at once, and either side's lonely
    rows leave the state with NULLs for the other side once the watermark shows
    that no partner within ``within_seconds`` can still arrive."""
    orders = clean.parse_orders(order_lines).withWatermark("ingest_ts", watermark)
    details = clean.parse_details(detail_lines).withWatermark("ingest_ts", watermark)
    writer = sale_detail.join_full_within(orders, details, within_seconds).writeStream.format("parquet").option("path", path)
    return _start(writer.outputMode("append"), checkpoint, trigger_seconds, available_now, "order_detail_full_outer")


def sale_detail_as_of_job(order_lines: DataFrame, detail_lines: DataFrame, user_lines: DataFrame, table: AppendTable, checkpoint: str,
                          as_of: str, within_seconds: int = 300, watermark: str = "10 minutes", keep_seconds: int = 86_400,
                          trigger_seconds: int = 3, available_now: bool = False) -> StreamingQuery:
    """The sale_detail job fed by the user topic itself: each pair takes the
    user as of the sale from the state store (:mod:`shoplens.streaming.users`),
    so a micro-batch reads no user table."""
    pairs = _pairs(order_lines, detail_lines, within_seconds, watermark, sale_time=True)
    rows = user_state.enrich_stream(pairs, clean.parse_users(user_lines), as_of, keep_seconds)

    def each(batch: DataFrame, batch_id: int) -> None:
        table.write_batch(batch.withColumn("dt_month", F.substring("dt", 1, 7)), batch_id)

    with user_state.rocksdb(rows.sparkSession):
        return _start(rows.writeStream.outputMode("append").foreachBatch(each), checkpoint, trigger_seconds, available_now, "sale_detail")


def sale_detail_job(order_lines: DataFrame, detail_lines: DataFrame, users: Callable[[], DataFrame], table: AppendTable,
                    checkpoint: str, as_of: str, within_seconds: int = 300, watermark: str = "10 minutes",
                    trigger_seconds: int = 3, available_now: bool = False) -> StreamingQuery:
    """The sale_detail job: interval-joined pairs with user fields.

    ``users()`` gives the user table (one row per id) and is called for each
    micro-batch, so a user inserted or updated after the start is used by
    later rows. The index is partitioned by month: a day's search reads one
    month folder (days are sparse; a folder per day would leave many tiny
    files). A replayed batch overwrites its own rows."""
    def each(batch: DataFrame, batch_id: int) -> None:
        rows = sale_detail.enrich_users(batch, users(), as_of)
        table.write_batch(rows.withColumn("dt_month", F.substring("dt", 1, 7)), batch_id)

    writer = _pairs(order_lines, detail_lines, within_seconds, watermark).writeStream.outputMode("append").foreachBatch(each)
    return _start(writer, checkpoint, trigger_seconds, available_now, "sale_detail")


def observed_rows(query: StreamingQuery, name: str = "dau_rows") -> list[int]:
    """Per-batch values of an observed row count, from the query progress."""
    out = []
    for p in query.recentProgress:
        metrics = (p.observedMetrics or {}).get(name) if hasattr(p, "observedMetrics") else None
        if metrics is not None:
            out.append(int(metrics["rows"]))
    return out



def late_rows_dropped(query: StreamingQuery) -> int:
    """Rows dropped because they arrived behind the watermark, summed over
    the stateful operators of the recent progress reports."""
    total = 0
    for p in query.recentProgress:
        for op in p.stateOperators or []:
            total += int(getattr(op, "numRowsDroppedByWatermark", 0) or 0)
    return total


def unmatched_orders_job(order_lines: DataFrame, detail_lines: DataFrame, path: str, checkpoint: str,
                         within_seconds: int = 300, watermark: str = "10 minutes", trigger_seconds: int = 3,
                         available_now: bool = False) -> StreamingQuery:
    """Orders that met no detail line within ``within_seconds`` of arrival.

    Stream-stream left outer join (orders left) on the interval condition;
    Spark emits an order with an empty right side once the watermark shows no
    line can still arrive, and those rows are kept.
    """
    orders = clean.parse_orders(order_lines).withWatermark("ingest_ts", watermark)
    details = clean.parse_details(detail_lines).withWatermark("ingest_ts", watermark)
    missed = sale_detail.orders_without_partner(orders, details, within_seconds)
    writer = missed.writeStream.format("parquet").option("path", path).outputMode("append")
    return _start(writer, checkpoint, trigger_seconds, available_now, "unmatched_orders")
