"""Streaming jobs: stream results equal batch results, sinks survive replay."""

import json

import pytest
from pyspark.sql import functions as F

from conftest import rows
from shoplens.operators import alerts, clean, dedup
from shoplens.sources.topics import append_topic_files, read_topic_files
from shoplens.streaming import jobs
from shoplens.streaming.sinks import AppendTable, KeyedTable

T0 = 1704067200000  # 2024-01-01 00:00:00 UTC


def _plan(df):
    import contextlib
    import io
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def scratch():
    """A fresh folder under the session's checkpoint folder."""
    from pyspark.sql import SparkSession

    from shoplens.session import work_path
    return work_path(SparkSession.getActiveSession(), "tests")


def test_keyed_table_replay_is_idempotent(spark):
    t = KeyedTable(scratch() + "/t", keys=["k"], order_by=["v"], partition_by=["d"])
    b0 = spark.createDataFrame([("a", 1, "x"), ("b", 1, "x")], "k string, v int, d string")
    t.write_batch(b0, 0)
    t.write_batch(b0, 0)  # replay of batch 0 after a failure
    assert t.history(spark).count() == 2
    t.write_batch(spark.createDataFrame([("a", 0, "y")], "k string, v int, d string"), 1)
    # a later batch wins even with a smaller ordering value
    assert rows(t.read(spark)) == [("a", 0, "y"), ("b", 1, "x")]


def _startup_json(mid, uid, ts):
    return json.dumps({"mid": mid, "uid": uid, "appid": "a", "area": "x", "os": "ios", "ch": "c",
                       "type": "startup", "vs": "1", "ts": ts})


def test_dau_stream_equals_batch_across_batches(spark):
    topic, ckpt = scratch() + "/topic", scratch()
    table = AppendTable(scratch() + "/dau", partition_by=["log_date"])
    chunks = [
        [("m1", "u1", T0 + 5000), ("m1", "u2", T0 + 1000), ("m2", "u3", T0 + 2000)],
        [("m1", "u4", T0 + 9000), ("m3", "u5", T0 + 9500), ("m3", "u6", T0 + 9400)],
        [],
        [("m1", "u7", T0 + 86400000)],
    ]
    all_rows = []
    for chunk in chunks:
        all_rows += chunk
        if chunk:
            append_topic_files(spark.createDataFrame([(_startup_json(*r),) for r in chunk], "value string"), topic)
        q = jobs.dau_job(read_topic_files(spark, topic), table, ckpt, available_now=True)
        q.awaitTermination()
        assert q.exception() is None
    got = rows(jobs.read_dau(table.read(spark)), "log_date", "mid", "uid")
    batch = clean.parse_startup(spark.createDataFrame([(_startup_json(*r),) for r in all_rows], "value string"))
    assert got == rows(dedup.first_visit_per_day(batch), "log_date", "mid", "uid")
    assert got == [("2024-01-01", "m1", "u2"), ("2024-01-01", "m2", "u3"), ("2024-01-01", "m3", "u6"),
                   ("2024-01-02", "m1", "u7")]


def _event_json(mid, uid, evid, ts):
    return json.dumps({"mid": mid, "uid": uid, "appid": "a", "area": "x", "os": "ios", "type": "event",
                       "evid": evid, "pgid": 1, "npgid": 2, "itemid": 7, "ts": ts})


def test_alert_stream_equals_batch(spark):
    topic, ckpts, counts, claims = scratch() + "/topic", [scratch(), scratch()], scratch() + "/counts", scratch() + "/claims"
    chunks = [
        [("m1", "u1", "coupon", T0 + 1000), ("m1", "u2", "coupon", T0 + 2000), ("m2", "u1", "coupon", T0 + 2000)],
        [("m1", "u3", "coupon", T0 + 12000), ("m2", "u2", "coupon", T0 + 13000), ("m2", "u3", "coupon", T0 + 14000),
         ("m2", "u9", "clickItem", T0 + 15000)],
        [("m3", "u1", "coupon", T0 + 61000)],
        [("m9", "u0", "addCart", T0 + 3600000)],  # moves the watermark past every window above
        [],
    ]
    all_rows = []
    for chunk in chunks:
        all_rows += chunk
        if chunk:
            append_topic_files(spark.createDataFrame([(_event_json(*r),) for r in chunk], "value string"), topic)
        for q in (jobs.alert_count_job(read_topic_files(spark, topic), counts, ckpts[0], "30 seconds", "5 seconds",
                                       watermark="10 seconds", available_now=True),
                  jobs.claim_job(read_topic_files(spark, topic), claims, ckpts[1], available_now=True)):
            q.awaitTermination()
            assert q.exception() is None
    streamed = alerts.render(jobs.read_alerts(spark, counts, claims))
    batch_events = alerts.with_event_time(
        clean.parse_event(spark.createDataFrame([(_event_json(*r),) for r in all_rows], "value string")))
    batch = alerts.render(alerts.latest_per_document(alerts.alert_windows(batch_events, "30 seconds", "5 seconds")))
    assert rows(streamed) == rows(batch.select(*streamed.columns))
    got = {(r["mid"], r["window_end"]) for r in streamed.collect() if r["mid"] == "m2"}
    # m2's click at +15 s lies outside [-15 s, +15 s): only that window alerts
    assert got == {("m2", T0 + 15000)}
    assert "m3" not in {r["mid"] for r in streamed.collect()}
    # the counts serve any threshold
    assert {r["mid"] for r in jobs.read_alerts(spark, counts, claims, min_users=1).collect()} == {"m1", "m2", "m3"}


def _order_json(oid, user, ct):
    return json.dumps({"id": oid, "user_id": user, "create_time": ct, "order_status": "1",
                       "consignee_tel": "13812345678", "total_amount": "9.90"})


def _detail_json(did, oid, price):
    return json.dumps({"id": did, "order_id": oid, "sku_id": "s", "sku_name": "n", "order_price": price,
                       "sku_num": "1"})


def test_interval_join_stream_matches_late_and_early_lines(spark):
    o_topic, d_topic, ckpt = scratch() + "/o", scratch() + "/d", scratch()
    out = AppendTable(scratch() + "/out", partition_by=["dt_month"])
    users = spark.createDataFrame([("u1", "l", "2", "2000-03-01", "M")],
                                  "id string, login_name string, user_level string, birthday string, gender string")

    def o_msg(oid, user, ct):
        return (_order_json(oid, user, ct), 1, ct)

    def d_msg(did, oid, price, ts):
        return (_detail_json(did, oid, price), 1, ts)

    schema = "value string, seq long, ingest_ts string"
    batches = [
        # early line d0 arrives before its order; o2 has no lines
        ([o_msg("o2", "u2", "2024-01-01 10:00:00")], [d_msg("d0", "o1", "1.00", "2024-01-01 09:58:00")]),
        # order o1 arrives; d1 with it; d9 belongs to o1 but 10 min later (outside 300 s)
        ([o_msg("o1", "u1", "2024-01-01 10:00:00")], [d_msg("d1", "o1", "2.00", "2024-01-01 10:01:00")]),
        ([], [d_msg("d2", "o1", "3.00", "2024-01-01 10:04:59"), d_msg("d9", "o1", "4.00", "2024-01-01 10:10:00")]),
    ]
    for orders, details in batches:
        for path, msgs in ((o_topic, orders), (d_topic, details)):
            if msgs:
                df = spark.createDataFrame(msgs, schema).withColumn("ingest_ts", F.to_timestamp("ingest_ts"))
                append_topic_files(df, path)
        q = jobs.sale_detail_job(read_topic_files(spark, o_topic), read_topic_files(spark, d_topic), lambda: users,
                                 out, ckpt, "2020-03-01", 300, watermark="10 minutes", available_now=True)
        q.awaitTermination()
        assert q.exception() is None
    got = rows(out.read(spark), "order_detail_id", "order_id", "user_gender", "user_age", "sku_price")
    assert got == [("d0", "o1", "M", 20, 1.0), ("d1", "o1", "M", 20, 2.0), ("d2", "o1", "M", 20, 3.0)]


def _drain(query):
    query.awaitTermination()
    assert query.exception() is None
    return query


@pytest.mark.parametrize("zone", ["UTC", "America/Los_Angeles", "Asia/Shanghai"])
def test_dau_final_job_equals_batch_in_any_time_zone(spark, zone):
    """Days are the session's; rows behind the watermark are dropped and
    counted; an earlier row of a later batch replaces the device's row."""
    chunks = [
        [("m1", "u1", T0 + 5000), ("m1", "u2", T0 + 4000), ("m2", "u3", T0 + 2000)],
        [("m1", "u4", T0 + 1000), ("m3", "u5", T0 + 9500), ("m3", "u6", T0 + 9400)],
        [("m1", "u7", T0 + 2 * 86400000)],              # two days on: moves the watermark past day 1
        [("m2", "u8", T0 + 3000)],                      # day 1 row, far behind the watermark: dropped
        [("m9", "u9", T0 + 5 * 86400000)],
        [],
    ]
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        topic, ckpts, out = scratch() + "/topic", [scratch(), scratch()], scratch() + "/out"
        table = AppendTable(scratch() + "/dau", partition_by=["log_date"])
        kept, dropped = [], 0
        for k, chunk in enumerate(chunks):
            kept += chunk if k != 3 else []
            if chunk:
                append_topic_files(spark.createDataFrame([(_startup_json(*r),) for r in chunk], "value string"), topic)
            _drain(jobs.dau_job(read_topic_files(spark, topic), table, ckpts[0], available_now=True))
            dropped += jobs.late_rows_dropped(_drain(jobs.dau_final_job(read_topic_files(spark, topic), out, ckpts[1], available_now=True)))
        batch = dedup.first_visit_per_day(clean.parse_startup(spark.createDataFrame([(_startup_json(*r),) for r in kept], "value string")))
        assert rows(jobs.read_dau(table.read(spark))) == rows(batch)
        assert rows(jobs.read_dau_final(spark, out).where("mid <> 'm9'")) == rows(batch.where("mid <> 'm9'"))
        assert ("m1", "u4") in rows(batch, "mid", "uid")
        assert dropped == 1
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_dau_rows_are_counted_after_deduplication(spark):
    topic, ckpt = scratch() + "/topic", scratch()
    table = AppendTable(scratch() + "/dau", partition_by=["log_date"])
    append_topic_files(spark.createDataFrame([(_startup_json("m1", f"u{i}", T0 + i),) for i in range(5)], "value string"), topic)
    q = _drain(jobs.dau_job(read_topic_files(spark, topic), table, ckpt, available_now=True))
    assert jobs.observed_rows(q)[0] == 1


def test_dau_table_compacts_closed_days(spark):
    topic, ckpt = scratch() + "/topic", scratch()
    table = AppendTable(scratch() + "/dau", partition_by=["log_date"])
    for k in range(3):
        append_topic_files(spark.createDataFrame([(_startup_json("m1", f"u{k}", T0 + 100 - k),)], "value string"), topic)
        _drain(jobs.dau_job(read_topic_files(spark, topic), table, ckpt, available_now=True))
    closed = AppendTable(scratch() + "/closed", partition_by=["log_date"])
    for _ in range(2):  # a rerun gives the same table
        table.compact(spark, F.col("log_date") == "2024-01-01", jobs.read_dau, closed)
    assert table.read(spark).count() == 3
    assert rows(closed.read(spark), "log_date", "mid", "uid") == [("2024-01-01", "m1", "u2")]


def test_no_python_runs_in_the_streaming_dau(spark):
    import shoplens.streaming.jobs as source
    text = open(source.__file__).read()
    assert "applyInPandas" not in text and "udf" not in text


def test_start_all_on_empty_topics_and_a_user_after_the_start(spark):
    from shoplens import schemas
    from shoplens.streaming.pipeline import Tables, start_all

    base = scratch()
    topics = [schemas.STARTUP_TOPIC, schemas.EVENT_TOPIC, schemas.ORDER_INFO_TOPIC, schemas.ORDER_DETAIL_TOPIC, schemas.USER_INFO_TOPIC]
    for topic in topics:
        append_topic_files(spark.createDataFrame([], "value string"), f"{base}/topics/{topic}")

    def run():
        for q in start_all(spark, lambda topic: read_topic_files(spark, f"{base}/topics/{topic}"), base, "2020-03-01", available_now=True).values():
            _drain(q)

    run()
    at = F.to_timestamp(F.lit("2024-01-01 10:00:00"))

    def send(topic, text, seq):
        append_topic_files(spark.createDataFrame([(text, seq)], "value string, seq long").withColumn("ingest_ts", at), f"{base}/topics/{topic}")

    send(schemas.ORDER_INFO_TOPIC, _order_json("o1", "u1", "2024-01-01 10:00:00"), 1)
    send(schemas.ORDER_DETAIL_TOPIC, _detail_json("d1", "o1", "1.00"), 1)
    run()  # no such user yet
    send(schemas.USER_INFO_TOPIC, json.dumps({"id": "u1", "login_name": "l", "user_level": "2", "birthday": "2000-03-01", "gender": "M"}), 1)
    send(schemas.ORDER_DETAIL_TOPIC, _detail_json("d2", "o1", "2.00"), 2)
    run()
    got = rows(Tables(base).sale_detail.read(spark), "order_detail_id", "user_gender", "user_age")
    assert got == [("d1", None, 0), ("d2", "M", 20)]


def test_ingest_keeps_fields_and_rejects_malformed_lines(spark):
    from shoplens import schemas
    from shoplens.operators import ingest

    lines = [('{"type":"startup","n":12,"o":{"ts":1,"a":[1,null]},"ts":5,"z":null}',), ("no json",), ("[1]",), ("{}",), (None,), ('{"type":"event","d":1.25}',)]
    out = ingest.route_logs(ingest.stamp_log(spark.createDataFrame(lines, "value string"), F.lit(T0)))
    got = {(r["topic"], r["value"]) for r in out.collect()}
    assert got == {
        (schemas.STARTUP_TOPIC, '{"type":"startup","n":12,"o":{"a":[1,null],"ts":1},"z":null,"ts":%d}' % T0),
        (schemas.EVENT_TOPIC, '{"type":"event","d":1.25,"ts":%d}' % T0), (schemas.EVENT_TOPIC, '{"ts":%d}' % T0),
        (schemas.REJECTED_TOPIC, "no json"), (schemas.REJECTED_TOPIC, "[1]"), (schemas.REJECTED_TOPIC, None)}


def test_pipeline_end_to_end_on_file_topics(spark):
    """Every job wired from topics to tables, compared with the batch path."""
    from shoplens import schemas
    from shoplens.operators import ingest, metrics, sale_detail
    from shoplens.plans.tables import RetailTables
    from shoplens.streaming.pipeline import Tables, start_all

    t = RetailTables(spark, "/root/testdata/sf0.001")
    base = scratch()
    stamped = ingest.route_logs(ingest.stamp_log(t.raw_log_lines, "stamp_ms"))
    for topic in (schemas.STARTUP_TOPIC, schemas.EVENT_TOPIC):
        append_topic_files(stamped.where(F.col("topic") == topic).select(
            "value", F.timestamp_millis("stamp_ms").alias("ingest_ts")), f"{base}/topics/{topic}")
    for topic in (schemas.ORDER_INFO_TOPIC, schemas.ORDER_DETAIL_TOPIC, schemas.USER_INFO_TOPIC):
        append_topic_files(t.topic(topic), f"{base}/topics/{topic}")

    qs = start_all(spark, lambda topic: read_topic_files(spark, f"{base}/topics/{topic}"), base,
                   as_of="2020-03-01", available_now=True, alert_window="6 hours", alert_slide="1 hour",
                   alert_watermark="1 hour", join_watermark="400 days", dau_lateness="400 days", part_chars=7)
    for q in qs.values():
        q.awaitTermination()
        assert q.exception() is None
    tables = Tables(base, part_chars=7)
    assert rows(tables.dau.read(spark)) == rows(t.dau)
    first_days = tables.first_days.read_totals(spark, "new_mid")
    assert rows(metrics.new_mid_of_totals(first_days, "2024-01-15")) == rows(metrics.new_mid_total(t.dau, "2024-01-15"))
    assert rows(tables.users.read(spark).select(*t.users.columns)) == rows(t.users)
    day = "1996-09-17"
    orders_of_day = tables.orders.read(spark, parts=[day])
    assert rows(metrics.gmv_hours(orders_of_day, day)) == rows(metrics.gmv_hours(t.orders, day))
    tables.orders.merge(spark)
    assert rows(tables.orders.read(spark, parts=[day]).select(*schemas.ORDER_INFO_COLUMNS)) == rows(
        t.orders.where(F.col("create_date") == day).select(*schemas.ORDER_INFO_COLUMNS))
    assert rows(metrics.gmv_hours_of_totals(tables.orders.read_totals(spark, "hours"), day)) == rows(metrics.gmv_hours(t.orders, day))
    assert _plan(tables.orders.read(spark, parts=[day])).count("_part=") == 1  # one month's folder
    want = sale_detail.build_sale_detail(t.orders, t.details, t.users, "2020-03-01")
    assert rows(tables.sale_detail.read(spark).select(*want.columns)) == rows(want)
    # documents of windows that the watermark has closed: all but those of the last hours
    found = alerts.to_documents(alerts.latest_per_document(alerts.alert_windows(alerts.with_event_time(t.event_logs), "6 hours", "1 hour")))
    assert set(rows(alerts.to_documents(tables.alert_documents.read(spark)))) <= set(rows(found))


def test_alert_count_job_equals_batch_counts(spark):
    topic, ckpt, out = scratch() + "/topic", scratch(), scratch() + "/out"
    chunks = [
        [("m1", "u1", "coupon", T0 + 1000), ("m1", "u2", "coupon", T0 + 2000), ("m2", "u1", "coupon", T0 + 2000)],
        [("m1", "u3", "coupon", T0 + 12000), ("m2", "u2", "coupon", T0 + 13000), ("m2", "u3", "coupon", T0 + 14000),
         ("m2", "u9", "clickItem", T0 + 15000)],
        [("m3", "u1", "coupon", T0 + 61000)],
        [("m9", "u0", "addCart", T0 + 3600000)],  # moves the watermark past every window above
        [],
    ]
    all_rows = []
    for chunk in chunks:
        all_rows += chunk
        if chunk:
            append_topic_files(spark.createDataFrame([(_event_json(*r),) for r in chunk], "value string"), topic)
        q = jobs.alert_count_job(read_topic_files(spark, topic), out, ckpt, "30 seconds", "5 seconds",
                                 watermark="10 seconds", available_now=True)
        q.awaitTermination()
        assert q.exception() is None
    streamed = alerts.render(alerts.coupon_alerts(spark.read.parquet(out)))
    ev = alerts.with_event_time(
        clean.parse_event(spark.createDataFrame([(_event_json(*r),) for r in all_rows], "value string")))
    batch = alerts.render(alerts.coupon_alerts(alerts.alert_counts(ev, "30 seconds", "5 seconds")))
    assert rows(streamed) == rows(batch.select(*streamed.columns))
    assert {r["mid"] for r in streamed.collect()} == {"m1", "m2"}


def test_dau_ties_match_batch_order(spark):
    """Equal ts and uid: both paths pick the row with the smallest remaining
    columns (here ``area``), so stream and batch agree on ties."""
    def line(area, ts):
        return json.dumps({"mid": "m1", "uid": "u1", "appid": "a", "area": area, "os": "ios", "ch": "c",
                           "type": "startup", "vs": "1", "ts": ts})
    topic, ckpt = scratch() + "/topic", scratch()
    table = AppendTable(scratch() + "/dau", partition_by=["log_date"])
    data = [(line("zeta", T0 + 5),), (line("alpha", T0 + 5),), (line("beta", T0 + 9),)]
    append_topic_files(spark.createDataFrame(data, "value string"), topic)
    _drain(jobs.dau_job(read_topic_files(spark, topic), table, ckpt, available_now=True))
    batch = dedup.first_visit_per_day(clean.parse_startup(spark.createDataFrame(data, "value string")))
    assert rows(jobs.read_dau(table.read(spark)), "mid", "area") == rows(batch, "mid", "area") == [("m1", "alpha")]


def test_log_table_keeps_latest_version_by_seq(spark):
    from shoplens.streaming.sinks import LogTable
    topic, ckpt = scratch() + "/topic", scratch()
    table = LogTable(scratch() + "/orders", keys=["id"], order_by=["seq"], partition_by=["create_date"])

    def msg(oid, status, seq, day):
        return (json.dumps({"id": oid, "order_status": status, "create_time": f"{day} 10:00:00",
                            "total_amount": "1.00", "consignee_tel": "13800000000"}), seq)

    for batch in ([msg("o1", "1", 4, "2024-01-01"), msg("o2", "1", 8, "2024-01-02")],
                  [msg("o1", "2", 5, "2024-01-01")],      # a newer version of o1
                  [msg("o1", "2", 5, "2024-01-01")]):     # the same message delivered again
        append_topic_files(spark.createDataFrame(batch, "value string, seq long"), topic)
        q = jobs.order_job(read_topic_files(spark, topic), table, ckpt, available_now=True)
        q.awaitTermination()
        assert q.exception() is None
    assert rows(table.read(spark), "id", "order_status", "create_date") == [
        ("o1", "2", "2024-01-01"), ("o2", "1", "2024-01-02")]
    day = table.read(spark, where=F.col("create_date") == "2024-01-02")
    assert rows(day, "id") == [("o2",)]
    assert "PartitionFilters: [isnotnull(create_date" in _plan(day)


def test_replay_derives_its_messages_once(spark):
    from shoplens.streaming.replay import replay
    topic, ckpt, out = scratch() + "/topic", scratch(), scratch() + "/out"
    derived = spark.sparkContext.accumulator(0)

    def text(i):
        derived.add(1)
        return f"m{i}"

    made = spark.range(0, 40).select(F.udf(text)("id").alias("value"), F.col("id").cast("double").alias("_t"))

    def run():
        stream = read_topic_files(spark, topic).select("value").writeStream.format("parquet").option("path", out)
        return jobs._start(stream, ckpt, 5, True, "copy")

    replay({topic: (made, "_t")}, run)
    assert rows(spark.read.parquet(out)) == sorted((f"m{i}",) for i in range(40))
    assert derived.value == 40


def test_state_has_no_more_partitions_than_the_cores_need(spark):
    import os

    from shoplens.session import setting, state_partitions
    topic, ckpt = scratch() + "/topic", scratch()
    append_topic_files(spark.createDataFrame([(_startup_json("m1", "u1", T0),)], "value string"), topic)
    with setting(spark, "spark.sql.shuffle.partitions", "64"):
        most = state_partitions(spark)
        jobs.dau_final_job(read_topic_files(spark, topic), scratch() + "/out", ckpt, available_now=True).awaitTermination()
        assert spark.conf.get("spark.sql.shuffle.partitions") == "64"
    assert most == max(16, 2 * spark.sparkContext.defaultParallelism) < 64
    found = os.listdir(f"{ckpt.removeprefix('file:')}/state/0")
    assert sum(d.isdigit() for d in found) == most
    assert state_partitions(spark) == int(spark.conf.get("spark.sql.shuffle.partitions"))  # a smaller setting stays


def test_stamped_lines_are_parsed_once_by_a_filter_on_their_topic(spark):
    from shoplens.operators import ingest
    lines = spark.createDataFrame([('{"type":"startup"}', T0), ('{"type":"event","ts":1}', T0), ("broken", T0)], "value string, at long")
    routed = ingest.route_logs(ingest.stamp_log(lines, "at"))
    some = routed.where(F.col("topic") == "gmall_start").select("value", F.col("ts") + 1)
    assert rows(some) == [(f'{{"type":"startup","ts":{T0}}}', T0 + 1)]
    plan = _plan(some).split("== Physical Plan ==")[-1]
    assert plan.count("from_json(") == 1


def test_replay_gives_one_part_of_each_topic_at_a_time(spark):
    import os

    from shoplens.streaming.replay import replay
    paths, ckpt, seen, chunks = [scratch() + "/orders", scratch() + "/details"], scratch(), [], []
    made = spark.range(0, 40).select(F.col("id").cast("string").alias("value"), (F.col("id") * 7 % 40).cast("double").alias("_t"))
    few = made.where("_t < 3 or _t >= 36")  # most parts have none of these

    def each(batch, batch_id):
        seen.append((chunks[-1], sorted((r.topic, int(r.value) * 7 % 40) for r in batch.collect())))

    def run():
        topics = [read_topic_files(spark, p, 1).select("value", F.lit(i).alias("topic")) for i, p in enumerate(paths)]
        return jobs._start(topics[0].unionByName(topics[1]).writeStream.foreachBatch(each), ckpt, 5, True, "parts")

    replay({paths[0]: (made, "_t"), paths[1]: (few, "_t")}, run, n_chunks=2, at_once=6, keep=False, starting=chunks.append)
    assert [t for _, b in seen for topic, t in b if topic == 0] == list(range(40))
    assert sorted(t for _, b in seen for topic, t in b if topic == 1) == [0, 1, 2, 36, 37, 38, 39]
    filled = [(c, [t for _, t in b]) for c, b in seen if b]
    assert len(filled) > 4 and all(len(b) <= 12 for _, b in filled)
    assert all(max(a) < min(b) for (_, a), (_, b) in zip(filled, filled[1:]))  # the topics go side by side
    assert all(c == (t >= 19.5) for c, b in filled for t in b)
    # the first range's files went, and so did the folders beside the topics
    here = [p.removeprefix("file:") for p in paths]
    left = [t for p in paths for t in spark.read.parquet(p).select((F.col("value").cast("int") * 7 % 40).alias("t")).toPandas()["t"]]
    assert min(left) >= 19.5 and not any(os.path.exists(p + end) for p in here for end in (".staged", ".parts"))


def test_user_state_is_given_no_room_ahead(spark):
    from shoplens.streaming import users
    key = "spark.sql.streaming.stateStore.rocksdb.allowFAllocate"
    before = spark.conf.get(key, None)
    with users.rocksdb(spark):
        assert spark.conf.get(key) == "false"
    assert spark.conf.get(key, None) == before


def test_alert_table_may_merge_several_batches_at_once(spark):
    table = jobs.alert_table(scratch() + "/alerts", buckets=2, merge_every=3)
    for i in range(4):
        row = spark.sql(f"SELECT 'd' AS doc_id, 'm' AS mid, {i}L AS window_start, 9L AS window_end, 3 AS n_users, 3L AS n_events, "
                        f"array(struct('coupon' AS evid, 3L AS n)) AS event_counts, {i}L AS ts, array('u') AS uids, array('i') AS item_ids")
        table.write_batch(row, i)
    assert len(table.state(spark)["deltas"]) == 1
    assert rows(table.read(spark), "doc_id", "ts") == [("d", 3)]
