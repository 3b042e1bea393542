"""Log text as sent, archives that survive a rerun, default day, live trigger."""

import json

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, rows
from shoplens import schemas
from shoplens.operators import dedup, ingest, metrics
from shoplens.plans import catalog
from shoplens.plans.tables import RetailTables
from shoplens.sources.topics import append_topic_files, read_topic_files
from shoplens.streaming import jobs
from test_streaming import scratch

STAMP = 1704067200000


@pytest.mark.parametrize("sent, stamped", [
    ('{"a":1.10,"b":1e3}', '{"a":1.10,"b":1e3,"ts":%d}'),
    ('{"a":1.10,"ts":5}', '{"a":1.10,"ts":%d}'),
    ('{"ts": 5 , "a" : 1.10 }', '{ "a" : 1.10,"ts":%d}'),
    ('{"a":1,"ts":"x","b":"k}"}', '{"a":1,"b":"k}","ts":%d}'),
    ('{"ts":5}', '{"ts":%d}'),
    ("{}", '{"ts":%d}'),
    (' { "o" : {"ts":1} } ', ' { "o" : {"ts":1},"ts":%d}'),
    ('{"big":123456789012345678901234567890,"s":"\\u00e9"}', '{"big":123456789012345678901234567890,"s":"\\u00e9","ts":%d}'),
])
def test_text_stays_as_sent(spark, sent, stamped):
    (got,) = ingest.stamp_log(spark.createDataFrame([(sent,)], "value string"), F.lit(STAMP)).collect()
    assert got.well_formed and got.value == stamped % STAMP


@pytest.mark.parametrize("sent", ['{"o":{"ts":1},"ts":5,"z":null}', '{"ts":{"a":1},"b":2}', '{"\\u0074s":5,"b":2}',
                                  '{"x":"\\"ts\\":3,","ts":9,"b":2}', '{"ts":[1,2],"b":"ts"}'])
def test_odd_lines_keep_their_fields(spark, sent):
    (got,) = ingest.stamp_log(spark.createDataFrame([(sent,)], "value string"), F.lit(STAMP)).collect()
    assert json.loads(got.value) == json.loads(sent) | {"ts": STAMP}


def test_an_archive_batch_that_runs_again_is_there_once(spark):
    path = scratch()
    first = spark.createDataFrame([('{"a":1}', STAMP), ('{"a":2}', STAMP + 86_400_000)], "value string, at long")
    for batch, lines in (("b1", first), ("b1", first), ("b2", first.limit(1))):
        ingest.archive_logs(ingest.stamp_log(lines, "at"), path, batch=batch)
    found = rows(spark.read.text(path), "batch", "value")
    assert [b for b, _ in found] == ["b1", "b1", "b2"]


def test_the_default_day_is_today(spark):
    day = metrics.today(spark)
    dau = spark.createDataFrame([(day, "m1"), (day, "m2"), ("2001-01-01", "m1")], "log_date string, mid string")
    orders = spark.createDataFrame([(day, "01", 2.5), ("2001-01-01", "01", 9.0)], "create_date string, create_hour string, total_amount double")
    cards = {r.id: r.value for r in metrics.realtime_total(dau, orders).collect()}
    assert cards == {"dau": 2.0, "new_mid": 1.0, "order_amount": 2.5}
    hours = metrics.realtime_hours(metrics.CARD_ORDER_AMOUNT, dau, orders).collect()
    assert [(r.day, r.hour, r.value) for r in hours] == [("today", "01", 2.5)]


def test_a_job_on_its_live_trigger(spark):
    """Not drained: started with a processing-time trigger, fed while it runs."""
    topic, table, ckpt = scratch(), jobs.dau_table(scratch(), merge_every=1), scratch()

    def send(mid, ms):
        append_topic_files(spark.createDataFrame([(json.dumps({"mid": mid, "uid": "u", "type": "startup", "ts": ms}),)], "value string"), topic)

    send("m1", STAMP)
    query = jobs.dau_table_job(read_topic_files(spark, topic), table, ckpt, trigger_seconds=1)
    try:
        query.processAllAvailable()
        send("m2", STAMP + 1)
        query.processAllAvailable()
        assert rows(table.read(spark), "mid") == [("m1",), ("m2",)]
    finally:
        query.stop()


def test_empty_tables_give_no_alerts(spark):
    base = scratch()
    assert jobs.read_alerts(spark, base + "/counts", base + "/claims").collect() == []


def test_first_visit_columns_are_the_tables(spark):
    assert jobs.DAU_SCHEMA.fieldNames() == dedup.DAU_COLUMNS


def test_only_lines_that_may_start_are_parsed(spark):
    """The cheap test before the parsing keeps every line of the startup topic."""
    sent = ['{"mid":"a","type":"startup"}', '{"mid":"b","type":"\\u0073tartup","ts":1,"x":{"ts":2}}', '{"mid":"c","ts":"startup"}',
            '{"mid":"d","type":"event"}', '{"sta":"rtup","ts":3}', "startup, no JSON", "{}", None, '{"x":"\\\\"}', '{"ts":1,"startup":null}']
    lines = spark.createDataFrame([(i, v) for i, v in enumerate(sent)], "i int, value string")

    def starts(rows):
        stamped = ingest.route_logs(ingest.stamp_log(rows, F.lit(STAMP)))
        return sorted(tuple(r) for r in stamped.where(F.col("topic") == schemas.STARTUP_TOPIC).select("i", "value").collect())

    kept = {r.i for r in lines.where(ingest.may_start()).collect()}
    assert kept == {0, 1, 2, 5, 8, 9}
    assert starts(lines.where(ingest.may_start())) == starts(lines) != []


def test_startup_topic_filters_before_it_parses(spark):
    plan = catalog._stamped_lines(RetailTables(spark, SF_SMALL), schemas.STARTUP_TOPIC)._jdf.queryExecution().optimizedPlan().toString()
    assert "Filter (Contains(value" in plan
    assert plan.index("from_json") < plan.index("Filter (Contains(value") < plan.index("Union")
