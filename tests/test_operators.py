"""Operator tests on small hand-made rows: the edge cases the fixtures lack."""

from pyspark.sql import functions as F

from conftest import rows
from shoplens import schemas
from shoplens.operators import alerts, clean, dedup, ingest, metrics, sale_detail, search
from shoplens.operators.keyed import first_per_key, latest_per_key

DAY_MS = 86400000
T0 = 1704067200000  # 2024-01-01 00:00:00 UTC


def startup_rows(spark, data):
    """data: (mid, uid, ts_ms) -> startup logs with log_date / log_hour."""
    full = [(m, u, "app", "area", "ios", "ch", "startup", "1.0", ts) for m, u, ts in data]
    df = spark.createDataFrame(full, schemas.STARTUP_LOG)
    return clean.with_log_time(df)


# --- keyed pick ---------------------------------------------------------------

def test_first_and_latest_per_key_break_ties_stably(spark):
    df = spark.createDataFrame([("a", 1, "z"), ("a", 1, "b"), ("a", 2, "a"), ("b", 5, "x")],
                               "k string, t int, v string")
    assert rows(first_per_key(df, ["k"], ["t"])) == [("a", 1, "b"), ("b", 5, "x")]
    assert rows(latest_per_key(df, ["k"], ["t"])) == [("a", 2, "a"), ("b", 5, "x")]


# --- daily active devices ----------------------------------------------------

def test_first_visit_per_day_earliest_and_tie_break(spark):
    logs = startup_rows(spark, [
        ("m1", "u9", T0 + 5000), ("m1", "u2", T0 + 1000), ("m1", "u1", T0 + 1000),  # tie at +1s
        ("m1", "u3", T0 + DAY_MS),                                                 # next day
        ("m2", "u4", T0 + 7200000),
    ])
    out = rows(dedup.first_visit_per_day(logs), "log_date", "mid", "uid", "log_hour")
    assert out == [("2024-01-01", "m1", "u1", "00"), ("2024-01-01", "m2", "u4", "02"),
                   ("2024-01-02", "m1", "u3", "00")]


def test_dau_increment_drops_seen_devices_of_that_day_only(spark):
    seen = dedup.seen_devices(dedup.first_visit_per_day(startup_rows(spark, [("m1", "u1", T0)])))
    batch = startup_rows(spark, [("m1", "u1", T0 + 10), ("m1", "u1", T0 + DAY_MS), ("m2", "u2", T0 + 20)])
    out = rows(dedup.dau_increment(batch, seen), "log_date", "mid")
    assert out == [("2024-01-01", "m2"), ("2024-01-02", "m1")]


def test_new_devices_counts_first_day_only(spark):
    dau = dedup.first_visit_per_day(startup_rows(spark, [
        ("m1", "u", T0), ("m1", "u", T0 + DAY_MS), ("m2", "u", T0 + DAY_MS)]))
    assert rows(dedup.new_devices(dau)) == [("2024-01-01", 1), ("2024-01-02", 1)]


# --- metrics -----------------------------------------------------------------

def orders_df(spark, data):
    """data: (id, create_time, total_amount_text)"""
    full = [(i, "1", "c", None, "13800000000", "1", None, "7", None, amt, None, None, ct,
             None, None, None, None, None) for i, ct, amt in data]
    return clean.clean_orders(spark.createDataFrame(full, schemas.ORDER_INFO_TEXT))


def test_empty_day_dau_zero_and_revenue_null(spark):
    dau = dedup.first_visit_per_day(startup_rows(spark, [("m1", "u", T0)]))
    orders = orders_df(spark, [("1", "2024-01-01 10:00:00", "10.10")])
    assert metrics.dau_total(dau, "2030-01-01").first()[0] == 0
    assert metrics.gmv_total(orders, "2030-01-01").first()[0] is None


def test_gmv_sum_exact_and_bad_amount_ignored(spark):
    orders = orders_df(spark, [("1", "2024-01-01 10:00:00", "0.10"), ("2", "2024-01-01 10:30:00", "0.20"),
                               ("3", "2024-01-01 11:00:00", "oops"), ("4", "2024-01-02 10:00:00", "5")])
    assert metrics.gmv_total(orders, "2024-01-01").first()[0] == 0.3
    assert rows(metrics.gmv_hours(orders, "2024-01-01")) == [("10", 0.3), ("11", None)]


def test_realtime_total_cards(spark):
    dau = dedup.first_visit_per_day(startup_rows(spark, [("m1", "u", T0), ("m2", "u", T0 - DAY_MS),
                                                         ("m2", "u", T0)]))
    orders = orders_df(spark, [("1", "2024-01-01 10:00:00", "2.50")])
    out = rows(metrics.realtime_total(dau, orders, "2024-01-01"))
    assert out == [("dau", "daily active devices", 2.0), ("new_mid", "new devices", 1.0),
                   ("order_amount", "order amount", 2.5)]


def test_hour_table_zero_fills_24_hours(spark):
    dau = dedup.first_visit_per_day(startup_rows(spark, [
        ("m1", "u", T0 + 3600000), ("m2", "u", T0 + 3600000), ("m1", "u", T0 - 3600000)]))
    series = metrics.realtime_hours("dau", dau, None, "2024-01-01")
    table = metrics.hour_table(series)
    got = {r["hour"]: (r["yesterday"], r["today"]) for r in table.collect()}
    assert len(got) == 24
    assert got["01"] == (0.0, 2.0) and got["23"] == (1.0, 0.0) and got["00"] == (0.0, 0.0)


def test_realtime_hours_unknown_id_is_empty(spark):
    dau = dedup.first_visit_per_day(startup_rows(spark, [("m1", "u", T0)]))
    assert metrics.realtime_hours("bogus", dau, None, "2024-01-01").count() == 0


def test_hours_map_and_day_over_day(spark):
    series = spark.createDataFrame([("today", "01", 2.0), ("today", "00", 1.0), ("yesterday", "05", 3.0)],
                                   "day string, hour string, value double")
    m = {r["day"]: r["hours"] for r in metrics.hours_map(series).collect()}
    assert m == {"today": {"00": 1.0, "01": 2.0}, "yesterday": {"05": 3.0}}
    daily = spark.createDataFrame([("2024-01-01", 100.0), ("2024-01-02", 150.0), ("2024-01-04", 1.0)],
                                  "day string, value double")
    out = rows(metrics.day_over_day(daily))
    assert out == [("2024-01-01", 100.0, None, None), ("2024-01-02", 150.0, 100.0, 50.0),
                   ("2024-01-04", 1.0, None, None)]


# --- ingest ------------------------------------------------------------------

def test_stamp_log_replaces_client_ts(spark):
    lines = spark.createDataFrame([('{"mid":"m1","ts":"5","type":"startup"}', 1000)], "value string, s long")
    out = ingest.route_logs(ingest.stamp_log(lines, "s")).first()
    assert out["value"] == '{"mid":"m1","type":"startup","ts":1000}'
    assert out["ts"] == 1000 and out["topic"] == schemas.STARTUP_TOPIC
    parsed = clean.parse_startup(spark.createDataFrame([(out["value"],)], "value string")).first()
    assert parsed["ts"] == 1000 and parsed["mid"] == "m1"


def test_route_changes_filters_and_keeps_nulls(spark):
    def env(entry, table, event, rows_):
        return (entry, table, event, [[{"name": n, "value": v} for n, v in r] for r in rows_], 1, None)
    data = [
        env("ROWDATA", "order_info", "INSERT", [[("id", "1"), ("total_amount", "12.5"), ("img_url", None)],
                                                 [("id", "2"), ("total_amount", "x")]]),
        env("ROWDATA", "order_info", "UPDATE", [[("id", "1")]]),
        env("ROWDATA", "user_info", "UPDATE", [[("id", "7"), ("gender", "F")]]),
        env("ROWDATA", "user_info", "DELETE", [[("id", "7")]]),
        env("TRANSACTIONBEGIN", "order_info", "INSERT", []),
    ]
    envs = spark.createDataFrame(data, schemas.CHANGE_ENVELOPE)
    out = rows(ingest.route_changes(envs), "topic", "value")
    assert out == [
        (schemas.ORDER_INFO_TOPIC, '{"id":"1","total_amount":"12.5","img_url":null}'),
        (schemas.ORDER_INFO_TOPIC, '{"id":"2","total_amount":"x"}'),
        (schemas.USER_INFO_TOPIC, '{"id":"7","gender":"F"}'),
    ]
    # quoted numbers survive parsing (parsed as text, then try_cast)
    orders = clean.parse_orders(ingest.route_changes(envs).where(F.col("topic") == schemas.ORDER_INFO_TOPIC))
    assert rows(orders, "id", "total_amount") == [("1", 12.5), ("2", None)]


# --- alerts ------------------------------------------------------------------

def event_rows(spark, data):
    """data: (mid, uid, evid, itemid, ts_ms)"""
    full = [(m, u, "app", "a", "ios", "event", e, "1", "2", i, ts) for m, u, e, i, ts in data]
    return alerts.with_event_time(spark.createDataFrame(full, schemas.EVENT_LOG))


def test_alert_needs_three_users_and_no_click(spark):
    ev = event_rows(spark, [
        ("m1", "u1", "coupon", "5", T0 + 1000), ("m1", "u2", "coupon", "6", T0 + 2000),
        ("m1", "u3", "coupon", "5", T0 + 3000), ("m1", "u3", "addCart", "5", T0 + 4000),
        ("m2", "u1", "coupon", "1", T0 + 1000), ("m2", "u2", "coupon", "1", T0 + 2000),
        ("m2", "u3", "coupon", "1", T0 + 3000), ("m2", "u4", "clickItem", "1", T0 + 4000),
        ("m3", "u1", "coupon", "1", T0 + 1000), ("m3", "u2", "coupon", "1", T0 + 2000),
        ("m3", "u1", "coupon", "2", T0 + 3000),
    ])
    w = alerts.alert_windows(ev, "1 minute", "1 minute")
    counts = alerts.alert_counts(ev, "1 minute", "1 minute")
    assert rows(alerts.alert_candidates(counts), "mid") == [("m1",), ("m2",)]
    out = alerts.render(alerts.coupon_alerts(w)).collect()
    assert len(out) == 1
    a = out[0]
    assert (a["mid"], a["uids"], a["item_ids"], a["n_users"], a["events"]) == (
        "m1", "u1,u2,u3", "5,6", 3, "addCart:1,coupon:3")
    assert a["window_start"] == T0 and a["ts"] == T0 + 60000


def test_sliding_windows_are_start_inclusive_end_exclusive(spark):
    ev = event_rows(spark, [("m1", "u1", "coupon", "1", T0 + 30000)])
    w = rows(alerts.alert_counts(ev, "30 seconds", "10 seconds"), "window_start", "window_end")
    assert w == [(T0 + 10000, T0 + 40000), (T0 + 20000, T0 + 50000), (T0 + 30000, T0 + 60000)]


def test_latest_alert_per_device_minute(spark):
    ev = event_rows(spark, [("m1", f"u{i}", "coupon", "1", T0 + 1000 * i) for i in range(3)])
    w = alerts.coupon_alerts(alerts.alert_windows(ev, "30 seconds", "5 seconds"))
    # windows ending at T0+5s..T0+30s all fall in minute T0/60000 -> one document
    full = w.where(F.col("n_users") >= 3)
    assert full.count() >= 2
    latest = alerts.latest_per_document(w).collect()
    assert len(latest) == 1 and latest[0]["doc_id"] == "m1" + str(T0 // 60000)
    assert latest[0]["ts"] == max(r["ts"] for r in full.collect())


# --- orders x details ----------------------------------------------------------

def test_interval_join_each_pair_once_and_bound(spark):
    orders = spark.createDataFrame([
        ("o1", "1", "2024-01-01 10:00:00", "u1", "2024-01-01", "2024-01-01 10:00:00"),
        ("o2", "1", "2024-01-01 11:00:00", "u2", "2024-01-01", "2024-01-01 11:00:00"),
    ], "id string, order_status string, create_time string, user_id string, create_date string, ingest_ts string"
    ).withColumn("ingest_ts", F.to_timestamp("ingest_ts"))
    details = spark.createDataFrame([
        ("d1", "o1", "s1", "red bolt", "1.50", "2024-01-01 09:55:00"),   # 300 s early: in
        ("d2", "o1", "s2", "blue nut", "bad", "2024-01-01 10:05:01"),    # 301 s late: out
        ("d3", "o1", "s3", "hot gear", "2.00", "2024-01-01 10:04:00"),   # in
        ("d4", "o9", "s4", "lost", "1.00", "2024-01-01 10:00:00"),       # no order
    ], "id string, order_id string, sku_id string, sku_name string, order_price string, ingest_ts string"
    ).withColumn("ingest_ts", F.to_timestamp("ingest_ts"))
    pairs = rows(sale_detail.join_within(orders, details, 300), "order_detail_id", "order_id", "sku_price")
    assert pairs == [("d1", "o1", 1.5), ("d3", "o1", 2.0)]
    full = rows(sale_detail.join_all(orders, details), "order_detail_id", "order_id", "sku_price")
    assert full == [(None, "o2", None), ("d1", "o1", 1.5), ("d2", "o1", None), ("d3", "o1", 2.0),
                    ("d4", "o9", 1.0)]
    assert rows(sale_detail.unmatched_orders(orders, details), "id") == [("o2",)]
    assert rows(sale_detail.unmatched_details(orders, details), "id") == [("d4",)]
    assert rows(sale_detail.unmatched_orders_within(orders, details, 300), "id") == [("o2",)]
    assert rows(sale_detail.orders_without_partner(orders, details, 300), "id") == [("o2",)]

    users = spark.createDataFrame([("u1", "n", "3", "2000-03-01", "F")], schemas.USER_INFO)
    sales = sale_detail.enrich_users(sale_detail.join_all(orders, details).where(F.col("order_id") != "o9"),
                                     users, "2020-03-01")
    got = {(r["order_detail_id"], r["user_gender"], r["user_age"], r["user_level"]) for r in sales.collect()}
    assert ("d1", "F", 20, "3") in got and (None, None, 0, None) in got  # o2's user u2 unknown


# --- search ------------------------------------------------------------------

def test_search_keyword_tokens_paging_and_shares(spark):
    sales = spark.createDataFrame([
        (f"d{i:02d}", "o", "1", "t", "u", "s", "M" if i % 3 else "F", 15 + i, "1", 1.0,
         "Red Widget" if i % 2 else "blue bolt", "2024-01-01")
        for i in range(10)
    ] + [("x1", "o", "1", "t", "u", "s", "M", 40, "1", 1.0, "red widget", "2024-01-02")],
        "order_detail_id string, order_id string, order_status string, create_time string, user_id string, "
        "sku_id string, user_gender string, user_age int, user_level string, sku_price double, "
        "sku_name string, dt string")
    hits = search.filter_sales(sales, "2024-01-01", "widget RED")
    assert search.search_total(hits).first()[0] == 5
    page = [r[0] for r in search.search_page(hits, 1, 2).select("order_detail_id").collect()]
    assert page == ["d03", "d05"]
    assert search.filter_sales(sales, "2024-01-01", "").count() == 10
    assert search.filter_sales(sales, None, "").count() == 0  # default day has no rows
    shares = rows(search.gender_share(hits))
    assert sum(s[2] for s in shares) == 100.0
    ages = {r["age_band"]: r["n"] for r in search.age_share(search.filter_sales(sales, "2024-01-01")).collect()}
    assert ages == {"under 20": 5, "20 to 29": 5}


def test_rest_answer_shapes(spark):
    series = spark.createDataFrame([("today", "12", 38.0), ("today", "13", 1233.0), ("yesterday", "11", 383.0)],
                                   "day string, hour string, value double")
    answer = metrics.hours_answer(series).first()[0]
    import json
    assert json.loads(answer) == {"today": {"12": 38.0, "13": 1233.0}, "yesterday": {"11": 383.0}}
    cards = spark.createDataFrame([("dau", "d", 2.0), ("order_amount", "o", None)], "id string, name string, value double")
    assert json.loads(metrics.cards_answer(cards).first()[0]) == [
        {"id": "dau", "name": "d", "value": 2.0}, {"id": "order_amount", "name": "o"}]


def test_envelopes_round_trip_through_json(spark):
    from shoplens.sources import changefeed
    env = spark.createDataFrame([("ROWDATA", "user_info", "INSERT", [[{"name": "id", "value": "1"}]], 5, None)],
                                schemas.CHANGE_ENVELOPE)
    text = env.select(F.to_json(F.struct(*env.columns)).alias("value"))
    back = changefeed.parse_envelopes(text)
    assert rows(ingest.route_changes(back), "topic", "value") == [(schemas.USER_INFO_TOPIC, '{"id":"1"}')]
