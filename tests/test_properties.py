"""Random small inputs: Spark operators against brute-force Python."""

import datetime as dt
from collections import defaultdict

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from shoplens import schemas
from shoplens.operators import alerts, clean, dedup, sale_detail

T0 = 1704067200000
SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))

visits = st.lists(st.tuples(st.sampled_from(["m1", "m2", "m3"]), st.sampled_from(["u1", "u2", "u3"]),
                            st.integers(0, 3 * 86400000)), min_size=1, max_size=25)


@SETTINGS
@given(visits)
def test_first_visit_matches_brute_force(spark, data):
    full = [(m, u, "a", "x", "ios", "c", "startup", "1", T0 + t) for m, u, t in data]
    logs = clean.with_log_time(spark.createDataFrame(full, schemas.STARTUP_LOG))
    got = sorted((r["log_date"], r["mid"], r["uid"], r["ts"]) for r in dedup.first_visit_per_day(logs).collect())
    best = {}
    for m, u, t in data:
        day = str(dt.datetime.fromtimestamp((T0 + t) / 1000, dt.UTC).date())
        cand = (T0 + t, u)
        if (day, m) not in best or cand < best[(day, m)]:
            best[(day, m)] = cand
    want = sorted((d, m, u, ts) for (d, m), (ts, u) in best.items())
    assert got == want


pairs_in = st.tuples(
    st.lists(st.tuples(st.sampled_from(["o1", "o2", "o3"]), st.integers(0, 1200)), max_size=4,
             unique_by=lambda x: x[0]),
    st.lists(st.tuples(st.sampled_from(["o1", "o2", "o3", "o4"]), st.integers(0, 1200)), max_size=12),
)


@SETTINGS
@given(pairs_in)
def test_interval_join_matches_brute_force(spark, data):
    orders_in, details_in = data
    orders = spark.createDataFrame(
        [(o, "1", "t", "u", "d", T0 // 1000 + s) for o, s in orders_in],
        "id string, order_status string, create_time string, user_id string, create_date string, s long"
    ).selectExpr("*", "timestamp_seconds(s) AS ingest_ts").drop("s")
    details = spark.createDataFrame(
        [(f"d{i}", o, "k", "n", "1.0", T0 // 1000 + s) for i, (o, s) in enumerate(details_in)],
        "id string, order_id string, sku_id string, sku_name string, order_price string, s long"
    ).selectExpr("*", "timestamp_seconds(s) AS ingest_ts").drop("s")
    got = sorted((r["order_detail_id"], r["order_id"]) for r in
                 sale_detail.join_within(orders, details, 300).collect())
    want = sorted((f"d{i}", o) for i, (o, s) in enumerate(details_in)
                  for oo, os_ in orders_in if oo == o and abs(s - os_) <= 300)
    assert got == want


events_in = st.lists(st.tuples(st.sampled_from(["m1", "m2"]), st.sampled_from(["u1", "u2", "u3", "u4"]),
                               st.sampled_from(["coupon", "coupon", "clickItem", "addCart"]),
                               st.integers(0, 90000)), min_size=1, max_size=20)


@SETTINGS
@given(events_in)
def test_sliding_alert_matches_brute_force(spark, data):
    full = [(m, u, "a", "x", "ios", "event", e, "1", "2", "7", T0 + t) for m, u, e, t in data]
    ev = alerts.with_event_time(spark.createDataFrame(full, schemas.EVENT_LOG))
    w = alerts.coupon_alerts(alerts.alert_windows(ev, "30 seconds", "10 seconds"))
    got = sorted((r["mid"], r["window_start"], tuple(r["uids"])) for r in w.collect())
    groups = defaultdict(list)
    for m, u, e, t in data:
        ts = T0 + t
        start = ts - ts % 10000
        for k in range(3):  # windows of 30 s sliding 10 s holding ts
            groups[(m, start - k * 10000)].append((u, e))
    want = []
    for (m, ws), evs in groups.items():
        users = sorted({u for u, e in evs if e == "coupon"})
        if len(users) >= 3 and not any(e == "clickItem" for _, e in evs):
            want.append((m, ws, tuple(users)))
    assert got == sorted(want)


sales_in = st.lists(st.tuples(st.sampled_from(["2024-01-01", "2024-01-02"]),
                              st.sampled_from(["Red Bolt", "red widget", "blue bolt", "hot gear", None]),
                              st.sampled_from(["M", "F", None]), st.integers(0, 60)),
                    min_size=1, max_size=30)


@SETTINGS
@given(sales_in, st.sampled_from(["", "red", "BOLT red", "gear"]), st.integers(0, 5), st.integers(1, 6))
def test_search_matches_brute_force(spark, data, keyword, start, length):
    from shoplens.operators import search
    rows_ = [(f"d{i:03d}", "o", "1", "t", "u", "s", g, a, "1", 1.0, n, day)
             for i, (day, n, g, a) in enumerate(data)]
    sales = spark.createDataFrame(rows_, "order_detail_id string, order_id string, order_status string, "
                                  "create_time string, user_id string, sku_id string, user_gender string, "
                                  "user_age int, user_level string, sku_price double, sku_name string, dt string")
    hits = search.filter_sales(sales, "2024-01-01", keyword)
    tokens = keyword.lower().split()
    want = sorted(r[0] for r in rows_ if r[11] == "2024-01-01"
                  and (not tokens or (r[10] is not None and all(t in r[10].lower() for t in tokens))))
    assert search.search_total(hits).first()[0] == len(want)
    page = [r[0] for r in search.search_page(hits, start, length).collect()]
    assert page == want[start:start + length]
    genders = {}
    for r in rows_:
        if r[0] in want:
            genders[r[6]] = genders.get(r[6], 0) + 1
    got = {r["user_gender"]: (r["n"], r["pct"]) for r in search.gender_share(hits).collect()}
    assert got == {g: (n, round(n * 100.0 / len(want), 2)) for g, n in genders.items()}


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["1", "2", "3"]), st.integers(0, 100000)), min_size=1, max_size=40))
def test_province_sales_matches_brute_force(spark, data):
    from decimal import Decimal

    from shoplens.operators import search
    orders = spark.createDataFrame([(p, c / 100.0) for p, c in data], "province_id string, total_amount double")
    got = {r["province_id"]: (r["order_count"], r["order_amount"], r["band"])
           for r in search.province_sales(orders, width=2, top=6).collect()}
    want = {}
    for p, c in data:
        n, s = want.get(p, (0, Decimal(0)))
        want[p] = (n + 1, s + Decimal(c) / 100)
    assert got == {p: (n, float(s), min((n // 2) * 2, 6)) for p, (n, s) in want.items()}


changes_in = st.lists(st.tuples(
    st.sampled_from(["ROWDATA", "ROWDATA", "TRANSACTIONBEGIN"]),
    st.sampled_from(["order_info", "order_detail", "user_info", "sku_info"]),
    st.sampled_from(["INSERT", "UPDATE", "DELETE"]),
    st.lists(st.lists(st.tuples(st.sampled_from(["id", "a", "b"]), st.one_of(st.none(), st.text("xyz1", max_size=3))),
                      min_size=1, max_size=3, unique_by=lambda c: c[0]), max_size=3)),
    min_size=1, max_size=12)


@SETTINGS
@given(changes_in)
def test_change_routing_matches_brute_force(spark, data):
    import json

    from shoplens.operators import ingest
    topics = {("order_info", "INSERT"): schemas.ORDER_INFO_TOPIC, ("order_detail", "INSERT"): schemas.ORDER_DETAIL_TOPIC,
              ("user_info", "INSERT"): schemas.USER_INFO_TOPIC, ("user_info", "UPDATE"): schemas.USER_INFO_TOPIC}
    envs = spark.createDataFrame(
        [(e, t, k, [[{"name": n, "value": v} for n, v in r] for r in rs], i, None) for i, (e, t, k, rs) in enumerate(data)],
        schemas.CHANGE_ENVELOPE)
    got = sorted((r["topic"], json.dumps(json.loads(r["value"]), sort_keys=True))
                 for r in ingest.route_changes(envs).collect())
    want = sorted((topics[(t, k)], json.dumps(dict(r), sort_keys=True))
                  for e, t, k, rs in data if e == "ROWDATA" and (t, k) in topics for r in rs)
    assert got == want


@SETTINGS
@given(st.dictionaries(st.integers(0, 20), st.integers(0, 500), min_size=1, max_size=12))
def test_day_over_day_matches_brute_force(spark, data):
    from shoplens.operators import metrics
    base = dt.date(2024, 1, 1)
    daily = spark.createDataFrame([((base + dt.timedelta(days=d)).isoformat(), float(v)) for d, v in data.items()],
                                  "day string, value double")
    got = sorted(tuple(r) for r in metrics.day_over_day(daily).collect())
    want = []
    for d, v in data.items():
        prev = data.get(d - 1)
        pct = (float(v) - prev) / prev * 100.0 if prev else None
        want.append(((base + dt.timedelta(days=d)).isoformat(), float(v),
                     float(prev) if prev is not None else None, pct))
    assert got == sorted(want)


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["today", "yesterday"]), st.integers(0, 23),
                          st.integers(1, 50)), max_size=20, unique_by=lambda r: (r[0], r[1])))
def test_hour_table_matches_brute_force(spark, data):
    from shoplens.operators import metrics
    series = spark.createDataFrame([(d, f"{h:02d}", float(v)) for d, h, v in data],
                                   "day string, hour string, value double")
    got = sorted(tuple(r) for r in metrics.hour_table(series).collect())
    vals = {(d, h): float(v) for d, h, v in data}
    want = sorted((f"{h:02d}", vals.get(("yesterday", h), 0.0), vals.get(("today", h), 0.0)) for h in range(24))
    assert got == want


@SETTINGS
@given(pairs_in)
def test_full_outer_rewrite_matches_brute_force(spark, data):
    orders_in, details_in = data
    orders = spark.createDataFrame(
        [(o, "1", "t", "u", "d", T0 // 1000 + s) for o, s in orders_in],
        "id string, order_status string, create_time string, user_id string, create_date string, s long"
    ).selectExpr("*", "timestamp_seconds(s) AS ingest_ts").drop("s")
    details = spark.createDataFrame(
        [(f"d{i}", o, "k", "n", "1.0", T0 // 1000 + s) for i, (o, s) in enumerate(details_in)],
        "id string, order_id string, sku_id string, sku_name string, order_price string, s long"
    ).selectExpr("*", "timestamp_seconds(s) AS ingest_ts").drop("s")
    got = sorted(((r["order_detail_id"] or ""), r["order_id"], r["order_status"] or "")
                 for r in sale_detail.join_all(orders, details).collect())
    ids = {o for o, _ in orders_in}
    want = [(f"d{i}", o, "1" if o in ids else "") for i, (o, _) in enumerate(details_in)]
    want += [("", o, "1") for o in ids if o not in {d for d, _ in details_in}]
    assert got == sorted(want)
