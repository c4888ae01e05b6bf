"""Edge rows for DAU, alerts, the sale join, enrichment, search and CDC."""

from pyspark.sql import functions as F

from conftest import rows
from martlane.operators import alerts, dau, orders, sales
from martlane.plans import dashboard, search
from martlane.sources import cdc, topics

LOG = "mid string, uid string, appid string, area string, os string, ch string, " \
      "log_type string, vs string, ts long, log_id long"


def logs(spark, data):
    return spark.createDataFrame([(m, "u", None, None, None, None, "startup", None, ts, i)
                                  for i, (m, ts) in enumerate(data)], LOG)


def test_dau_midnight_ties_and_late(spark):
    t0 = 1705363199000   # 2024-01-15 23:59:59 UTC
    df = logs(spark, [("a", t0), ("a", t0 + 2000),           # two days
                      ("b", t0 - 5000), ("b", t0 - 5000),     # equal ts -> lower log_id
                      ("a", t0 - 3600_000)])                  # late record of the same day
    got = rows(dau.dau_first_visits(df), "mid", "log_date", "log_hour", "ts")
    assert got == [("a", "2024-01-15", "22", t0 - 3600_000), ("a", "2024-01-16", "00", t0 + 2000),
                   ("b", "2024-01-15", "23", t0 - 5000)]


def test_anti_seen_and_new_mid(spark):
    t0 = 1705363199000
    df = dau.with_log_date_hour(logs(spark, [("a", t0), ("b", t0), ("a", t0 + 2000)]))
    seen = spark.createDataFrame([("a", "2024-01-15")], "mid string, log_date string")
    assert rows(dau.anti_seen(df, seen), "mid") == [("a",), ("b",)]
    fv = dau.dau_first_visits(logs(spark, [("a", t0), ("b", t0 + 2000), ("a", t0 + 2000)]))
    assert rows(dau.new_mid(fv), "log_date", "ct") == [("2024-01-15", 1), ("2024-01-16", 1)]
    assert dau.new_mid(fv, "2024-01-16").first()["ct"] == 1


EV = "mid string, uid string, evid string, itemid string, ts long"


def test_coupon_alert_rules(spark):
    base = 1_700_000_000_000 - 1_700_000_000_000 % 30_000   # on a window boundary
    ev = [
        # m1: two coupon uids -> no alert
        ("m1", "1", "coupon", "10", base), ("m1", "2", "coupon", "11", base + 1000),
        # m2: three uids -> alert
        ("m2", "1", "coupon", "10", base), ("m2", "2", "coupon", "10", base + 1000),
        ("m2", "3", "coupon", "12", base + 2000), ("m2", "3", "addCart", "12", base + 2500),
        # m3: three uids and a click -> no alert
        ("m3", "1", "coupon", "1", base), ("m3", "2", "coupon", "1", base),
        ("m3", "3", "coupon", "1", base), ("m3", "3", "clickItem", "1", base + 10),
        # m4: null uid as the third -> dropped, no alert
        ("m4", "1", "coupon", "1", base), ("m4", "2", "coupon", "1", base),
        ("m4", None, "coupon", "1", base),
        # m5: the same uid thrice -> no alert
        ("m5", "7", "coupon", "1", base), ("m5", "7", "coupon", "1", base),
        ("m5", "7", "coupon", "1", base),
        # m6: coupons in different slides of one 30 s window -> alert in the shared windows
        ("m6", "1", "coupon", "1", base), ("m6", "2", "coupon", "1", base + 12_000),
        ("m6", "3", "coupon", "1", base + 24_000),
    ]
    df = spark.createDataFrame(ev, EV)
    got = alerts.coupon_alerts(df, 30, 5, 3)
    by_mid = {}
    for r in got.collect():
        by_mid.setdefault(r.mid, []).append(r)
    assert set(by_mid) == {"m2", "m6"}
    m2 = sorted(by_mid["m2"], key=lambda r: r.ts)[0]
    assert m2.uids == ["1", "2", "3"] and m2.item_ids == ["10", "12"]
    assert [(e.evid, e.n) for e in m2.events] == [("addCart", 1), ("coupon", 3)]
    # m6: only windows holding base, base+12s and base+24s: starts base-5s and base
    assert sorted(r.ts - base for r in by_mid["m6"]) == [25_000, 30_000]
    # pane plan == native F.window plan
    native = alerts._coupon_alerts_native(df, 30, 5, 3, 60)
    assert rows(alerts.alerts_flat(got)) == rows(alerts.alerts_flat(native))


def test_alert_per_bucket(spark):
    a = spark.createDataFrame(
        [("m_1", "m", ["1"], ["2"], 120_000), ("m_1", "m", ["9"], ["2"], 125_000),
         ("m_2", "m", ["1"], ["2"], 180_000)],
        "alert_id string, mid string, uids array<string>, item_ids array<string>, ts long")
    got = rows(alerts.alert_per_bucket(a), "alert_id", "ts")
    assert got == [("m_1", 125_000), ("m_2", 180_000)]


O = "id string, order_status string, create_time string, user_id string, consignee_tel string, " \
    "total_amount double, ts long"
D = "id string, order_id string, sku_name string, sku_id string, order_price string, ts long"


def test_sale_join_bounds(spark):
    t = 1_000_000_000_000
    o = orders.orders_clean(spark.createDataFrame(
        [("1", "1", "2019-03-04 10:00:00", "u1", "138", 5.0, t),
         ("2", "1", "2019-03-04 11:00:00", "u2", "139", 6.0, t)], O))
    d = spark.createDataFrame(
        [("d299", "1", "x", "s", "1.5", t + 299_000), ("d300", "1", "x", "s", "1.5", t + 300_000),
         ("d301", "1", "x", "s", "1.5", t + 301_000), ("dbefore", "1", "x", "s", "2", t - 10_000),
         ("dmany1", "2", "x", "s", "1", t), ("dmany2", "2", "x", "s", "1", t),
         ("dmany3", "2", "x", "s", "1", t), ("orphan", "9", "x", "s", "1", t)], D)
    got = {r.order_detail_id for r in sales.sale_join(o, d, 300).collect()}
    assert got == {"d299", "dbefore", "dmany1", "dmany2", "dmany3"}
    assert sales.sale_join(o, d, None).count() == 7


def test_enrich_user(spark):
    s = spark.createDataFrame([("d1", "u1"), ("d2", "u9")], "order_detail_id string, user_id string")
    users = spark.createDataFrame(
        [("u1", "n", "1", "2000-01-01", "M", 1), ("u1", "n", "2", "1990-01-01", "F", 2)],
        "id string, login_name string, user_level string, birthday string, gender string, seq long")
    got = rows(sales.enrich_user(s, sales.user_latest(users), "2020-01-01"),
               "order_detail_id", "user_gender", "user_age", "user_level")
    assert got == [("d1", "F", 30, "2"), ("d2", None, 0, None)]


SALE = "order_detail_id string, order_id string, order_status string, create_time string, " \
       "user_id string, sku_id string, user_gender string, user_age int, user_level string, " \
       "sku_price double, sku_name string, dt string"


def test_search_report(spark):
    data = [(f"d{i:02d}", "o", "1", "t", "u", "s", g, a, "1", 1.0, n, "2019-03-04")
            for i, (g, a, n) in enumerate([("F", 18, "red widget"), ("F", 25, "blue widget"),
                                           (None, 40, "Widget red"), ("F", 30, "red gear")])]
    df = spark.createDataFrame(data, SALE)
    assert search.sale_search(df, "").count() == 0                 # empty keyword: no hits
    assert search.sale_search(df, "", match_all_on_empty=True).count() == 4
    assert search.sale_search(df, "Red WIDGET").count() == 2
    assert search.sale_search(df, "widget", "2019-03-05").count() == 0
    rep = search.sale_detail_report(df, "2019-03-04", "widget", 1, 2, nested=False).first()
    assert (rep.total, rep.age_lt20, rep.age_20to30, rep.age_gt30) == (3, 33.3, 33.3, 33.3)
    assert (rep.male, rep.female, rep.detail_ids) == (0.0, 66.7, "d00,d01")
    past = search.sale_detail_report(df, "2019-03-04", "widget", 5, 2, nested=False).first()
    assert past.total == 3 and past.detail_ids == ""
    none = search.sale_detail_report(df, "2019-03-04", "nothing", 1, 2, nested=False).first()
    assert (none.total, none.male) == (0, 0.0)
    nested = search.sale_detail_report(df, "2019-03-04", "widget", 1, 10).first()
    assert [o.name for o in nested.stat[1].options] == ["男", "女"]
    assert len(nested.detail) == 3
    assert search.page_from_offset(20, 10) == 3
    terms = rows(search.terms_agg(search.sale_search(df, "widget"), "user_gender", 2))
    assert terms == [("F", 2)]


def test_realtime_hour_fill(spark):
    fv = spark.createDataFrame([("a", "2024-01-15", "03"), ("b", "2024-01-14", "03"),
                                ("c", "2024-01-15", "23")], "mid string, log_date string, log_hour string")
    got = dashboard.realtime_hour("dau", fv, None, "2024-01-15").collect()
    assert len(got) == 24
    by_hour = {r.hour: (r.today, r.yesterday) for r in got}
    assert by_hour["03"] == (1.0, 1.0) and by_hour["23"] == (1.0, 0.0) and by_hour["00"] == (0.0, 0.0)
    assert dashboard.realtime_hour("other", fv, None, "2024-01-15") is None


def test_route_logs(spark):
    df = spark.createDataFrame([("startup",), ("event",), (None,)], "type string")
    got = [r.topic for r in topics.route_logs(df).collect()]
    assert got == [topics.TOPIC_STARTUP, topics.TOPIC_EVENT, topics.TOPIC_EVENT]
    raw = spark.createDataFrame([('{"type":"startup","mid":"m1","pgid":12}',), ("not json",)],
                                "value string")
    from martlane.schemas import CLIENT_LOG
    parsed = topics.parse_records(raw, CLIENT_LOG, required="mid").collect()
    assert len(parsed) == 1 and parsed[0].pgid == "12"
    stamped = topics.stamp_ingest_ts(spark.createDataFrame([(1,)], "ts long"), 99).first()
    assert stamped.ts == 99


def test_cdc_route_matrix(spark):
    def entry(table, op, n_rows=1, entry_type="ROWDATA", db="shop"):
        rows_ = [{"after": [{"name": "id", "value": str(i)}, {"name": "t", "value": table}]}
                 for i in range(n_rows)]
        return (db, table, entry_type, op, 1, rows_)
    data = [entry(t, op) for t in ("order_info", "order_detail", "user_info", "other")
            for op in ("INSERT", "UPDATE", "DELETE")]
    data += [entry("order_info", None, 0, "TRANSACTIONBEGIN"), entry("order_info", None, 0, "TRANSACTIONEND"),
             entry("order_detail", "INSERT", 3), entry("order_info", "INSERT", 1, db="elsewhere")]
    from martlane.schemas import CDC_CHANGE
    df = spark.createDataFrame(data, CDC_CHANGE)
    got = cdc.cdc_records(df).collect()
    topics_ = sorted((r.topic, r.table_name, r.event_type) for r in got)
    assert topics_ == sorted([("SHOP_ORDER", "order_info", "INSERT")]
                             + [("SHOP_ORDER_DETAIL", "order_detail", "INSERT")] * 4
                             + [("SHOP_USER", "user_info", "INSERT"), ("SHOP_USER", "user_info", "UPDATE")])
    assert got[0].value.startswith('{"id":"0"')


def test_first_order_flag_with_seen_users(spark):
    o = spark.createDataFrame(
        [("1", "u1", "2019-01-02 00:00:00"), ("2", "u1", "2019-01-01 00:00:00"),
         ("3", "u2", "2019-01-01 00:00:00"), ("4", "u3", "2019-01-05 00:00:00"),
         ("5", "u3", "2019-01-05 00:00:00")], "id string, user_id string, create_time string")
    got = rows(orders.first_order_flag(o), "id", "is_first_order")
    assert got == [("1", "0"), ("2", "1"), ("3", "1"), ("4", "1"), ("5", "0")]
    seen = spark.createDataFrame([("u1",)], "user_id string")
    got = rows(orders.first_order_flag(o, seen), "id", "is_first_order")
    assert got == [("1", "0"), ("2", "0"), ("3", "1"), ("4", "1"), ("5", "0")]


def test_report_params_and_label():
    from martlane.plans.search import report_params
    assert report_params() == {"date": "2019-03-04", "keyword": "", "page_no": 1, "size": 10}
    assert report_params(40, 20, "2024-01-01", "red")["page_no"] == 3


def test_coupon_alert_parts_match_documents(spark):
    base = 1_700_000_000_000 - 1_700_000_000_000 % 30_000
    ev = [("m2", "1", "coupon", "10", base), ("m2", "2", "coupon", "10", base + 1000),
          ("m2", "3", "coupon", None, base + 2000), ("m2", "3", "addCart", "12", base + 2500),
          ("m3", "1", "coupon", "1", base), ("m3", "2", "coupon", "1", base),
          ("m3", "3", "coupon", "1", base), ("m3", "3", "clickItem", "1", base + 10)]
    df = spark.createDataFrame(ev, EV)
    header, uids, items, events = alerts.coupon_alert_parts(df, 30, 5, 3)
    # windows ending in the same minute share an alert id: the window end tells them apart
    docs = {(r.alert_id, r.ts): r for r in alerts.coupon_alerts(df, 30, 5, 3).collect()}
    heads = {(r.alert_id, r.ts): r for r in header.collect()}
    assert set(docs) == set(heads) and len(docs) == 6          # m2 in its six windows
    for aid, h in heads.items():
        assert h.n_uids == len(docs[aid].uids) == 3
        assert h.n_items == len(docs[aid].item_ids) == 1        # null item ids are not items
    assert uids.count() == 18 and items.count() == 6
    got = {(r.alert_id, r.ts): {} for r in events.collect()}
    for r in events.collect():
        got[r.alert_id, r.ts][r.evid] = r.n
    assert got == {k: {e.evid: e.n for e in d.events} for k, d in docs.items()}


def test_alert_keeps_every_event_id(spark):
    base = 1_700_000_000_000 - 1_700_000_000_000 % 30_000
    ev = [("m", str(i), "coupon", "10", base + i) for i in range(3)]
    ev += [("m", "1", f"kind_{i % 40}", None, base + 5) for i in range(60)] + [("m", "1", None, None, base + 6)]
    df = spark.createDataFrame(ev, EV)
    events = alerts.coupon_alert_parts(df, 30, 30, 3)[3].collect()
    assert {r.evid: r.n for r in events} == {"coupon": 3, "": 1} | {f"kind_{i}": 1 + (i < 20) for i in range(40)}
    doc = alerts.coupon_alerts(df, 30, 30, 3).first()
    assert len(doc.events) == 42 and {e.evid: e.n for e in doc.events} == {r.evid: r.n for r in events}
