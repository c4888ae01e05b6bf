"""Batch = stream: the foreachBatch runners over time-ordered files give the
batch query's rows; replays and restarts change nothing."""

import json
import time

from pyspark.sql import functions as F

from conftest import SF_SMALL, SF_MID, rows
from martlane.operators import alerts, dau, orders, sales
from martlane.schemas import CLIENT_LOG, DAU_COLUMNS, ORDER_COLUMNS
from martlane.sources import fixtures as fx
from martlane.sources import topics
from martlane.streaming import runners


def write_chunks(df, root, topic, order_col, n):
    """Publish ``df`` as ``n`` files in ``order_col`` order, one after another."""
    bounds = df.approxQuantile(order_col, [i / n for i in range(1, n)], 0.0)
    edges = [None] + bounds + [None]
    for lo, hi in zip(edges[:-1], edges[1:]):
        part = df
        if lo is not None:
            part = part.filter(F.col(order_col) > lo)
        if hi is not None:
            part = part.filter(F.col(order_col) <= hi)
        topics.write_topic(topics.to_topic_records(part.coalesce(1), topic), root=root)
        time.sleep(1.1)


def run_available(query):
    query.awaitTermination()
    assert query.exception() is None


def test_dau_stream_equals_batch(spark, tmp_dir):
    logs = fx.startup_logs(spark, SF_SMALL)
    write_chunks(logs, f"{tmp_dir}/topics", topics.TOPIC_STARTUP, "ts", 4)
    src = topics.read_topic(spark, topics.TOPIC_STARTUP, root=f"{tmp_dir}/topics",
                            max_files_per_trigger=1)
    schema = logs.schema
    parsed = topics.parse_records(src, schema, required="mid")
    q = runners.start_dau_stream(parsed, f"{tmp_dir}/dau", f"{tmp_dir}/ckpt",
                                 {"availableNow": True})
    run_available(q)
    table = runners.dau_table(spark, f"{tmp_dir}/dau")
    (query, last), = table.last_batches().items()
    assert last == 3
    got = table.read()
    want = dau.dau_first_visits(logs)
    assert rows(got, *DAU_COLUMNS) == rows(want, *DAU_COLUMNS)

    # a replayed batch is a no-op; a restart from the checkpoint reads nothing new
    version = table.version()
    assert not table.append(want.limit(3), query, 2)
    q2 = runners.start_dau_stream(parsed, f"{tmp_dir}/dau", f"{tmp_dir}/ckpt",
                                  {"availableNow": True})
    run_available(q2)
    assert table.version() == version

    # a new checkpoint is a new query: nothing is skipped, nothing counts twice
    q3 = runners.start_dau_stream(parsed, f"{tmp_dir}/dau", f"{tmp_dir}/ckpt2", {"availableNow": True})
    run_available(q3)
    assert rows(table.read(), *DAU_COLUMNS) == rows(want, *DAU_COLUMNS)


def test_first_seen_days_are_corrected(spark, tmp_dir):
    """An earlier day that comes later ends the claim of the later day; a batch
    that died between the two tables, or comes again, changes nothing."""
    table, seen = runners.dau_table(spark, f"{tmp_dir}/dau"), runners.first_seen_table(spark, f"{tmp_dir}/seen")
    day = lambda n: 1_704_067_200_000 + n * 86_400_000 + 5
    schema = "mid string, uid string, appid string, area string, os string, ch string, log_type string, vs string, ts long"
    write = runners.dau_batch(table, seen)
    batches = [[("a", 5), ("b", 3), ("b", 4)], [("a", 2), ("b", 3), ("c", 5)], [("a", 1), ("c", 5), ("b", 9)], [("d", 1)]]
    frames = [spark.createDataFrame([(m, *[None] * 7, day(n)) for m, n in b], schema) for b in batches]
    for number, f in enumerate(frames):
        if number == 2:    # dies after the first-seen table
            table.append, real = (lambda *a: (_ for _ in ()).throw(RuntimeError("lost"))), table.append
            try:
                write(f, "q", number)
            except RuntimeError:
                pass
            table.append = real
        write(f, "q", number)
    write(frames[3], "q", 3)
    live = rows(seen.read().filter("live"), "mid", "log_date")
    assert live == [("a", "2024-01-02"), ("b", "2024-01-04"), ("c", "2024-01-06"), ("d", "2024-01-02")]
    per_day = {d: seen.read([d]).filter("live").count() for d in ("2024-01-02", "2024-01-03", "2024-01-04", "2024-01-06")}
    assert per_day == {"2024-01-02": 2, "2024-01-03": 0, "2024-01-04": 1, "2024-01-06": 1}
    assert rows(dau.new_mid(table.read())) == rows(seen.read().filter("live").groupBy("log_date").agg(
        F.count(F.lit(1)).alias("ct")))


def test_order_stream_equals_batch(spark, tmp_dir):
    raw = fx.order_info_raw(spark, SF_SMALL)
    write_chunks(raw, f"{tmp_dir}/topics", topics.TOPIC_ORDER, "ts", 3)
    src = topics.read_topic(spark, topics.TOPIC_ORDER, root=f"{tmp_dir}/topics",
                            max_files_per_trigger=1)
    parsed = topics.parse_records(src, raw.schema, required="id")
    run_available(runners.start_order_stream(parsed, f"{tmp_dir}/orders", f"{tmp_dir}/ck",
                                             {"availableNow": True}))
    got = runners.order_table(spark, f"{tmp_dir}/orders").read()
    want = orders.orders_clean(raw)
    cols = ORDER_COLUMNS
    assert rows(got, *cols) == rows(want, *cols)


def test_alert_stream_matches_batch_closed_windows(spark, tmp_dir):
    ev = fx.event_logs(spark, SF_MID)
    write_chunks(ev, f"{tmp_dir}/topics", topics.TOPIC_EVENT, "ts", 3)
    src = topics.read_topic(spark, topics.TOPIC_EVENT, root=f"{tmp_dir}/topics",
                            max_files_per_trigger=1)
    parsed = topics.parse_records(src, ev.schema, required="mid")
    run_available(runners.start_alert_stream(parsed, f"{tmp_dir}/alerts", f"{tmp_dir}/ck",
                                             7200, 1800, 3, "2 hours", {"availableNow": True}))
    got = runners.alert_table(spark, f"{tmp_dir}/alerts").read()
    want = alerts.alert_per_bucket(alerts.coupon_alerts(ev, 7200, 1800, 3))
    # Append mode holds back windows the watermark has not passed yet.
    max_ts = ev.agg(F.max("ts")).first()[0]
    closed = want.filter(F.col("ts") <= max_ts - 7200 * 1000)
    got_ids = {r.alert_id for r in got.collect()}
    closed_ids = {r.alert_id for r in closed.collect()}
    assert closed_ids and closed_ids <= got_ids <= {r.alert_id for r in want.collect()}
    flat = alerts.alerts_flat
    assert rows(flat(got.drop("alert_date")).filter(F.col("alert_id").isin(*closed_ids))) == \
        rows(flat(closed))


def test_sale_stream_equals_time_bounded_join(spark, tmp_dir):
    o_raw = fx.order_info_raw(spark, SF_SMALL)
    d_raw = fx.order_detail_raw(spark, SF_SMALL).drop("version")
    users = fx.user_info_raw(spark, SF_SMALL)
    bound = 90 * 86400
    # users first, then orders and lines interleaved in time order
    runners.user_table(spark, f"{tmp_dir}/users").append(users, "load", 0)
    write_chunks(o_raw, f"{tmp_dir}/topics", topics.TOPIC_ORDER, "ts", 2)
    write_chunks(d_raw, f"{tmp_dir}/topics", topics.TOPIC_ORDER_DETAIL, "ts", 2)
    os_ = topics.parse_records(topics.read_topic(spark, topics.TOPIC_ORDER, root=f"{tmp_dir}/topics"),
                               o_raw.schema, "id")
    ds_ = topics.parse_records(topics.read_topic(spark, topics.TOPIC_ORDER_DETAIL,
                                                 root=f"{tmp_dir}/topics"), d_raw.schema, "id")
    q = runners.start_sale_stream(os_, ds_, f"{tmp_dir}/sales", f"{tmp_dir}/users", f"{tmp_dir}/ck",
                                  bound, "365 days", fx.USER_AS_OF, {"availableNow": True})
    run_available(q)
    got = runners.sale_table(spark, f"{tmp_dir}/sales").read()
    joined = sales.sale_join(orders.orders_clean(o_raw), d_raw, bound)
    want = sales.enrich_user(sales.sale_detail(joined), sales.user_latest(users), fx.USER_AS_OF)
    want = sales.sale_detail_index(want)
    cols = ["order_detail_id", "order_id", "user_id", "user_age", "user_gender", "sku_price", "dt"]
    assert rows(got, *cols) == rows(want, *cols)


def test_stateful_dedup_equals_batch_and_forgets(spark, tmp_dir):
    """In-order logs: first visits as in the batch; state falls once a day is past."""
    logs = fx.startup_logs(spark, SF_SMALL)
    write_chunks(logs, f"{tmp_dir}/topics", topics.TOPIC_STARTUP, "ts", 6)
    src = topics.read_topic(spark, topics.TOPIC_STARTUP, root=f"{tmp_dir}/topics",
                            max_files_per_trigger=1)
    parsed = topics.parse_records(src, logs.schema, required="mid")
    q = runners.start_dau_stateful_stream(parsed, f"{tmp_dir}/dau", f"{tmp_dir}/ck", {"availableNow": True})
    run_available(q)
    want = dau.dau_first_visits(logs)
    assert rows(runners.dau_table(spark, f"{tmp_dir}/dau").read(), "mid", "log_date") == rows(want, "mid", "log_date")
    state = [p["stateOperators"][0] for p in q.recentProgress if p["stateOperators"]]
    assert sum(s["numRowsRemoved"] for s in state) > 0
    assert max(s["numRowsTotal"] for s in state) < want.count()        # never all pairs at once
    assert not any(s["numRowsDroppedByWatermark"] for s in state)


def test_waiting_rows_expire(spark, tmp_dir):
    """The default bound and watermark: 299 s join, 300 and 301 s do not, rows
    that wait in vain are forgotten, a row behind the watermark is dropped."""
    t0 = 1_700_000_000_000
    order = lambda i, s: {"id": i, "user_id": "u", "create_time": "2023-11-14 10:00:00", "ts": t0 + s * 1000}
    line = lambda i, o, s: {"id": i, "order_id": o, "sku_id": "1", "order_price": "2.5", "ts": t0 + s * 1000}
    batches = [  # each: (orders, lines), one micro-batch
        ([order("a", 0), order("b", 0), order("c", 0), order("alone", 0)], [line("early", "later", -200)]),
        ([order("later", 99)], [line("l299", "a", 299), line("l300", "b", 300), line("l301", "c", 301)]),
        ([order("far", 4000)], [line("lfar", "far", 4000)]),                        # moves the watermark on
        ([order("far2", 8000)], [line("lfar2", "far2", 8000)]),     # runs with it: what waits is forgotten
        ([order("far3", 12000)], [line("too late", "a", 10), line("lfar3", "far3", 12000)]),
    ]
    schema = {topics.TOPIC_ORDER: "id string, user_id string, order_status string, create_time string, "
                                  "consignee_tel string, ts long",
              topics.TOPIC_ORDER_DETAIL: "id string, order_id string, sku_id string, sku_name string, "
                                         "order_price string, ts long"}
    for both in batches:
        for topic, data in zip(schema, both):
            df = spark.createDataFrame([json.dumps(r) for r in data], "string")
            topics.write_topic(df.select(F.lit(topic).alias("topic"), "value").coalesce(1), root=f"{tmp_dir}/t")
        time.sleep(1.1)
    read = {t: topics.parse_records(topics.read_topic(spark, t, root=f"{tmp_dir}/t", max_files_per_trigger=1),
                                    spark.createDataFrame([], s).schema, "id") for t, s in schema.items()}
    q = runners.start_sale_stream(read[topics.TOPIC_ORDER], read[topics.TOPIC_ORDER_DETAIL], f"{tmp_dir}/sales",
                                  f"{tmp_dir}/users", f"{tmp_dir}/ck", as_of="2024-01-01",
                                  trigger={"availableNow": True})
    run_available(q)
    got = rows(runners.sale_table(spark, f"{tmp_dir}/sales").read(), "order_detail_id", "order_id")
    assert got == [("early", "later"), ("l299", "a"), ("lfar", "far"), ("lfar2", "far2"), ("lfar3", "far3")]
    state = [p["stateOperators"][0] for p in q.recentProgress if p["stateOperators"]]
    waiting = [s["numRowsTotal"] for s in state]
    assert max(waiting) > waiting[-1]                                   # state falls
    assert sum(s["numRowsRemoved"] for s in state) > 0
    assert sum(s["numRowsDroppedByWatermark"] for s in state) == 1      # "too late"


def test_two_producers_on_one_root(spark, tmp_dir):
    """Collector and capture publish below one root; neither hides the other,
    a restart publishes nothing twice, and the raw log holds the lines sent."""
    from martlane.sources import cdc
    lines = ['{"type":"startup","mid":"m1","ts":1,"extra":{"deep":[1,2]},"log_id":7}', '{"type":"event","uid":"9"}',
             "not json", '[1]', '{"evid":"coupon","mid":"m2"}']
    topics.write_topic(spark.createDataFrame(lines, "string").select(
        F.lit(topics.TOPIC_LOG).alias("topic"), "value"), root=f"{tmp_dir}/t")
    changes = cdc.cdc_changes_fixture(spark, SF_SMALL)
    topics.write_topic(topics.to_topic_records(changes, topics.TOPIC_CHANGES), root=f"{tmp_dir}/t")

    def both():
        read = lambda t: topics.read_topic(spark, t, root=f"{tmp_dir}/t")
        a = runners.start_collector_stream(read(topics.TOPIC_LOG), f"{tmp_dir}/ck1", {"availableNow": True},
                                           root=f"{tmp_dir}/t", raw_log=f"{tmp_dir}/raw", rejects=f"{tmp_dir}/rej")
        b = runners.start_capture_stream(topics.parse_records(read(topics.TOPIC_CHANGES), changes.schema, "db"),
                                         f"{tmp_dir}/ck2", {"availableNow": True}, root=f"{tmp_dir}/t")
        run_available(a)
        run_available(b)

    values = lambda *ts: sorted(r.value for t in ts for r in topics.read_topic_batch(
        spark, t, f"{tmp_dir}/t").collect())
    both()
    sent = values(topics.TOPIC_STARTUP, topics.TOPIC_EVENT)
    assert len(sent) == 3
    first = json.loads(values(topics.TOPIC_STARTUP)[0])
    assert first.pop("ts") > 1_700_000_000_000                          # stamped over the client's
    assert first == {"type": "startup", "mid": "m1", "extra": {"deep": [1, 2]}, "log_id": 7}
    assert sorted(r.value for r in spark.read.text(f"{tmp_dir}/raw").collect()) == sent     # the very lines
    assert rows(spark.read.parquet(f"{tmp_dir}/rej"), "value", "reason") == [
        ("[1]", "malformed"), ("not json", "malformed")]
    want = sorted(r.value for r in cdc.cdc_records(changes).collect())
    published = (topics.TOPIC_ORDER, topics.TOPIC_ORDER_DETAIL, topics.TOPIC_USER)
    assert values(*published) == want
    both()
    assert values(topics.TOPIC_STARTUP, topics.TOPIC_EVENT) == sent and values(*published) == want


def test_every_record_is_parsed_or_rejected(spark, tmp_dir):
    from martlane.schemas import CLIENT_LOG
    lines = ['{"mid":"m","ts":5}', '{"mid":"m","ts":"x"}', '{"ts":5}', "{", "", '{"mid":"n","new":1}', '"text"', "null"]
    df = spark.createDataFrame(lines, "string")
    good = topics.parse_records(df, CLIENT_LOG, "mid")
    bad = topics.rejected_records(df, CLIENT_LOG, "mid")
    assert sorted((r.mid, r.ts or 0) for r in good.collect()) == [("m", 5), ("n", 0)]
    assert rows(bad, "value", "reason") == sorted(
        [('{"mid":"m","ts":"x"}', "malformed"), ('{"ts":5}', "no mid"), ("{", "malformed"), ("", "malformed"),
         ('"text"', "malformed"), ("null", "malformed")])
    topics.write_topic(df.select(F.lit(topics.TOPIC_EVENT).alias("topic"), "value"), root=f"{tmp_dir}/t")
    q = runners.start_reject_stream(topics.read_topic(spark, topics.TOPIC_EVENT, root=f"{tmp_dir}/t"), CLIENT_LOG,
                                    "mid", topics.TOPIC_EVENT, f"{tmp_dir}/rej", f"{tmp_dir}/ck", {"availableNow": True})
    run_available(q)
    assert rows(spark.read.parquet(f"{tmp_dir}/rej"), "value", "reason") == rows(bad, "value", "reason")
    counts = [p["observedMetrics"][topics.TOPIC_EVENT] for p in q.recentProgress if p["observedMetrics"]]
    assert (sum(c["records"] for c in counts), sum(c["rejected"] for c in counts)) == (8, 6)


def test_apps_and_publisher_end_to_end(spark, tmp_dir):
    """Client logs and order records on topic files -> jobs -> dashboard endpoints."""
    from martlane.plans import publisher
    from martlane.streaming import apps

    client = topics.route_logs(fx.client_logs(spark, SF_SMALL).drop("log_id"))
    topics.write_topic(topics.to_topic_records(client, F.col("topic"), exclude=("topic",)),
                       root=f"{tmp_dir}/topics")
    topics.write_topic(topics.to_topic_records(fx.order_info_raw(spark, SF_SMALL).drop("ts"),
                                               topics.TOPIC_ORDER), root=f"{tmp_dir}/topics")
    wh = f"{tmp_dir}/wh"
    args = apps.parse_args(["--jobs", "dau,orders,alerts", "--warehouse", wh, "--topic-root",
                            f"{tmp_dir}/topics", "--available-now"])
    for q in apps.start_jobs(spark, args).values():
        run_available(q)

    startups = fx.client_logs(spark, SF_SMALL).filter(F.col("type") == "startup")
    want = dau.dau_first_visits(startups.withColumnRenamed("type", "log_type").drop("log_id"))
    want_day = want.filter(F.col("log_date") == "2024-01-15").count()
    total = {r.id: r.value for r in publisher.realtime_total(spark, wh, "2024-01-15").collect()}
    assert total["dau"] == want_day and total["order_amount"] is None
    hours = publisher.realtime_hour(spark, wh, "dau", "2024-01-15")
    assert hours.count() == 24 and sum(r.today for r in hours.collect()) == want_day
    assert publisher.as_json(hours, "map").first().json.startswith('{"today":{"00":')
    amount = publisher.realtime_hour(spark, wh, "order_amount", "1997-02-01").collect()
    want_amount = orders.orders_clean(fx.order_info_raw(spark, SF_SMALL)).filter(
        F.col("create_date") == "1997-02-01").agg(F.sum("total_amount")).first()[0] or 0.0
    assert abs(sum(r.today for r in amount) - want_amount) < 1e-6
    assert publisher.realtime_hour(spark, wh, "other", "2024-01-15") is None
    # an endpoint lists the folders of its two days and no others
    read = publisher.realtime_hour(spark, wh, "order_amount", "1997-02-01").inputFiles()
    assert read and all("_part=1997-02-01/" in f or "_part=1997-01-31/" in f for f in read)
    rep = publisher.sale_detail(spark, wh, "1997-02-01", "widget", 1, 10).first()
    assert rep.total == 0     # no sale job ran: empty index, empty report


def test_producers_to_consumers_to_endpoints(spark, tmp_dir):
    """Client log lines and the change log through collector and capture, all six
    consumers and the reject job, to the three endpoints."""
    from martlane.plans import publisher, search
    from martlane.schemas import ORDER_DETAIL, ORDER_INFO, USER_INFO
    from martlane.sources import cdc
    from martlane.streaming import apps

    root, wh = f"{tmp_dir}/topics", f"{tmp_dir}/wh"
    client = fx.client_logs(spark, SF_SMALL)
    lines = topics.to_topic_records(client, topics.TOPIC_LOG).union(spark.createDataFrame(
        [(topics.TOPIC_LOG, "no json"), (topics.TOPIC_LOG, '{"type":"startup","uid":"5"}')], "topic string, value string"))
    topics.write_topic(lines, root=root)
    changes = cdc.cdc_changes_fixture(spark, SF_SMALL)
    topics.write_topic(topics.to_topic_records(changes, topics.TOPIC_CHANGES), root=root)

    def run(jobs):
        args = apps.parse_args(["--jobs", jobs, "--warehouse", wh, "--topic-root", root, "--available-now"])
        for q in apps.start_jobs(spark, args).values():
            run_available(q)

    run("collector,capture")
    run("users,rejects")
    run("dau,orders,first_orders,alerts,sales")

    # the batch queries over what capture lets through
    sent = cdc.cdc_records(changes)
    parsed = lambda topic, schema: topics.parse_records(sent.filter(F.col("topic") == topic), schema, "id")
    o = orders.orders_clean(parsed(topics.TOPIC_ORDER, ORDER_INFO))
    stored = runners.order_table(spark, f"{wh}/order_info").read()
    assert rows(stored, "id", "create_date", "total_amount") == rows(o, "id", "create_date", "total_amount")
    flagged = runners.flagged_orders(spark, f"{wh}/order_info_flagged", f"{wh}/first_order_users")
    assert rows(flagged, "id", "is_first_order") == rows(orders.first_order_flag(o), "id", "is_first_order")
    users = parsed(topics.TOPIC_USER, USER_INFO)
    assert rows(runners.user_table(spark, f"{wh}/user_info").read(), "id", "gender") == rows(users, "id", "gender")
    joined = sales.sale_join(o.withColumn("ts", F.lit(0)), parsed(topics.TOPIC_ORDER_DETAIL, ORDER_DETAIL)
                             .dropDuplicates(["id"]).withColumn("ts", F.lit(0)), None)
    sold = sales.enrich_user(sales.sale_detail(joined), users, F.current_date())
    cols = ["order_detail_id", "order_id", "user_id", "user_gender", "user_age", "sku_price", "dt"]
    assert rows(runners.sale_table(spark, f"{wh}/sale_detail").read(), *cols) == rows(sold, *cols)

    # the endpoints
    devices = client.filter("type = 'startup'").select("mid").distinct().count()
    days = [r[0] for r in runners.dau_table(spark, f"{wh}/dau").read().select("log_date").distinct().collect()]
    total = [publisher.realtime_total(spark, wh, d) for d in days]   # stamped today (two days around midnight)
    assert sum(r.value for t in total for r in t.collect() if r.id == "dau") >= devices
    assert sum(r.value for t in total for r in t.collect() if r.id == "new_mid") == devices
    assert '"id":"new_mid"' in publisher.as_json(total[0], "list").first().json
    assert f'"value":{devices}' in publisher.as_json(total[0], "list").first().json or len(days) > 1
    day = o.groupBy("create_date").agg(F.sum("total_amount").alias("s")).orderBy(F.desc("s")).first()
    hours = publisher.realtime_hour(spark, wh, "order_amount", day.create_date).collect()
    assert len(hours) == 24 and abs(sum(r.today for r in hours) - day.s) < 1e-6
    want = search.sale_search(sold.filter(F.col("dt") == day.create_date), "widget").count()
    got = publisher.sale_detail(spark, wh, day.create_date, "widget", 1, 5).first()
    assert got.total == want and len(got.detail) == min(5, want)
    rejected = rows(spark.read.parquet(f"{wh}/rejected"), "topic", "value", "reason")
    assert ("SHOP_LOG", "no json", "malformed") in rejected
    assert [r for r in rejected if r[0] == topics.TOPIC_STARTUP and r[2] == "no mid"]
    assert len(rejected) == 2
