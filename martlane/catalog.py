"""Named batch queries over the driver tables: ``name -> f(spark, sf_dir) -> DataFrame``.

Every entry reads whole tables (or what Spark derives from them) and uses
the fixture parameters from FIXTURES.md.  The matching DuckDB SQL lives in
``martlane.oracle``; result column names are identical on both sides.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martlane.functions.scalar import age_365, age_band
from martlane.operators import alerts, dau, orders, sales
from martlane.plans import dashboard, search
from martlane.plans.derived import derived_table
from martlane.schemas import CLIENT_LOG
from martlane.sources import cdc, topics
from martlane.streaming import runners
from martlane.streaming.replay import replay
from martlane.sources import fixtures as fx

# Fixed parameters of the registered queries (FIXTURES.md).
DAU_DAY = "2024-01-15"
NEW_MID_DAY = "2024-01-01"
ORDER_DAY = "1997-02-01"
LOG_SHIFT_DAYS = 9830                  # from NEW_MID_DAY back to ORDER_DAY
ROUND = 2
SALE_JOIN_BOUND_SECONDS = 90 * 86400   # order date against ship date, strict
SEARCH_KEYWORD = "Widget cold"
REPORT_KEYWORD = "widget"
SEARCH_DAY = "1997-02-01"
REPORT_PAGE, REPORT_SIZE = 2, 10
PAGE_NO, PAGE_SIZE = 3, 20
ALERT_WINDOW_SECONDS = 2 * 3600
ALERT_SLIDE_SECONDS = 30 * 60
COLLECTED_AT_MS = 1_704_067_200_000     # the collector's clock in its stream twin
STREAM_BATCHES = 4                     # micro-batches a stream twin replays its input in
ALERT_WATERMARK = "2 hours"
# The sale replay's clock runs so much faster than the tables' that the bound
# of 90 days becomes the product's 300 s, under the product's own watermark.
SALE_SPEEDUP = SALE_JOIN_BOUND_SECONDS // sales.JOIN_BOUND_SECONDS
ALERT_HOUR_SECONDS = 3600              # bucket in which several windows share an alert id
TOP_AGES = 5                           # fewer than there are ages: the size cuts
BAD_EVERY, NO_MID_EVERY, BAD_TS_EVERY = 5, 7, 11   # broken lines of the reject fixture


def _r(col: str):
    return F.round(F.col(col), ROUND).alias(col)


# ---------------------------------------------------------------- DAU family

def _src(d: str, *names: str) -> list[str]:
    return [f"{d.rstrip('/')}/{n}.parquet" for n in names]


def _first_visits(spark, d) -> DataFrame:
    """The DAU table (one first visit per device and day), built once per input."""
    return derived_table(spark, "dau", _src(d, "events"),
                         lambda: dau.dau_first_visits(fx.startup_logs(spark, d)), ["log_date"])


def q_dau_first_visits(spark, d):
    return _first_visits(spark, d).select("mid", "uid", "appid", "log_type", "log_date",
                                          "log_hour", "ts")


def q_dau_total(spark, d):
    return dashboard.dau_total(_first_visits(spark, d))


def q_dau_total_day(spark, d):
    return dashboard.dau_total(_first_visits(spark, d), DAU_DAY)


def q_dau_hour(spark, d):
    return dashboard.dau_hour(_first_visits(spark, d))


def q_dau_hour_day(spark, d):
    return dashboard.dau_hour(_first_visits(spark, d), DAU_DAY)


def q_new_mid(spark, d):
    return dau.new_mid(_first_visits(spark, d))


def q_new_mid_day(spark, d):
    return dau.new_mid(_first_visits(spark, d), NEW_MID_DAY)


# ------------------------------------------------------------- order family

def _orders(spark, d) -> DataFrame:
    """The order table (masked phone, create date and hour), built once per input."""
    return derived_table(spark, "orders", _src(d, "orders"),
                         lambda: orders.orders_clean(fx.order_info_raw(spark, d)), ["create_date"])


def q_orders_clean(spark, d):
    return _orders(spark, d).select("id", "user_id", "consignee_tel", "order_status",
                                    "total_amount", "create_time", "create_date", "create_hour")


def q_order_amount_total(spark, d):
    return dashboard.order_amount_total(_orders(spark, d)).select("create_date", _r("order_amount"))


def q_order_amount_total_day(spark, d):
    return dashboard.order_amount_total(_orders(spark, d), ORDER_DAY).select(_r("order_amount"))


def q_order_amount_hour(spark, d):
    return dashboard.order_amount_hour(_orders(spark, d)).select(
        "create_date", "create_hour", _r("order_amount"))


def q_first_order_flag(spark, d):
    return orders.first_order_flag(_orders(spark, d)).select("id", "user_id", "create_time",
                                                             "is_first_order")


def q_order_amount_by_province(spark, d):
    out = dashboard.order_amount_by_province(_orders(spark, d), fx.user_province(spark, d))
    return out.select("province_id", "create_date", _r("order_amount"))


# -------------------------------------------------------- dashboard composites

def q_realtime_total(spark, d):
    fv = _first_visits(spark, d)
    out = dashboard.realtime_total(fv, _orders(spark, d), dau.new_mid(fv))
    return out.select("date", "id", "name", _r("value"))


def q_realtime_total_day(spark, d):
    fv = _first_visits(spark, d)
    out = dashboard.realtime_total(fv, _orders(spark, d), dau.new_mid(fv, DAU_DAY), DAU_DAY)
    return out.select("id", "name", _r("value"))


def q_realtime_total_busy_day(spark, d):
    """A day with visits, new devices and orders: the logs moved onto the orders' calendar."""
    logs = fx.startup_logs(spark, d).withColumn("ts", F.col("ts") - LOG_SHIFT_DAYS * 86_400_000)
    fv = dau.dau_first_visits(logs)
    out = dashboard.realtime_total(fv, _orders(spark, d), dau.new_mid(fv, ORDER_DAY), ORDER_DAY)
    return out.select("id", "name", _r("value"))


def q_realtime_hour_dau(spark, d):
    return dashboard.realtime_hour("dau", _first_visits(spark, d), _orders(spark, d))


def q_realtime_hour_dau_day(spark, d):
    return dashboard.realtime_hour("dau", _first_visits(spark, d), _orders(spark, d), DAU_DAY)


def q_realtime_hour_amount(spark, d):
    out = dashboard.realtime_hour("order_amount", _first_visits(spark, d), _orders(spark, d))
    return out.select("date", "hour", _r("today"), _r("yesterday"))


# ------------------------------------------------------- sales and search

def _users(spark, d) -> DataFrame:
    """The user dimension (latest profile per id), built once per input."""
    return derived_table(spark, "users", _src(d, "customer"),
                         lambda: sales.user_latest(fx.user_profile_versions(spark, d)))


def q_user_latest(spark, d):
    return _users(spark, d).select("id", "login_name", "user_level", "birthday", "gender")


def q_user_age_bands(spark, d):
    ages = _users(spark, d).select(age_band(age_365("birthday", fx.USER_AS_OF)).alias("band"))
    return ages.groupBy("band").agg(F.count(F.lit(1)).alias("ct"))


def q_sale_join(spark, d):
    j = sales.sale_join(_orders(spark, d), fx.order_detail_raw(spark, d), SALE_JOIN_BOUND_SECONDS)
    return j.select("order_detail_id", "order_id", "order_status", "create_time", "user_id",
                    "sku_id", "sku_price", "sku_name", "dt")


def build_sale_index(spark, d) -> DataFrame:
    """All order lines joined to their order by key, enriched with the latest
    user, one document per line id (the search index's upsert)."""
    # Lines are deduplicated by id first, on the narrow line rows: every other
    # field of a document follows from the order id inside the line id, so
    # this equals deduplicating the joined documents, at a fraction of the width.
    raw = fx.order_detail_raw(spark, d).select("id", "order_id", "sku_name", "sku_id", "order_price", "version")
    # One shuffle by order serves both this and the join: an id of four numbers
    # holds the order's.  Ids that lack a number (a null key) may not, and could
    # be those of several orders.
    whole = F.regexp_count("id", F.lit(r"\d+")) == 4
    lines = sales.latest_line(raw.filter(whole).repartition("order_id"), ["order_id", "id"])
    lines = lines.withColumn("ts", F.col("version.ts"))
    others = sales.latest_line(raw.filter(~whole)).withColumn("ts", F.col("version.ts"))
    # An order's lines share its user: the fewer and narrower orders are enriched.
    users = sales.enrich_user(_orders(spark, d), _users(spark, d), fx.USER_AS_OF)
    joined = sales.sale_join(users, lines, None).unionByName(sales.sale_join(users, others, None))
    return search.with_terms(sales.sale_detail(joined).drop("version"))


def sale_index(spark, d) -> DataFrame:
    """The sale-detail index, built once per input and then scanned by the search queries."""
    return derived_table(spark, "sale_index", _src(d, "orders", "lineitem", "part", "customer"),
                         lambda: build_sale_index(spark, d), ["dt"], [fx.USER_AS_OF])


def q_sale_detail(spark, d):
    return sale_index(spark, d).drop(search.TERMS_COL)


def q_sale_search(spark, d):
    return search.sale_search(sale_index(spark, d), SEARCH_KEYWORD)


def q_sale_search_day(spark, d):
    return search.sale_search(sale_index(spark, d), REPORT_KEYWORD, SEARCH_DAY)


def sale_postings(spark, d) -> DataFrame:
    """The index's posting table, built once per input: each part of the index has
    its postings in one file, in the order of their terms, as a search store's
    segments do.  Nothing is shuffled, and a term's pages are found in each file
    by its column index."""
    return derived_table(spark, "sale_postings", _src(d, "orders", "lineitem", "part", "customer"),
                         lambda: search.posting_rows(sale_index(spark, d)),
                         ["term", "dt"], [fx.USER_AS_OF])


def q_sale_search_postings(spark, d):
    return search.search_by_postings(sale_postings(spark, d), sale_index(spark, d), SEARCH_KEYWORD)


def q_sale_page_after(spark, d):
    before = search.page(_report_hits(spark, d), PAGE_NO - 1, PAGE_SIZE).agg(F.max("order_detail_id")).first()[0]
    return search.page_after(_report_hits(spark, d), before, PAGE_SIZE)


def _report_hits(spark, d):
    return search.sale_search(sale_index(spark, d), REPORT_KEYWORD)


def q_sale_gender_terms(spark, d):
    return search.terms_agg(_report_hits(spark, d), "user_gender", search.GENDER_TERMS_SIZE)


def q_sale_age_terms(spark, d):
    return search.terms_agg(_report_hits(spark, d), "user_age", search.AGE_TERMS_SIZE)


def q_sale_age_terms_top(spark, d):
    return search.terms_agg(_report_hits(spark, d), "user_age", TOP_AGES)


def q_sale_age_stat(spark, d):
    return search.age_stat(_report_hits(spark, d))


def q_sale_gender_stat(spark, d):
    return search.gender_stat(_report_hits(spark, d))


def q_sale_page(spark, d):
    return search.page(_report_hits(spark, d), PAGE_NO, PAGE_SIZE)


def q_sale_detail_report(spark, d):
    return search.sale_detail_report(sale_index(spark, d), None, REPORT_KEYWORD, REPORT_PAGE,
                                     REPORT_SIZE, nested=False)


def _report_nested(spark, d) -> DataFrame:
    """The report as the dashboard asks for it: total, stat, detail."""
    asked = search.report_params((REPORT_PAGE - 1) * REPORT_SIZE, REPORT_SIZE, SEARCH_DAY,
                                 REPORT_KEYWORD)
    return search.sale_detail_report(sale_index(spark, d), **asked)


def q_sale_report_stat(spark, d):
    option = _report_nested(spark, d).select("total", F.explode("stat").alias("s")).select(
        "total", F.col("s.title").alias("title"), F.explode("s.options").alias("o"))
    return option.select("total", "title", F.col("o.name").alias("name"),
                         F.col("o.value").alias("value"))


def q_sale_report_detail(spark, d):
    return _report_nested(spark, d).select(F.inline("detail"))


# ------------------------------------------------------------------ alerts

def _alert_values(spark, d) -> DataFrame:
    """Per-window event counts and distinct coupon accounts/items, built once per input."""
    return derived_table(spark, "alert_values", _src(d, "events"),
                         lambda: alerts.window_values(fx.event_logs(spark, d), ALERT_WINDOW_SECONDS,
                                                      ALERT_SLIDE_SECONDS), ["mid", "window_start"],
                         [ALERT_WINDOW_SECONDS, ALERT_SLIDE_SECONDS])


def _alert_parts(spark, d, bucket_seconds: int = alerts.BUCKET_SECONDS):
    return alerts.parts_from_values(_alert_values(spark, d), ALERT_WINDOW_SECONDS,
                                    alerts.MIN_UIDS, bucket_seconds)


def _alerts(spark, d, bucket_seconds: int = alerts.BUCKET_SECONDS) -> DataFrame:
    return alerts.alert_documents(*_alert_parts(spark, d, bucket_seconds))


def q_coupon_alert(spark, d):
    return alerts.alerts_flat(_alerts(spark, d))


def q_coupon_alert_per_bucket(spark, d):
    return alerts.alerts_flat(alerts.alert_per_bucket(_alerts(spark, d)))


def q_coupon_alert_per_hour(spark, d):
    return alerts.alerts_flat(alerts.alert_per_bucket(_alerts(spark, d, ALERT_HOUR_SECONDS)))


def q_coupon_alert_events(spark, d):
    return _alert_parts(spark, d)[3].select("alert_id", "ts", "evid", "n")


def q_coupon_alert_header(spark, d):
    parts = _alert_parts(spark, d)
    header = alerts.with_events(parts[0], parts[3])
    return header.select("alert_id", "mid", "n_uids", "n_items",
                         alerts.events_text("events").alias("events"), "ts")


def q_coupon_alert_uids(spark, d):
    return _alert_parts(spark, d)[1].select("alert_id", "ts", "uid")


def q_coupon_alert_items(spark, d):
    return _alert_parts(spark, d)[2].select("alert_id", "ts", "itemid")


# ------------------------------------------------------------------ ingest

def q_route_logs(spark, d):
    routed = topics.route_logs(fx.client_logs(spark, d))
    return routed.select("topic", "log_id", "type", "mid", "uid", "evid", "itemid", "ts")


def _broken_lines(spark, d) -> DataFrame:
    """Client log lines of which some are cut short, lack ``mid`` or have a
    ``ts`` that is no number; with the ``log_id`` they came from."""
    line = F.to_json(F.struct("type", "mid", "uid", "evid", "itemid", "ts"))
    no_mid = F.to_json(F.struct("type", "uid", "ts"))
    bad_ts = F.regexp_replace(line, '"ts":', '"ts":"at ')
    i = F.col("log_id")
    value = (F.when(i % BAD_EVERY == 0, F.expr("substring(_line, 1, length(_line) - 3)"))
             .when(i % NO_MID_EVERY == 0, no_mid)
             .when(i % BAD_TS_EVERY == 0, F.concat(F.expr("substring(_bad, 1, length(_bad) - 1)"), F.lit('"}')))
             .otherwise(F.col("_line")))
    return fx.client_logs(spark, d).withColumns({"_line": line, "_bad": bad_ts}).select("log_id", value.alias("value"))


def q_accepted_logs(spark, d):
    parsed = topics.parse_records(_broken_lines(spark, d).select("value"), CLIENT_LOG, "mid")
    return parsed.select("type", "mid", "uid", "evid", "itemid", "ts")


def q_rejected_logs(spark, d):
    rejected = topics.rejected_records(_broken_lines(spark, d).select("value"), CLIENT_LOG, "mid")
    return rejected.groupBy("reason").agg(F.count(F.lit(1)).alias("ct"))


def _changes(spark, d) -> DataFrame:
    """The captured change log of the three source tables (the CDC input).

    Generated on the fly: writing its nested rows to parquet costs more
    than deriving them again from the flat tables.
    """
    return cdc.cdc_changes_fixture(spark, d)


def q_cdc_after_image(spark, d):
    rows = cdc.cdc_after_image(cdc.cdc_row_changes(_changes(spark, d)))
    return rows.select("table_name", "event_type", "seq", "row_no", "value")


def q_cdc_route(spark, d):
    return cdc.cdc_records(_changes(spark, d))


# ------------------------------------------------------------ stream twins
# Each replays its input through a topic folder and the streaming runner
# (several micro-batches, state carried between them) and returns the sink.

AVAILABLE_NOW = {"availableNow": True}
LAST_PROGRESS: dict[str, list[dict]] = {}


def run_dau_stream(spark, d, name="dau_stream", first_seen=False):
    start = lambda s, out, ck: runners.start_dau_stream(
        s[topics.TOPIC_STARTUP], out, ck, AVAILABLE_NOW, f"{out}-first-seen" if first_seen else None)
    # arrival order is a hash of the record: visits come in no order of time
    logs = fx.startup_logs(spark, d)
    logs = logs.withColumn("arrival", F.xxhash64(*logs.columns))
    out, prog = replay(spark, {topics.TOPIC_STARTUP: (logs, "arrival")},
                       STREAM_BATCHES, start, name)
    LAST_PROGRESS[name] = prog
    return out


def q_dau_stream(spark, d):
    return runners.dau_table(spark, run_dau_stream(spark, d)).read().select("mid", "uid", "appid", "log_type", "log_date",
                                           "log_hour", "ts")


def q_new_mid_stream(spark, d):
    """Devices per first day, from the table that the DAU stream keeps of them."""
    out = run_dau_stream(spark, d, "new_mid_stream", True)
    claims = runners.first_seen_table(spark, f"{out}-first-seen").read()
    return claims.filter("live").groupBy("log_date").agg(F.count(F.lit(1)).alias("ct"))


def q_dau_stateful_stream(spark, d):
    """Pure streaming first visits, on logs that come in order of time."""
    start = lambda s, out, ck: runners.start_dau_stateful_stream(s[topics.TOPIC_STARTUP], out, ck,
                                                                 AVAILABLE_NOW)
    out, prog = replay(spark, {topics.TOPIC_STARTUP: (fx.startup_logs(spark, d), "ts")},
                       2 * STREAM_BATCHES, start, "dau_stateful_stream", files_per_chunk=1)
    LAST_PROGRESS["dau_stateful_stream"] = prog
    return runners.dau_table(spark, out).read().select("mid", "log_date")


def q_order_stream(spark, d):
    start = lambda s, out, ck: runners.start_order_stream(s[topics.TOPIC_ORDER], out, ck,
                                                          AVAILABLE_NOW)
    out, prog = replay(spark, {topics.TOPIC_ORDER: (fx.order_info_raw(spark, d), "ts")},
                       STREAM_BATCHES, start, "order_stream")
    LAST_PROGRESS["order_stream"] = prog
    return runners.order_table(spark, out).read().select(
        "id", "user_id", "consignee_tel", "order_status", "total_amount", "create_time",
        "create_date", "create_hour")


def q_first_order_stream(spark, d):
    start = lambda s, out, ck: runners.start_first_order_stream(
        s[topics.TOPIC_ORDER], f"{out}/orders", f"{out}/firsts", ck, AVAILABLE_NOW)
    # every third order comes again, in a later batch
    raw = fx.order_info_raw(spark, d).withColumn("arrival", F.col("ts"))
    again = raw.filter(F.pmod(F.xxhash64("id"), F.lit(3)) == 0)
    again = again.withColumn("arrival", F.col("ts") + 400 * 86_400_000)
    out, prog = replay(spark, {topics.TOPIC_ORDER: (raw.unionByName(again), "arrival")},
                       STREAM_BATCHES, start, "first_order_stream")
    LAST_PROGRESS["first_order_stream"] = prog
    return runners.flagged_orders(spark, f"{out}/orders", f"{out}/firsts").select(
        "id", "user_id", "create_time", "is_first_order")


def q_user_stream(spark, d):
    """Both versions of a profile in one micro-batch: the position decides."""
    def start(s, out, ck):
        users = s[topics.TOPIC_USER].drop("write_no").withColumn("seq", F.lit(0).cast("long"))
        return runners.start_user_stream(users, out, ck, AVAILABLE_NOW)
    versions = fx.user_profile_versions(spark, d).withColumnRenamed("seq", "write_no")
    out, prog = replay(spark, {topics.TOPIC_USER: (versions, "write_no")}, STREAM_BATCHES, start,
                       "user_stream", key_col="id")
    LAST_PROGRESS["user_stream"] = prog
    return runners.user_table(spark, out).read().select("id", "login_name", "user_level", "birthday", "gender")


def q_sale_stream(spark, d):
    def start(s, out, ck):
        users = runners.user_table(spark, f"{out}/users")
        users.append(fx.user_info_raw(spark, d), "load", 0)
        return runners.start_sale_stream(s[topics.TOPIC_ORDER], s[topics.TOPIC_ORDER_DETAIL],
                                         f"{out}/sales", f"{out}/users", ck,
                                         as_of=fx.USER_AS_OF, trigger=AVAILABLE_NOW)
    fast = lambda df: df.withColumn("ts", F.expr(f"ts div {SALE_SPEEDUP}"))
    sources = {topics.TOPIC_ORDER: (fast(fx.order_info_raw(spark, d)), "ts"),
               topics.TOPIC_ORDER_DETAIL: (fast(fx.order_detail_raw(spark, d)).drop("version"), "ts")}
    out, prog = replay(spark, sources, STREAM_BATCHES, start, "sale_stream")
    LAST_PROGRESS["sale_stream"] = prog
    return runners.sale_table(spark, f"{out}/sales").read().drop(search.TERMS_COL)


def q_alert_stream(spark, d):
    start = lambda s, out, ck: runners.start_alert_stream(
        s[topics.TOPIC_EVENT], out, ck, ALERT_WINDOW_SECONDS, ALERT_SLIDE_SECONDS,
        alerts.MIN_UIDS, ALERT_WATERMARK, AVAILABLE_NOW)
    events = fx.event_logs(spark, d)
    # closing records, as many as a chunk has files: one device without an
    # account, late enough for the watermark to pass every real window
    end = (events.agg(F.max("ts").alias("ts"))
           .withColumn("ts", F.col("ts") + 10 * 86_400_000)
           .withColumn("_n", F.explode(F.sequence(F.lit(1), F.lit(4)))))
    closing = end.select(*(
        (F.col("ts") if f.name == "ts" else F.lit("closing") if f.name == "mid" else F.lit(None))
        .cast(f.dataType).alias(f.name) for f in events.schema))
    out, prog = replay(spark, {topics.TOPIC_EVENT: (events, "ts")},
                       STREAM_BATCHES, start, "alert_stream", closing={topics.TOPIC_EVENT: closing})
    LAST_PROGRESS["alert_stream"] = prog
    table = runners.alert_table(spark, out).read()
    if table is None:   # no window closed with an alert: an empty sink
        return spark.createDataFrame(
            [], "alert_id string, mid string, uids string, item_ids string, events string, ts long")
    return alerts.alerts_flat(table.drop("alert_date"))


def _published(spark, out, *names) -> DataFrame:
    """``(topic, value)`` of the topics that a producer wrote below ``out``."""
    of = [topics.read_topic_batch(spark, n, out).select(F.lit(n).alias("topic"), "value") for n in names]
    return functools.reduce(DataFrame.unionByName, of)


def q_collector_stream(spark, d):
    logs = fx.client_logs(spark, d)
    start = lambda s, out, ck: runners.start_collector_stream(
        s[topics.TOPIC_LOG], ck, AVAILABLE_NOW, root=out, as_of_ms=COLLECTED_AT_MS)
    out, prog = replay(spark, {topics.TOPIC_LOG: (logs, "ts")}, STREAM_BATCHES, start,
                       "collector_stream", parse=False)
    LAST_PROGRESS["collector_stream"] = prog
    got = _published(spark, out, topics.TOPIC_STARTUP, topics.TOPIC_EVENT)
    return got.select("topic", F.from_json("value", logs.schema).alias("r")).select(
        "topic", *(f"r.{c}" for c in ("log_id", "type", "mid", "uid", "evid", "itemid", "ts")))


def q_capture_stream(spark, d):
    start = lambda s, out, ck: runners.start_capture_stream(s[topics.TOPIC_CHANGES], ck,
                                                            AVAILABLE_NOW, root=out)
    out, prog = replay(spark, {topics.TOPIC_CHANGES: (_changes(spark, d), "seq")}, STREAM_BATCHES,
                       start, "capture_stream")
    LAST_PROGRESS["capture_stream"] = prog
    return _published(spark, out, topics.TOPIC_ORDER, topics.TOPIC_ORDER_DETAIL, topics.TOPIC_USER)


STREAM_QUERIES = {
    "collector_stream": q_collector_stream,
    "capture_stream": q_capture_stream,
    "dau_stream": q_dau_stream,
    "new_mid_stream": q_new_mid_stream,
    "dau_stateful_stream": q_dau_stateful_stream,
    "order_stream": q_order_stream,
    "first_order_stream": q_first_order_stream,
    "user_stream": q_user_stream,
    "sale_stream": q_sale_stream,
    "alert_stream": q_alert_stream,
}


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "dau_first_visits": q_dau_first_visits,
    "dau_total": q_dau_total,
    "dau_total_day": q_dau_total_day,
    "dau_hour": q_dau_hour,
    "dau_hour_day": q_dau_hour_day,
    "new_mid": q_new_mid,
    "new_mid_day": q_new_mid_day,
    "orders_clean": q_orders_clean,
    "order_amount_total": q_order_amount_total,
    "order_amount_total_day": q_order_amount_total_day,
    "order_amount_hour": q_order_amount_hour,
    "first_order_flag": q_first_order_flag,
    "order_amount_by_province": q_order_amount_by_province,
    "realtime_total": q_realtime_total,
    "realtime_total_day": q_realtime_total_day,
    "realtime_total_busy_day": q_realtime_total_busy_day,
    "realtime_hour_dau": q_realtime_hour_dau,
    "realtime_hour_dau_day": q_realtime_hour_dau_day,
    "realtime_hour_amount": q_realtime_hour_amount,
    "user_latest": q_user_latest,
    "user_age_bands": q_user_age_bands,
    "sale_join": q_sale_join,
    "sale_detail": q_sale_detail,
    "sale_search": q_sale_search,
    "sale_search_day": q_sale_search_day,
    "sale_gender_terms": q_sale_gender_terms,
    "sale_age_terms": q_sale_age_terms,
    "sale_age_terms_top": q_sale_age_terms_top,
    "sale_age_stat": q_sale_age_stat,
    "sale_gender_stat": q_sale_gender_stat,
    "sale_search_postings": q_sale_search_postings,
    "sale_page": q_sale_page,
    "sale_page_after": q_sale_page_after,
    "sale_detail_report": q_sale_detail_report,
    "sale_report_stat": q_sale_report_stat,
    "sale_report_detail": q_sale_report_detail,
    "coupon_alert": q_coupon_alert,
    "coupon_alert_per_bucket": q_coupon_alert_per_bucket,
    "coupon_alert_per_hour": q_coupon_alert_per_hour,
    "coupon_alert_events": q_coupon_alert_events,
    "coupon_alert_header": q_coupon_alert_header,
    "coupon_alert_uids": q_coupon_alert_uids,
    "coupon_alert_items": q_coupon_alert_items,
    "route_logs": q_route_logs,
    "accepted_logs": q_accepted_logs,
    "rejected_logs": q_rejected_logs,
    "cdc_after_image": q_cdc_after_image,
    "cdc_route": q_cdc_route,
    **STREAM_QUERIES,
}
