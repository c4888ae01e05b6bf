"""Structured Streaming runners: the batch operators inside ``foreachBatch``.

Each runner takes a streaming DataFrame of parsed records (see
``sources.topics.read_topic`` + ``parse_records``), applies the same
operators as the batch queries and appends to an ``AppendTable``.  The query
checkpoint owns the source offsets and names the query; a batch replayed
after a failure finds its folder complete, or writes it anew.
Every runner returns the started ``StreamingQuery``.
"""

from __future__ import annotations

import time
from contextlib import contextmanager

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlane.operators import alerts, dau, orders, sales
from martlane.plans import search
from martlane.schemas import DAU_COLUMNS, ORDER_COLUMNS, SALE_COLUMNS
from martlane.sources import cdc, topics
from martlane.sources.tables import AppendTable, checkpoint_query_id
from martlane.sources.topics import POSITION

DEFAULT_TRIGGER = {"processingTime": "5 seconds"}


def dau_table(spark, root: str) -> AppendTable:
    """First visits by (device, day): the smallest ``ts`` stands, whatever arrives when."""
    return AppendTable(spark, root, dau.DAU_KEY, "log_date", ["ts"], latest=False)


def first_seen_table(spark, root: str) -> AppendTable:
    """Claims (mid, log_date, live): the device's first day, as known so far.  An
    earlier day found later comes with a row that ends the claim of the later day,
    so the live rows of a day's folder are the devices first seen on that day."""
    return AppendTable(spark, root, ["mid", "log_date"], "log_date", indexed=True)


def order_table(spark, root: str) -> AppendTable:
    """Orders by id, folders by create date."""
    return AppendTable(spark, root, ["id"], "create_date")


def user_table(spark, root: str) -> AppendTable:
    """Profiles by id: the largest ``seq`` stands, then the last to arrive."""
    return AppendTable(spark, root, ["id"], None, ["seq"], indexed=True)


def sale_table(spark, root: str) -> AppendTable:
    """Sale index by line id, folders by ``dt``."""
    return AppendTable(spark, root, ["order_detail_id"], "dt")


def alert_table(spark, root: str) -> AppendTable:
    return AppendTable(spark, root, ["alert_id"], "alert_date", ["ts"])


def _with_position(df: DataFrame, columns: list[str]) -> DataFrame:
    """``columns``, and the record's position where the topic reader gave one."""
    return df.select(*columns, *([POSITION] if POSITION in df.columns else []))


def start_batches(df: DataFrame, fn, checkpoint: str, trigger: dict | None):
    """``fn(batch, query id, batch id)`` for every micro-batch."""
    spark, known = df.sparkSession, []

    def each(batch: DataFrame, batch_id: int) -> None:
        if not known:
            known.append(checkpoint_query_id(spark, checkpoint))
        fn(batch, known[0], batch_id)

    writer = df.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or DEFAULT_TRIGGER)).start()


@contextmanager
def _conf_of_query(spark, conf: dict[str, str]):
    """``conf`` for the queries started within; a query keeps the settings it starts with."""
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _unpartitioned(batch: DataFrame) -> DataFrame:
    """The rows of a micro-batch, as a plan that Spark finds in its cache wherever it stands.

    The plan of a stateful query's batch says how its rows are dealt.  Where it
    stands twice in a plan, Spark renames the columns of the second but not
    those of the dealing: the second is then not taken for the persisted one
    and the stateful operator runs again, on a state that it has already written."""
    spark = batch.sparkSession
    rows = batch._jdf.queryExecution().toRdd()
    return DataFrame(batch._jdf.sparkSession().internalCreateDataFrame(rows, batch._jdf.schema(), False), spark)


# -------------------------------------------------------------------- DAU

def first_seen_claims(visits: DataFrame, seen: AppendTable) -> DataFrame:
    """The claims that a batch's first visits add and end."""
    first = visits.groupBy("mid").agg(F.min("log_date").alias("log_date"))
    known = seen.lookup(first.select("mid"))
    if known is None:
        return first.withColumn("live", F.lit(True))
    known = known.filter("live").groupBy("mid").agg(F.min("log_date").alias("_known"))
    both = first.join(known, "mid", "left").filter(F.col("_known").isNull() | (F.col("log_date") < F.col("_known")))
    claims = F.array(F.struct("log_date", F.lit(True).alias("live")),
                     F.when(F.col("_known").isNotNull(), F.struct(F.col("_known").alias("log_date"),
                                                                  F.lit(False).alias("live"))))
    return both.select("mid", F.inline(F.filter(claims, lambda c: c.isNotNull())))


def dau_batch(table: AppendTable, first_seen: AppendTable | None = None):
    """foreachBatch body: drop what is no earlier than a seen visit, append the
    rest; with ``first_seen`` also what it says about devices' first days, before
    the visits, so that a batch that died between the two finds both again."""
    def write(batch: DataFrame, query_id: str, batch_id: int) -> None:
        batch.persist()
        try:
            logs = dau.with_log_date_hour(batch)
            days = [r[0] for r in logs.select("log_date").distinct().collect()]
            seen = table.rows(days)     # only the days in this batch: partition pruning
            fresh = logs if seen is None else dau.anti_seen(logs, seen)
            visits = dau.first_per_device(fresh).select(*DAU_COLUMNS).persist()
            try:
                if first_seen is not None:
                    first_seen.append(first_seen_claims(visits, first_seen), query_id, batch_id)
                table.append(visits, query_id, batch_id)
            finally:
                visits.unpersist()
        finally:
            batch.unpersist()
    return write


def collector_batch(bootstrap_servers: str | None, root: str | None, as_of_ms: int | None,
                    raw_log: str | None, rejects: str | None):
    """foreachBatch body: client log lines, stamped once, to the raw log and to
    the startup and event topics; what is no JSON object to the reject table."""
    def write(batch: DataFrame, query_id: str, batch_id: int) -> None:
        now = int(time.time() * 1000) if as_of_ms is None else as_of_ms
        lines = batch.select(F.col("value").alias("line"), topics.stamp_json(F.col("value"), now).alias("value"))
        lines = lines.persist()
        try:
            good = lines.filter("value is not null").withColumn("type", F.get_json_object("value", "$.type"))
            if raw_log:
                topics.persist_raw_log(good.select("value", F.lit(now).cast("long").alias("ts")), raw_log,
                                       query_id, batch_id)
            if rejects:
                bad = lines.filter("value is null").select(F.col("line").alias("value"),
                                                           F.lit(topics.MALFORMED).alias("reason"))
                topics.keep_rejected(bad, rejects, topics.TOPIC_LOG, query_id, batch_id)
            topics.write_topic(topics.route_logs(good), bootstrap_servers, root, query_id, batch_id)
        finally:
            lines.unpersist()
    return write


def start_collector_stream(lines: DataFrame, checkpoint: str, trigger: dict | None = None,
                           bootstrap_servers: str | None = None, root: str | None = None,
                           as_of_ms: int | None = None, raw_log: str | None = None,
                           rejects: str | None = None):
    """Client log lines (``value``) -> stamped, routed, published to the startup
    and event topics with all their fields; the same lines to ``raw_log``."""
    return start_batches(lines.select("value"), collector_batch(bootstrap_servers, root, as_of_ms, raw_log, rejects),
                         checkpoint, trigger)


def start_capture_stream(changes: DataFrame, checkpoint: str, trigger: dict | None = None,
                         bootstrap_servers: str | None = None, root: str | None = None,
                         db: str = cdc.CDC_DB):
    """Change log -> after-images published to the order, line and user topics."""
    return topics.write_topic_stream(cdc.cdc_records(changes, db), checkpoint, bootstrap_servers,
                                     root, trigger)


def start_reject_stream(records: DataFrame, schema, required: str, topic: str, rejects: str,
                        checkpoint: str, trigger: dict | None = None):
    """What the consumers of a topic cannot use -> reject table; the query's
    progress counts records and rejected ones (``observedMetrics``)."""
    checked = topics.checked_records(records, schema, required)
    counted = checked.observe(topic, F.count(F.lit(1)).alias("records"), F.count("reason").alias("rejected"))

    def write(batch: DataFrame, query_id: str, batch_id: int) -> None:
        topics.keep_rejected(batch, rejects, topic, query_id, batch_id)

    return start_batches(counted.filter(F.col("reason").isNotNull()), write, checkpoint, trigger)


def start_dau_stream(startup_logs: DataFrame, table_root: str, checkpoint: str,
                     trigger: dict | None = None, first_seen_root: str | None = None):
    """Startup logs -> one row per (device, day) in the DAU table, and every
    device's first day in the first-seen table."""
    spark = startup_logs.sparkSession
    seen = first_seen_table(spark, first_seen_root) if first_seen_root else None
    return start_batches(startup_logs, dau_batch(dau_table(spark, table_root), seen), checkpoint, trigger)


def dau_stream_stateful(startup_logs: DataFrame, watermark: str = "1 day") -> DataFrame:
    """Pure streaming alternative: ``dropDuplicatesWithinWatermark``.

    Keeps the first row Spark sees per (device, day) and forgets the pair once
    the watermark is a day past it, so state holds about two days of devices
    however long the stream runs.  On input in order of time this is the batch
    result; a log that comes more than the watermark late is dropped, where the
    foreachBatch runner, whose state is the table, would still find its place.
    """
    logs = dau.with_log_date_hour(startup_logs).withColumn("_time", F.timestamp_millis("ts"))
    firsts = logs.withWatermark("_time", watermark).dropDuplicatesWithinWatermark(dau.DAU_KEY)
    return firsts.select(*DAU_COLUMNS)


def start_dau_stateful_stream(startup_logs: DataFrame, table_root: str, checkpoint: str,
                              trigger: dict | None = None, watermark: str = "1 day"):
    """The same rows into the DAU table, without a look at the table."""
    table = dau_table(startup_logs.sparkSession, table_root)
    return start_batches(dau_stream_stateful(startup_logs, watermark),
                         lambda batch, query, number: table.append(batch, query, number), checkpoint, trigger)


# ----------------------------------------------------------------- orders

def order_batch(table: AppendTable):
    def write(batch: DataFrame, query_id: str, batch_id: int) -> None:
        cleaned = _with_position(orders.orders_clean(batch), ORDER_COLUMNS)
        table.append(cleaned, query_id, batch_id)
    return write


def start_order_stream(raw_orders: DataFrame, table_root: str, checkpoint: str,
                       trigger: dict | None = None):
    """Order records -> masked, dated orders in the order table (key ``id``)."""
    table = order_table(raw_orders.sparkSession, table_root)
    return start_batches(raw_orders, order_batch(table), checkpoint, trigger)


def first_order_table(spark, root: str) -> AppendTable:
    """Per user the earliest order of each batch; the earliest of all on read."""
    return AppendTable(spark, root, ["user_id"], None, ["create_time", "id"], latest=False)


def first_order_batch(table: AppendTable, firsts: AppendTable):
    """foreachBatch body: append the orders, and each user's earliest of the batch.

    Nothing stored is read.  Which order is a user's first is settled on read
    (``flagged_orders``), so orders that come again or late change nothing."""
    def write(batch: DataFrame, query_id: str, batch_id: int) -> None:
        batch.persist()
        try:
            cleaned = _with_position(orders.orders_clean(batch), ORDER_COLUMNS)
            table.append(cleaned, query_id, batch_id)
            firsts.append(orders.first_orders(cleaned), query_id, batch_id)
        finally:
            batch.unpersist()
    return write


def flagged_orders(spark, table_root: str, firsts_root: str) -> DataFrame | None:
    """The order table with ``is_first_order`` from the remembered first orders."""
    table = order_table(spark, table_root).read()
    if table is None:
        return None
    return orders.flag_first(table, first_order_table(spark, firsts_root).read())


def start_first_order_stream(raw_orders: DataFrame, table_root: str, firsts_root: str,
                             checkpoint: str, trigger: dict | None = None):
    """Order records -> order table and first orders; read them with ``flagged_orders``."""
    spark = raw_orders.sparkSession
    return start_batches(raw_orders, first_order_batch(order_table(spark, table_root),
                                                first_order_table(spark, firsts_root)),
                  checkpoint, trigger)


# ------------------------------------------------------------------ users

def user_batch(table: AppendTable):
    def write(batch: DataFrame, query_id: str, batch_id: int) -> None:
        table.append(batch, query_id, batch_id)
    return write


def start_user_stream(raw_users: DataFrame, table_root: str, checkpoint: str,
                      trigger: dict | None = None):
    """User records -> latest profile per id (no expiry, last write wins)."""
    table = user_table(raw_users.sparkSession, table_root)
    return start_batches(raw_users, user_batch(table), checkpoint, trigger)


# ------------------------------------------------------------------ sales

# Where the rows that wait in the join lie: in RocksDB files on the executors'
# disks, behind caches and write buffers that share a fixed amount of memory on
# an executor, so that the state may outgrow the executors' memory.  Without a
# change log a commit empties the write buffers: those of partitions at rest
# would take the shared memory from the ones at work.  A checkpoint that began
# with another state store goes on with that.
_STATE = "spark.sql.streaming.stateStore"
JOIN_STATE = {
    f"{_STATE}.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    f"{_STATE}.rocksdb.changelogCheckpointing.enabled": "false",
    f"{_STATE}.rocksdb.boundedMemoryUsage": "true",
    f"{_STATE}.rocksdb.maxMemoryUsageMB": "500",
    "spark.sql.streaming.join.stateFormatVersion": "3",     # one RocksDB a partition, not four
}

USER_SCHEMA = "id string, login_name string, user_level string, birthday string, gender string, seq long"


def sale_batch(table: AppendTable, users: AppendTable, as_of: str | None):
    """foreachBatch body: enrich with the committed profiles of the batch's
    users, found by the user table's key index, and upsert."""
    def write(batch: DataFrame, query_id: str, batch_id: int) -> None:
        batch = _unpartitioned(batch).persist()
        try:
            known = users.lookup(batch.select(F.col("user_id").alias("id")))
            if known is None:
                known = batch.sparkSession.createDataFrame([], USER_SCHEMA)
            day = as_of or F.current_date()
            enriched = sales.enrich_user(sales.sale_detail(batch), known, day)
            docs = search.with_terms(_with_position(enriched, SALE_COLUMNS))   # analysed at index time
            table.append(docs, query_id, batch_id)
        finally:
            batch.unpersist()
    return write


def start_sale_stream(raw_orders: DataFrame, raw_details: DataFrame, table_root: str,
                      user_root: str, checkpoint: str, bound_seconds: int = sales.JOIN_BOUND_SECONDS,
                      watermark: str | None = None, as_of: str | None = None,
                      trigger: dict | None = None):
    """Orders x lines (time-bounded stream-stream join) -> enriched sale index."""
    spark = raw_orders.sparkSession
    joined = sales.sale_join_stream(orders.orders_clean(raw_orders), raw_details,
                                    bound_seconds, watermark)
    with _conf_of_query(spark, JOIN_STATE):
        return start_batches(joined, sale_batch(sale_table(spark, table_root), user_table(spark, user_root),
                                         as_of), checkpoint, trigger)


# ----------------------------------------------------------------- alerts

def alert_batch(table: AppendTable, window_seconds: int, min_uids: int):
    """foreachBatch body: closed windows' values -> alert documents, appended by alert id."""
    def write(batch: DataFrame, query_id: str, batch_id: int) -> None:
        batch.persist()
        try:
            docs = alerts.alert_documents(*alerts.parts_from_values(batch, window_seconds,
                                                                    min_uids))
            out = alerts.alert_per_bucket(docs).withColumn(
                "alert_date", F.date_format(F.timestamp_millis("ts"), "yyyy-MM-dd"))
            table.append(out, query_id, batch_id)
        finally:
            batch.unpersist()
    return write


def start_alert_stream(events: DataFrame, table_root: str, checkpoint: str,
                       window_seconds: int = alerts.WINDOW_SECONDS,
                       slide_seconds: int = alerts.SLIDE_SECONDS, min_uids: int = alerts.MIN_UIDS,
                       watermark: str = "1 minute", trigger: dict | None = None):
    """Event logs -> coupon alerts (append once a window closes) -> alert index."""
    values = alerts.alert_values_stream(events, window_seconds, slide_seconds, watermark)
    return start_batches(values, alert_batch(alert_table(events.sparkSession, table_root),
                                      window_seconds, min_uids), checkpoint, trigger)
