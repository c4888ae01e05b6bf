"""Start the shop's streaming jobs: topics in, keyed warehouse tables out.

    python -m martlane.streaming.apps --jobs collector,capture,rejects,dau,orders,alerts,users,sales \\
        --bootstrap broker:9092 --warehouse hdfs:///shop/warehouse

Without ``--bootstrap`` each topic is read from its file twin under
``--topic-root``.  Every job has its own checkpoint under
``<warehouse>/_checkpoints/<job>`` (so each reads its topics completely and
independently) and writes one keyed table under ``<warehouse>/<table>``; the
collector also keeps the raw log under ``<warehouse>/raw_log``, and records
that nothing can be made of go to ``<warehouse>/rejected``.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from martlane import schemas
from martlane.operators import alerts, sales
from martlane.sources import topics
from martlane.streaming import runners

JOBS = ("dau", "orders", "first_orders", "alerts", "users", "sales")
PRODUCERS = ("collector", "capture")   # client logs (and the raw log) and change log -> topics
FIRST_SEEN = "first_seen"              # table of devices' first days, kept by the dau job
REJECTS = "rejects"                    # every consumed topic -> reject table
TABLES = {"dau": "dau", "orders": "order_info", "first_orders": "order_info_flagged",
          "alerts": "coupon_alert", "users": "user_info", "sales": "sale_detail"}


# What the consumers of a topic parse, and the field that they cannot do without.
CONSUMED = {
    topics.TOPIC_STARTUP: (schemas.CLIENT_LOG, "mid"),
    topics.TOPIC_EVENT: (schemas.CLIENT_LOG, "mid"),
    topics.TOPIC_ORDER: (schemas.ORDER_INFO, "id"),
    topics.TOPIC_ORDER_DETAIL: (schemas.ORDER_DETAIL, "id"),
    topics.TOPIC_USER: (schemas.USER_INFO, "id"),
    topics.TOPIC_CHANGES: (schemas.CDC_CHANGE, "db"),
}


def _source(spark, topic, args):
    return topics.read_topic(spark, topic, args.bootstrap, args.topic_root, args.starting_offsets)


def _topic(spark, topic, args):
    return topics.parse_records(_source(spark, topic, args), *CONSUMED[topic])


def start_jobs(spark: SparkSession, args) -> dict:
    """Start the requested jobs; returns ``job -> StreamingQuery``."""
    wh = args.warehouse.rstrip("/")
    trigger = ({"availableNow": True} if args.available_now
               else {"processingTime": f"{args.trigger_seconds} seconds"})
    ck = lambda job: f"{wh}/_checkpoints/{job}"
    table = lambda job: f"{wh}/{TABLES[job]}"
    started = {}
    for job in args.jobs:
        if job == "collector":
            started[job] = runners.start_collector_stream(
                _source(spark, topics.TOPIC_LOG, args), ck(job), trigger, args.bootstrap,
                args.topic_root, raw_log=f"{wh}/raw_log", rejects=f"{wh}/rejected")
        elif job == "capture":
            changes = _topic(spark, topics.TOPIC_CHANGES, args)
            started[job] = runners.start_capture_stream(changes, ck(job), trigger, args.bootstrap,
                                                        args.topic_root)
        elif job == REJECTS:
            for topic, (schema, required) in CONSUMED.items():
                started[f"{job}-{topic}"] = runners.start_reject_stream(
                    _source(spark, topic, args), schema, required, topic, f"{wh}/rejected",
                    ck(f"{job}-{topic}"), trigger)
        elif job == "dau":
            logs = _topic(spark, topics.TOPIC_STARTUP, args)
            logs = logs.withColumnRenamed("type", "log_type")
            started[job] = runners.start_dau_stream(logs, table(job), ck(job), trigger, f"{wh}/{FIRST_SEEN}")
        elif job == "orders":
            raw = _topic(spark, topics.TOPIC_ORDER, args)
            started[job] = runners.start_order_stream(raw, table(job), ck(job), trigger)
        elif job == "first_orders":
            raw = _topic(spark, topics.TOPIC_ORDER, args)
            started[job] = runners.start_first_order_stream(raw, table(job), f"{wh}/first_order_users",
                                                            ck(job), trigger)
        elif job == "alerts":
            ev = _topic(spark, topics.TOPIC_EVENT, args)
            started[job] = runners.start_alert_stream(
                ev, table(job), ck(job), args.alert_window, args.alert_slide, alerts.MIN_UIDS,
                args.alert_watermark, trigger)
        elif job == "users":
            users = _topic(spark, topics.TOPIC_USER, args)
            # last write wins by arrival: within a batch, by position in the topic
            users = users.withColumn("seq", _ingest_ms())
            started[job] = runners.start_user_stream(users, table(job), ck(job), trigger)
        elif job == "sales":
            # records carry no event time: the join bound runs on arrival time,
            # as the original time-to-live cache did
            o = _topic(spark, topics.TOPIC_ORDER, args)
            d = _topic(spark, topics.TOPIC_ORDER_DETAIL, args)
            started[job] = runners.start_sale_stream(
                o.withColumn("ts", _ingest_ms()), d.withColumn("ts", _ingest_ms()), table(job),
                table("users"), ck(job), args.join_bound, args.join_watermark, None, trigger)
        else:
            raise ValueError(f"unknown job {job}")
    return started


def _ingest_ms():
    return F.unix_millis(F.current_timestamp())


def parse_args(argv=None):
    p = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawTextHelpFormatter)
    p.add_argument("--jobs", default=",".join(JOBS), type=lambda s: [j for j in s.split(",") if j])
    p.add_argument("--warehouse", required=True)
    p.add_argument("--bootstrap", default=None)
    p.add_argument("--topic-root", default=None)
    p.add_argument("--starting-offsets", default="latest")
    p.add_argument("--trigger-seconds", type=int, default=5)
    p.add_argument("--available-now", action="store_true",
                   help="process what the topics hold, then stop (backfills, tests)")
    p.add_argument("--alert-window", type=int, default=alerts.WINDOW_SECONDS)
    p.add_argument("--alert-slide", type=int, default=alerts.SLIDE_SECONDS)
    p.add_argument("--alert-watermark", default="1 minute")
    p.add_argument("--join-bound", type=int, default=sales.JOIN_BOUND_SECONDS)
    p.add_argument("--join-watermark", default=None)
    return p.parse_args(argv)


def main(argv=None) -> None:
    from martlane.session import get_spark

    args = parse_args(argv)
    spark = get_spark(master=None)
    start_jobs(spark, args)
    spark.streams.awaitAnyTermination()


if __name__ == "__main__":
    main()
