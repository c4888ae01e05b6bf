"""A key holding a third of all rows: results stay whole and exact.

Inputs are generated with ``spark.range`` so the hot key really is a third
of the rows; expected values follow from the generator's arithmetic.
"""

from pyspark.sql import functions as F

from martlane.operators import alerts, dau, orders, sales
from martlane.sources import topics

N = 30_000
T0 = 1_704_067_200_000          # 2024-01-01 00:00:00 UTC


def skewed_logs(spark):
    """Every third row is device 'hot'; the rest spread over 1000 devices."""
    r = spark.range(N)
    mid = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("d"), (F.col("id") % 1000).cast("string")))
    return r.select(mid.alias("mid"), (F.col("id") % 50).cast("string").alias("uid"),
                    F.lit(None).cast("string").alias("appid"), F.lit(None).cast("string").alias("area"),
                    F.lit(None).cast("string").alias("os"), F.lit(None).cast("string").alias("ch"),
                    F.lit("startup").alias("log_type"), F.lit(None).cast("string").alias("vs"),
                    (F.lit(T0) + F.col("id") * 60_000).alias("ts"), F.col("id").alias("log_id"))


def test_dau_with_hot_device(spark):
    fv = dau.dau_first_visits(skewed_logs(spark))
    days = (N * 60_000) // 86_400_000 + 1           # the log spans this many days
    hot = fv.filter(F.col("mid") == "hot").orderBy("log_date").collect()
    assert len(hot) == days
    assert hot[0].ts == T0                           # earliest row of day one
    # every (device, day) pair appears exactly once
    assert fv.count() == fv.select("mid", "log_date").distinct().count()


def test_alerts_with_hot_device(spark):
    logs = skewed_logs(spark).select("mid", "uid", F.lit("coupon").alias("evid"),
                                     F.lit("1").alias("itemid"), "ts")
    got = alerts.coupon_alerts(logs, 3600, 600, 3).filter(F.col("mid") == "hot").collect()
    # the hot device sends a coupon every 3 minutes from many accounts: every window alerts
    assert len(got) == (N * 60 // 600) + 5            # 500 slides of data + 5 leading windows
    full = [a for a in got if a.ts == T0 + 7_200_000][0]   # window [1 h, 2 h): all its events
    assert [(e.evid, e.n) for e in full.events] == [("coupon", 20)]
    assert len(full.uids) == 20


def test_sale_join_with_hot_order(spark):
    o = spark.range(100).select(F.col("id").cast("string").alias("id"), F.lit("1").alias("order_status"),
                                F.lit("2024-01-01 00:00:00").alias("create_time"),
                                F.lit("u").alias("user_id"), F.lit("13800000000").alias("consignee_tel"),
                                F.lit(1.0).alias("total_amount"), F.lit(T0).alias("ts"))
    o = orders.orders_clean(o)
    d = spark.range(N).select(F.col("id").cast("string").alias("id"),
                              F.when(F.col("id") % 3 == 0, F.lit("0"))
                              .otherwise((F.col("id") % 100).cast("string")).alias("order_id"),
                              F.lit("x").alias("sku_name"), F.lit("s").alias("sku_id"),
                              F.lit("2.5").alias("order_price"), (F.lit(T0) + F.col("id")).alias("ts"))
    j = sales.sale_join(o, d, 300)
    assert j.count() == N                            # nothing dropped, nothing duplicated
    # hot order "0": every third line, plus the other multiples of 100
    assert j.filter(F.col("order_id") == "0").count() == 10_000 + 200


def test_first_order_flag_with_hot_user(spark):
    o = spark.range(N).select(F.col("id").cast("string").alias("id"),
                              F.when(F.col("id") % 3 == 0, F.lit("hot"))
                              .otherwise((F.col("id") % 500).cast("string")).alias("user_id"),
                              F.format_string("2024-01-01 %02d:%02d:%02d", (F.col("id") / 3600 % 24).cast("int"),
                                              (F.col("id") / 60 % 60).cast("int"),
                                              (F.col("id") % 60).cast("int")).alias("create_time"))
    flagged = orders.first_order_flag(o)
    firsts = flagged.filter(F.col("is_first_order") == "1")
    assert firsts.count() == flagged.select("user_id").distinct().count()
    assert firsts.filter(F.col("user_id") == "hot").first().id == "0"


def test_raw_log_and_topic_stream_sinks(spark, tmp_dir):
    logs = skewed_logs(spark).limit(100)
    lines = topics.to_topic_records(logs, "raw").select("value").crossJoin(
        spark.createDataFrame([(1_700_000_000_000,)], "ts long"))
    topics.persist_raw_log(lines, f"{tmp_dir}/raw", "q", 0)
    topics.persist_raw_log(lines, f"{tmp_dir}/raw", "q", 0)      # the batch again: its files are replaced
    assert spark.read.json(f"{tmp_dir}/raw").filter("log_date = '2023-11-14'").count() == 100
    recs = topics.to_topic_records(topics.route_logs(logs.withColumn("type", F.lit("startup"))),
                                   F.col("topic"))
    topics.write_topic(recs, root=f"{tmp_dir}/topics")
    src = topics.read_topic(spark, topics.TOPIC_STARTUP, root=f"{tmp_dir}/topics")
    q = topics.write_topic_stream(
        src.select(F.lit(topics.TOPIC_EVENT).alias("topic"), "value"), f"{tmp_dir}/ck",
        root=f"{tmp_dir}/copy", trigger={"availableNow": True})
    q.awaitTermination()
    assert topics.read_topic_batch(spark, topics.TOPIC_EVENT, f"{tmp_dir}/copy").count() == 100


def test_alert_parts_with_hot_device(spark):
    logs = skewed_logs(spark).select("mid", "uid", F.lit("coupon").alias("evid"),
                                     F.col("log_id").cast("string").alias("itemid"), "ts")
    header, uids, items, events = alerts.coupon_alert_parts(logs, 3600, 600, 3)
    hot = header.filter(F.col("mid") == "hot")
    assert hot.count() == (N * 60 // 600) + 5
    full = hot.filter(F.col("ts") == T0 + 7_200_000).first()
    assert (full.n_uids, full.n_items) == (20, 20)
    assert uids.filter(F.col("alert_id") == full.alert_id).count() == 20
