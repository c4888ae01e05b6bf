"""State of the sale stream's join: on disk, written once per batch, kept by checkpoints."""

import json
import time

from pyspark.sql import functions as F

from conftest import rows
from martlane.sources import topics
from martlane.streaming import runners

SCHEMA = {topics.TOPIC_ORDER: "id string, user_id string, order_status string, create_time string, "
                              "consignee_tel string, ts long",
          topics.TOPIC_ORDER_DETAIL: "id string, order_id string, sku_id string, sku_name string, "
                                     "order_price string, ts long"}
T0 = 1_700_000_000_000


def publish(spark, root, orders, lines):
    for topic, data in zip(SCHEMA, (orders, lines)):
        df = spark.createDataFrame([json.dumps(r) for r in data], "string")
        topics.write_topic(df.select(F.lit(topic).alias("topic"), "value").coalesce(1), root=f"{root}/t")
    time.sleep(1.1)


def order(i, user, s=0):
    return {"id": i, "user_id": user, "create_time": "2023-11-14 10:00:00", "ts": T0 + s * 1000}


def line(i, o, s=0):
    return {"id": i, "order_id": o, "sku_id": "1", "sku_name": "a b", "order_price": "2.5", "ts": T0 + s * 1000}


def run(spark, root):
    read = {t: topics.parse_records(topics.read_topic(spark, t, root=f"{root}/t", max_files_per_trigger=1),
                                    spark.createDataFrame([], s).schema, "id") for t, s in SCHEMA.items()}
    q = runners.start_sale_stream(read[topics.TOPIC_ORDER], read[topics.TOPIC_ORDER_DETAIL], f"{root}/sales",
                                  f"{root}/users", f"{root}/ck", as_of="2024-01-01", trigger={"availableNow": True})
    q.awaitTermination()
    assert q.exception() is None
    return [p["stateOperators"][0] for p in q.recentProgress if p["stateOperators"]]


def test_many_buyers_join_once(spark, tmp_dir):
    """More buyers than a lookup filters by: each row enters the state once."""
    n = 600
    runners.user_table(spark, f"{tmp_dir}/users").append(spark.createDataFrame(
        [(f"u{i}", f"n{i}", "2", "1990-01-01", "F", 1) for i in range(0, n, 2)], runners.USER_SCHEMA), "load", 0)
    publish(spark, tmp_dir, [order(f"o{i}", f"u{i}") for i in range(n)], [line(f"l{i}", f"o{i}", 5) for i in range(n)])
    state = run(spark, tmp_dir)
    assert sum(s["numRowsUpdated"] for s in state) == 2 * n
    got = rows(runners.sale_table(spark, f"{tmp_dir}/sales").read(), "order_detail_id", "user_id", "user_gender")
    assert got == sorted((f"l{i}", f"u{i}", None if i % 2 else "F") for i in range(n))


def test_state_is_not_held_in_memory(spark, tmp_dir):
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    publish(spark, tmp_dir, [order("a", "u")], [line("x", "a")])
    state = run(spark, tmp_dir)
    assert state[0]["customMetrics"]["rocksdbPutCount"] > 0
    assert spark.conf.get(key) == before                    # other queries keep theirs
    assert rows(runners.sale_table(spark, f"{tmp_dir}/sales").read(), "order_detail_id") == [("x",)]


def test_checkpoint_with_another_state_store_goes_on(spark, tmp_dir, monkeypatch):
    publish(spark, tmp_dir, [order("a", "u")], [line("x", "b", 1)])
    with monkeypatch.context() as m:
        m.setattr(runners, "JOIN_STATE", {})
        run(spark, tmp_dir)
    publish(spark, tmp_dir, [order("b", "u", 2)], [line("y", "a", 2)])     # both meet rows that wait
    run(spark, tmp_dir)
    got = rows(runners.sale_table(spark, f"{tmp_dir}/sales").read(), "order_detail_id", "order_id")
    assert got == [("x", "b"), ("y", "a")]
