"""Database change log -> routed row after-images.

A change entry (``schemas.CDC_CHANGE``) is one captured statement: the
database and table, the entry type (row data or transaction begin/end), the
operation, a sequence number and the changed rows, each with its *after*
column list of (name, value) strings.  The operators keep row-data entries
of one database, explode their rows, turn the after-image into a JSON
object and pick the topic by table and operation.  All narrow except the
explode; nothing is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martlane.sources import fixtures as fx
from martlane.sources.topics import TOPIC_ORDER, TOPIC_ORDER_DETAIL, TOPIC_USER

# Captured database, entry and operation names.
CDC_DB = "shop"
OTHER_DB = "archive"
ROWDATA = "ROWDATA"
TX_BEGIN = "TRANSACTIONBEGIN"
TX_END = "TRANSACTIONEND"
INSERT, UPDATE, DELETE = "INSERT", "UPDATE", "DELETE"


def cdc_row_changes(changes: DataFrame, db: str = CDC_DB) -> DataFrame:
    """Row-data entries of ``db`` only, one output row per changed row."""
    rows = changes.filter((F.col("entry_type") == ROWDATA) & (F.col("db") == db))
    return rows.select("db", "table_name", "event_type", "seq",
                       F.posexplode("rows").alias("row_no", "_row")) \
        .select("db", "table_name", "event_type", "seq", "row_no", F.col("_row.after").alias("after"))


def cdc_after_image(rows: DataFrame) -> DataFrame:
    """``after`` column list -> ``value``: JSON object of column name -> string value."""
    image = F.map_from_arrays(F.col("after.name"), F.col("after.value"))
    return rows.withColumn("value", F.to_json(image))


def cdc_topic(table_name: Column, event_type: Column) -> Column:
    """Orders and lines on insert, users on insert or update; else null (dropped)."""
    return (F.when((table_name == "order_info") & (event_type == INSERT), F.lit(TOPIC_ORDER))
            .when((table_name == "order_detail") & (event_type == INSERT), F.lit(TOPIC_ORDER_DETAIL))
            .when((table_name == "user_info") & event_type.isin(INSERT, UPDATE), F.lit(TOPIC_USER)))


def cdc_route(rows: DataFrame) -> DataFrame:
    """Add ``topic`` and drop changes that no topic takes."""
    routed = rows.withColumn("topic", cdc_topic(F.col("table_name"), F.col("event_type")))
    return routed.filter(F.col("topic").isNotNull())


def cdc_records(changes: DataFrame, db: str = CDC_DB) -> DataFrame:
    """The whole capture path: ``(topic, seq, row_no, value)`` ready for ``write_topic``."""
    return cdc_route(cdc_after_image(cdc_row_changes(changes, db))).select(
        "topic", "table_name", "event_type", "seq", "row_no", "value")


# ------------------------------------------------------ fixture change log

def _ops() -> Column:
    return F.array(F.lit(INSERT), F.lit(UPDATE), F.lit(DELETE))


def _entry(df: DataFrame, table_name: str, key: Column, cols: list[str]) -> DataFrame:
    after = F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("string").alias("value"))
                      for c in cols])
    # statements with an even key changed a second row, named by its id
    second = F.transform(after, lambda c: F.struct(
        c["name"].alias("name"),
        F.when(c["name"] == "id", F.concat(c["value"], F.lit("+1"))).otherwise(c["value"]).alias("value")))
    one, two = F.struct(after.alias("after")), F.struct(second.alias("after"))
    return df.select(
        F.lit(CDC_DB).alias("db"), F.lit(table_name).alias("table_name"),
        F.lit(ROWDATA).alias("entry_type"),
        F.element_at(_ops(), (key % 3 + 1).cast("int")).alias("event_type"),
        key.cast("long").alias("seq"),
        F.when(key % 2 == 0, F.array(one, two)).otherwise(F.array(one)).alias("rows"))


def cdc_changes_fixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change log of the order, order line and user tables (FIXTURES.md).

    Operation by key % 3 (insert, update, delete), sequence = key; entries
    with an even key hold two rows; every order also brackets its row entry
    with transaction begin/end entries; and a second database holds a copy of
    the user entries, which no capture of the shop takes.
    """
    o = fx.order_info_raw(spark, sf_dir).withColumn("_k", F.col("id").cast("long"))
    d = fx.order_detail_raw(spark, sf_dir).withColumn("_k", F.col("order_id").cast("long"))
    u = fx.user_info_raw(spark, sf_dir).withColumn("_k", F.col("id").cast("long"))
    order_cols = ["id", "user_id", "consignee_tel", "order_status", "total_amount", "create_time"]
    detail_cols = ["id", "order_id", "sku_name", "sku_id", "order_price", "sku_num"]
    user_cols = ["id", "login_name", "user_level", "birthday", "gender"]
    empty_rows = F.array().cast("array<struct<after:array<struct<name:string,value:string>>>>")
    tx = o.select(F.lit(CDC_DB).alias("db"), F.lit("order_info").alias("table_name"),
                  F.explode(F.array(F.lit(TX_BEGIN), F.lit(TX_END))).alias("entry_type"),
                  F.lit(None).cast("string").alias("event_type"),
                  F.col("_k").alias("seq"), empty_rows.alias("rows"))
    users = _entry(u, "user_info", F.col("_k"), user_cols)
    return (_entry(o, "order_info", F.col("_k"), order_cols)
            .unionByName(_entry(d, "order_detail", F.col("_k"), detail_cols))
            .unionByName(users)
            .unionByName(users.withColumn("db", F.lit(OTHER_DB)))
            .unionByName(tx))
