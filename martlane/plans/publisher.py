"""The dashboard service's three endpoints over the warehouse tables.

``realtime_total`` / ``realtime_hour`` / ``sale_detail`` answer what the
publisher's ``realtime-total``, ``realtime-hour`` and ``sale_detail``
endpoints answer, reading the keyed tables the streaming jobs maintain
(``streaming.apps``).  Each returns a DataFrame; ``as_json`` renders the
endpoint's JSON body in Spark (``to_json``), one row.
"""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martlane.plans import dashboard, search
from martlane.streaming import runners
from martlane.streaming.apps import FIRST_SEEN, TABLES


COUNTS = (dashboard.METRIC_DAU[0], dashboard.METRIC_NEW_MID[0])   # metrics that are whole numbers


def _table(spark: SparkSession, warehouse: str, job: str, schema: str, days=None) -> DataFrame:
    """The job's table; with ``days`` only their folders are read."""
    open_ = {"dau": runners.dau_table, "orders": runners.order_table, "sales": runners.sale_table}[job]
    df = open_(spark, f"{warehouse.rstrip('/')}/{TABLES[job]}").read(days)
    return df if df is not None else spark.createDataFrame([], schema)


def _first_visits(spark, warehouse, days=None):
    return _table(spark, warehouse, "dau", "mid string, log_date string, log_hour string", days)


def _orders(spark, warehouse, days):
    return _table(spark, warehouse, "orders",
                  "create_date string, create_hour string, total_amount double", days)


def _with_day_before(date: str) -> list[str]:
    day = datetime.date.fromisoformat(date)
    return [date, (day - datetime.timedelta(days=1)).isoformat()]


def realtime_total(spark: SparkSession, warehouse: str, date: str) -> DataFrame:
    """[{id, name, value}] for dau, new_mid and order_amount of ``date``; every
    table is read for that day alone."""
    claims = runners.first_seen_table(spark, f"{warehouse.rstrip('/')}/{FIRST_SEEN}").read([date])
    if claims is None:
        claims = spark.createDataFrame([], "mid string, log_date string, live boolean")
    new = claims.filter("live").agg(F.count(F.lit(1)).alias("ct"))
    return dashboard.realtime_total(_first_visits(spark, warehouse, [date]), _orders(spark, warehouse, [date]),
                                    new, date)


def realtime_hour(spark: SparkSession, warehouse: str, metric_id: str, date: str) -> DataFrame | None:
    """(hour, today, yesterday) of ``dau`` or ``order_amount``; None for other ids."""
    days = _with_day_before(date)
    out = dashboard.realtime_hour(metric_id, _first_visits(spark, warehouse, days),
                                  _orders(spark, warehouse, days), date)
    if out is None:
        return None
    kind = "long" if metric_id in COUNTS else "double"
    return out.select("hour", F.col("today").cast(kind).alias("today"), F.col("yesterday").cast(kind).alias("yesterday"))


def sale_detail(spark: SparkSession, warehouse: str, date: str, keyword: str, startpage: int,
                size: int) -> DataFrame:
    """{total, stat, detail} for one day, keyword and page (pages count from 1)."""
    sales = _table(spark, warehouse, "sales", ", ".join(
        f"{f} string" for f in ("order_detail_id", "order_id", "order_status", "create_time",
                                "user_id", "sku_id", "user_gender", "user_level", "sku_name", "dt"))
        + ", user_age int, sku_price double", [date])
    return search.sale_detail_report(sales, date, keyword, startpage, size, nested=True)


def as_json(df: DataFrame, shape: str = "row") -> DataFrame:
    """The endpoint body: one JSON object (``row``), hour -> value maps (``map``), or a
    JSON array of the headline's three metrics (``list``), counts as whole numbers."""
    if shape == "row":
        return df.select(F.to_json(F.struct(*df.columns)).alias("json"))
    if shape == "map":   # hour -> value maps of the hourly endpoint
        return df.agg(F.to_json(F.struct(
            F.map_from_entries(F.collect_list(F.struct("hour", "today"))).alias("today"),
            F.map_from_entries(F.collect_list(F.struct("hour", "yesterday"))).alias("yesterday"),
        )).alias("json"))
    value = F.when(F.col("id").isin(*COUNTS), F.to_json(F.struct("id", "name", F.col("value").cast("long").alias("value"))))
    one = F.coalesce(value, F.to_json(F.struct("id", "name", "value")))
    return df.agg(F.concat(F.lit("["), F.array_join(F.collect_list(one), ","), F.lit("]")).alias("json"))
