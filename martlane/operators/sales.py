"""Order-to-line join with a time bound, sale records, user enrichment."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlane.functions.scalar import age_365, sku_price
from martlane.operators.common import pick_per_key
from martlane.schemas import SALE_COLUMNS
from martlane.sources.topics import POSITION

# Fixed value: how long an order and its lines wait for each other.
JOIN_BOUND_SECONDS = 300
USER_FIELDS = ("user_gender", "user_age", "user_level")


def user_latest(users: DataFrame, version_col: str = "seq") -> DataFrame:
    """Latest profile per user id (last write wins by ``version_col``)."""
    return pick_per_key(users, ["id"], [version_col], latest=True)


def _time_bound(o_ts, d_ts, bound_seconds: int):
    bound_ms = F.lit(int(bound_seconds) * 1000)
    return (d_ts > o_ts - bound_ms) & (d_ts < o_ts + bound_ms)


def sale_join(orders: DataFrame, details: DataFrame, bound_seconds: int | None = JOIN_BOUND_SECONDS,
              ) -> DataFrame:
    """Inner join of orders and their lines, arrival times less than the bound apart.

    ``orders`` are cleaned orders (``create_date`` present) with epoch-ms
    ``ts``, and the buyer's fields where they have been added already; ``details`` carry ``ts`` too.  ``bound_seconds=None`` joins on
    the key alone.  The join is an equi-join on the order id (unique on the
    order side) with the time bound as a residual condition; AQE splits a
    hot order id on the line side.  The streaming twin puts the same
    condition on event-time columns with watermarks on both sides.
    """
    o = orders.select(
        F.col("id").alias("order_id"), "order_status", "create_time", "user_id",
        F.col("create_date").alias("dt"), F.col("ts").alias("_o_ts"),
        *(c for c in USER_FIELDS if c in orders.columns))
    d_cols = [F.col("id").alias("order_detail_id"), F.col("order_id").alias("_d_order_id"),
              "sku_id", "sku_name", sku_price("order_price").alias("sku_price"),
              F.col("ts").alias("_d_ts")]
    if "version" in details.columns:
        d_cols.append("version")
    d = details.select(*d_cols)
    cond = o["order_id"] == d["_d_order_id"]
    if bound_seconds is not None:
        cond = cond & _time_bound(o["_o_ts"], d["_d_ts"], bound_seconds)
    return o.join(d, cond, "inner").drop("_d_order_id", "_o_ts", "_d_ts")


def sale_detail(joined: DataFrame) -> DataFrame:
    """The 12 sale fields (user fields still empty), extra columns kept after them."""
    out = joined
    for name, typ in (("user_gender", "string"), ("user_age", "int"), ("user_level", "string")):
        if name not in out.columns:
            out = out.withColumn(name, F.lit(None).cast(typ))
    extra = [c for c in out.columns if c not in SALE_COLUMNS]
    return out.select(*SALE_COLUMNS, *extra)


def enrich_user(sales: DataFrame, users: DataFrame, as_of: str) -> DataFrame:
    """Add gender, age (365-day years at ``as_of``) and level of the buyer.

    Left join: a sale whose user is unknown keeps null gender/level and age
    0.  ``users`` must hold one row per id (see ``user_latest``); no
    broadcast hint because the user table grows with the business - AQE
    broadcasts it when its measured size allows.
    """
    u = users.select(F.col("id").alias("_uid"), F.col("gender").alias("_gender"),
                     F.col("user_level").alias("_level"),
                     age_365("birthday", as_of).alias("_age"))
    j = sales.join(u, sales["user_id"] == u["_uid"], "left")
    j = (j.withColumn("user_gender", F.col("_gender"))
          .withColumn("user_level", F.col("_level"))
          .withColumn("user_age", F.coalesce(F.col("_age"), F.lit(0)).cast("int")))
    return j.drop("_uid", "_gender", "_level", "_age")


def latest_line(details: DataFrame, keys: Sequence[str] = ("id",)) -> DataFrame:
    """One order line per line id, the latest ``version`` (last write wins).

    Where the id holds the order's, ``keys`` may name the order id too: lines
    dealt by it are then resolved where they lie."""
    return pick_per_key(details, keys, ["version"] if "version" in details.columns else [],
                        latest=True)


def sale_detail_index(sales: DataFrame) -> DataFrame:
    """One document per ``order_detail_id`` (the index's upsert), latest ``version``."""
    if "version" not in sales.columns:
        return pick_per_key(sales, ["order_detail_id"], [], latest=True)
    return pick_per_key(sales, ["order_detail_id"], ["version"], latest=True)


def sale_join_stream(orders: DataFrame, details: DataFrame,
                     bound_seconds: int = JOIN_BOUND_SECONDS,
                     watermark: str | None = None) -> DataFrame:
    """Streaming twin of ``sale_join``: stream-stream inner join.

    Both sides get a watermark on their event time and the join carries the
    two-sided time bound, so Spark can evict an order (or a line) once no
    partner within the bound can still arrive: state stays bounded by the
    bound plus the watermark delay instead of growing with the stream.
    """
    delay = watermark or f"{int(bound_seconds)} seconds"
    o = (orders.select(F.col("id").alias("order_id"), "order_status", "create_time", "user_id",
                       F.col("create_date").alias("dt"),
                       F.timestamp_millis("ts").alias("_o_time"))
         .withWatermark("_o_time", delay))
    # the line's position in its topic decides between two writes of one line
    position = [POSITION] if POSITION in details.columns else []
    d = (details.select(F.col("id").alias("order_detail_id"),
                        F.col("order_id").alias("_d_order_id"), "sku_id", "sku_name",
                        sku_price("order_price").alias("sku_price"),
                        F.timestamp_millis("ts").alias("_d_time"), *position)
         .withWatermark("_d_time", delay))
    bound = F.expr(f"INTERVAL {int(bound_seconds)} SECONDS")
    cond = ((o["order_id"] == d["_d_order_id"])
            & (d["_d_time"] > o["_o_time"] - bound)
            & (d["_d_time"] < o["_o_time"] + bound))
    return o.join(d, cond, "inner").drop("_d_order_id", "_o_time", "_d_time")
