"""Order cleaning: phone masking, create date/hour, first-order flag."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlane.functions.scalar import create_date, create_hour, mask_tel
from martlane.schemas import ORDER_COLUMNS


def orders_clean(orders: DataFrame) -> DataFrame:
    """Mask the phone number and derive ``create_date`` / ``create_hour``.

    Narrow (no shuffle): runs per partition on batch and stream alike.
    """
    out = (orders
           .withColumn("consignee_tel", mask_tel("consignee_tel"))
           .withColumn("create_date", create_date("create_time"))
           .withColumn("create_hour", create_hour("create_time")))
    known = [c for c in ORDER_COLUMNS if c in out.columns]
    extra = [c for c in out.columns if c not in ORDER_COLUMNS]
    return out.select(*known, *extra)


def first_orders(orders: DataFrame, seen_users: DataFrame | None = None) -> DataFrame:
    """(user_id, id, create_time) of each user's earliest order, for users not in ``seen_users``.

    Earliest = smallest (create_time, id), from a partially aggregated ``min``.
    """
    if seen_users is not None:
        orders = orders.join(seen_users.select("user_id"), "user_id", "left_anti")
    firsts = orders.groupBy("user_id").agg(F.min(F.struct("create_time", "id")).alias("_f"))
    return firsts.select("user_id", F.col("_f.id").alias("id"),
                         F.col("_f.create_time").alias("create_time"))


def flag_first(orders: DataFrame, firsts: DataFrame) -> DataFrame:
    """``is_first_order``: '1' for the orders that ``firsts`` (user_id, id) names, else '0'.

    Joined on the *order id*, a unique key, so a user with a huge number of
    orders causes no skew.
    """
    named = firsts.select(F.col("id").alias("_first_id"))
    flagged = orders.join(named, orders["id"] == named["_first_id"], "left")
    return (flagged
            .withColumn("is_first_order",
                        F.when(F.col("_first_id").isNotNull(), F.lit("1")).otherwise(F.lit("0")))
            .drop("_first_id"))


def first_order_flag(orders: DataFrame, seen_users: DataFrame | None = None) -> DataFrame:
    """Add ``is_first_order`` ('1' for a user's earliest order, else '0').

    ``seen_users`` are users who ordered before.  Where it names their first
    order too (``id``), that order keeps its '1' when it comes again.
    """
    firsts = first_orders(orders, seen_users).select("user_id", "id")
    if seen_users is not None and "id" in seen_users.columns:
        firsts = firsts.unionByName(seen_users.select("user_id", "id"))
    return flag_first(orders, firsts)
