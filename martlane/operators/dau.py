"""Daily active devices: one first visit per (device, day).

Batch form: ``first_per_device`` over all startup logs.
Streaming form (``martlane.streaming``): per micro-batch, drop visits no
earlier than one in the date-partitioned table (``anti_seen``), keep the first
per (device, day) of what is left (``first_per_device``) and append it; a
reader takes the smallest ``ts`` per (device, day).  Both give the same rows,
in whatever order the logs arrive.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlane.functions.scalar import log_date, log_hour
from martlane.operators.common import pick_per_key
from martlane.schemas import DAU_COLUMNS

DAU_KEY = ["mid", "log_date"]


def with_log_date_hour(df: DataFrame, ts_col: str = "ts") -> DataFrame:
    """Add ``log_date`` (yyyy-MM-dd) and ``log_hour`` (HH) from epoch ms."""
    return df.withColumn("log_date", log_date(ts_col)).withColumn("log_hour", log_hour(ts_col))


def first_per_device(df: DataFrame) -> DataFrame:
    """Earliest log per (mid, log_date); ties broken by ``log_id`` when present."""
    order = ["ts", "log_id"] if "log_id" in df.columns else ["ts"]
    return pick_per_key(df, DAU_KEY, order, latest=False)


def anti_seen(batch: DataFrame, seen: DataFrame) -> DataFrame:
    """Drop rows whose (mid, log_date) is in ``seen``, where ``seen`` carries a
    ``ts``: with one no later.

    No broadcast hint: the seen set grows with devices x days, so the join
    strategy is left to AQE, which broadcasts it only when its measured size
    is under the threshold.
    """
    if "ts" not in seen.columns:
        return batch.join(seen.select(*DAU_KEY), DAU_KEY, "left_anti")
    known = seen.groupBy(*DAU_KEY).agg(F.min("ts").alias("_seen_ts"))
    out = batch.join(known, DAU_KEY, "left")
    return out.filter(F.col("_seen_ts").isNull() | (F.col("ts") < F.col("_seen_ts"))).drop("_seen_ts")


def dau_first_visits(startup_logs: DataFrame) -> DataFrame:
    """Exactly one row per (device, day), the earliest one, sink columns only."""
    fv = first_per_device(with_log_date_hour(startup_logs))
    return fv.select(*DAU_COLUMNS)


def new_mid(first_visits: DataFrame, date: str | None = None) -> DataFrame:
    """Devices whose first ever day is ``date`` (or, with no date, per day).

    Two partial aggregations: first day per device, then devices per day.
    """
    first_day = first_visits.groupBy("mid").agg(F.min("log_date").alias("log_date"))
    if date is not None:
        return first_day.filter(F.col("log_date") == date).agg(F.count(F.lit(1)).alias("ct"))
    return first_day.groupBy("log_date").agg(F.count(F.lit(1)).alias("ct"))
