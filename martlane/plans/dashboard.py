"""Dashboard read side: totals, hourly series, today-versus-yesterday.

Every query takes an optional ``date``.  With a date it answers the
dashboard's question for that day (one filter on a partition/grouping column,
which Catalyst pushes below the aggregate); without one it answers it for
every day at once, which is what the batch entry points register.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlane.functions.scalar import prev_day

# Metric ids and display names of the dashboard.
METRIC_DAU = ("dau", "新增日活")
METRIC_NEW_MID = ("new_mid", "新增设备")
METRIC_ORDER_AMOUNT = ("order_amount", "新增交易额")
HOURS_PER_DAY = 24


def _count(name: str = "ct"):
    return F.count(F.lit(1)).alias(name)


def dau_total(first_visits: DataFrame, date: str | None = None) -> DataFrame:
    """Number of active devices of the day (``ct``); per ``log_date`` without a date."""
    if date is not None:
        return first_visits.filter(F.col("log_date") == date).agg(_count())
    return first_visits.groupBy("log_date").agg(_count())


def dau_hour(first_visits: DataFrame, date: str | None = None) -> DataFrame:
    """Active devices per ``log_hour`` (first visit hour)."""
    if date is not None:
        return first_visits.filter(F.col("log_date") == date).groupBy("log_hour").agg(_count())
    return first_visits.groupBy("log_date", "log_hour").agg(_count())


def order_amount_total(orders: DataFrame, date: str | None = None) -> DataFrame:
    """Sum of ``total_amount``; null when the day has no orders."""
    amount = F.sum("total_amount").alias("order_amount")
    if date is not None:
        return orders.filter(F.col("create_date") == date).agg(amount)
    return orders.groupBy("create_date").agg(amount)


def order_amount_hour(orders: DataFrame, date: str | None = None) -> DataFrame:
    """Sum of ``total_amount`` per ``create_hour``."""
    amount = F.sum("total_amount").alias("order_amount")
    if date is not None:
        return orders.filter(F.col("create_date") == date).groupBy("create_hour").agg(amount)
    return orders.groupBy("create_date", "create_hour").agg(amount)


def order_amount_by_province(orders: DataFrame, user_province: DataFrame,
                             date: str | None = None) -> DataFrame:
    """Order amount per province (and day).

    Orders are first summed per (user, day) - a partial aggregation before
    any shuffle - so the join to the user table moves one row per user and
    day instead of one per order, and a hot user cannot skew the join.
    """
    if date is not None:
        orders = orders.filter(F.col("create_date") == date)
    per_user = (orders.groupBy("user_id", "create_date")
                .agg(F.sum("total_amount").alias("amount")))
    joined = per_user.join(user_province.select("user_id", "province_id"), "user_id", "left")
    out = joined.groupBy("province_id", "create_date").agg(F.sum("amount").alias("order_amount"))
    return out.drop("create_date") if date is not None else out


def label_metric(df: DataFrame, metric: tuple[str, str], value: str,
                 date_col: str | None = None) -> DataFrame:
    """Attach the constant ``id`` and ``name`` of a dashboard metric to its value.

    With ``date_col`` the day is kept as ``date``.
    """
    cols = [F.lit(metric[0]).alias("id"), F.lit(metric[1]).alias("name"),
            F.col(value).cast("double").alias("value")]
    if date_col is not None:
        cols.insert(0, F.col(date_col).alias("date"))
    return df.select(*cols)


def realtime_total(first_visits: DataFrame, orders: DataFrame, new_devices: DataFrame,
                   date: str | None = None) -> DataFrame:
    """The dashboard's headline list: (id, name, value) for dau, new_mid, order_amount.

    ``new_devices`` is the output of ``new_mid``.  Without a date the rows
    carry ``date`` and cover every day that has any metric.
    """
    def label(df: DataFrame, metric: tuple[str, str], value: str, date_col: str) -> DataFrame:
        return label_metric(df, metric, value, date_col if date is None else None)

    return (label(dau_total(first_visits, date), METRIC_DAU, "ct", "log_date")
            .unionByName(label(new_devices, METRIC_NEW_MID, "ct", "log_date"))
            .unionByName(label(order_amount_total(orders, date), METRIC_ORDER_AMOUNT,
                               "order_amount", "create_date")))


def today_vs_yesterday(df: DataFrame, date_col: str, hour_col: str, value: str | None,
                       date: str | None = None) -> DataFrame:
    """(date, hour, today, yesterday) from one scan, no self-join.

    Each input row is counted for its own day as ``today`` and for the next
    day as ``yesterday``; one aggregation then yields both series.  With a
    date only that day and the day before are read.
    """
    v = F.lit(1).cast("double") if value is None else F.col(value).cast("double")
    base = df.select(F.col(date_col).alias("d"), F.col(hour_col).alias("hour"), v.alias("v"))
    if date is not None:
        base = base.filter(F.col("d").isin(date, prev_day(date)))
    shifted = F.array(
        F.struct(F.col("d").alias("date"), F.col("v").alias("today"),
                 F.lit(None).cast("double").alias("yesterday")),
        F.struct(F.date_format(F.date_add(F.try_to_date("d"), 1), "yyyy-MM-dd").alias("date"),
                 F.lit(None).cast("double").alias("today"), F.col("v").alias("yesterday")),
    )
    rows = base.select("hour", F.inline(shifted))
    if date is not None:
        rows = rows.filter(F.col("date") == date)
    return rows.groupBy("date", "hour").agg(F.sum("today").alias("today"),
                                            F.sum("yesterday").alias("yesterday"))


def fill_hours(series: DataFrame, date: str | None = None) -> DataFrame:
    """Put (date, hour, today, yesterday) on the fixed 00..23 axis, missing -> 0.

    The day's (at most 24) hourly values are gathered into a map, then the
    axis ``explode(sequence(0, 23))`` looks each hour up: one pass over the
    series, no join and no cross join; a group never exceeds 24 entries.
    With a date, a day without any value still gets its 24 zero rows.
    """
    if date is not None:
        series = series.filter(F.col("date") == date).unionByName(
            series.sparkSession.range(1).select(
                F.lit(date).alias("date"), F.lit(None).cast("string").alias("hour"),
                F.lit(None).cast("double").alias("today"),
                F.lit(None).cast("double").alias("yesterday")))
    entry = F.struct("hour", F.struct("today", "yesterday"))
    per_day = series.groupBy("date").agg(
        F.map_from_entries(F.collect_list(F.when(F.col("hour").isNotNull(), entry))).alias("m"))
    axis = per_day.select("date", "m", F.explode(F.sequence(F.lit(0), F.lit(HOURS_PER_DAY - 1)))
                          .alias("h"))
    axis = axis.withColumn("hour", F.lpad(F.col("h").cast("string"), 2, "0"))
    v = F.element_at(F.col("m"), F.col("hour"))
    return axis.select("date", "hour",
                       F.coalesce(v["today"], F.lit(0.0)).alias("today"),
                       F.coalesce(v["yesterday"], F.lit(0.0)).alias("yesterday"))


def realtime_hour(metric_id: str, first_visits: DataFrame, orders: DataFrame,
                  date: str | None = None) -> DataFrame | None:
    """Today's and yesterday's hourly series of one metric on the 24-hour axis.

    ``dau`` counts first visits, ``order_amount`` sums order amounts; any
    other id has no series (None), as in the dashboard service.
    """
    if metric_id == METRIC_DAU[0]:
        series = today_vs_yesterday(first_visits, "log_date", "log_hour", None, date)
    elif metric_id == METRIC_ORDER_AMOUNT[0]:
        series = today_vs_yesterday(orders, "create_date", "create_hour", "total_amount", date)
    else:
        return None
    return fill_hours(series, date)
