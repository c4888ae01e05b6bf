"""Map the driver's parquet tables onto the shop's domain records.

The shop itself receives JSON on topics; the test and benchmark data are
TPC-H-like parquet tables.  These functions are plain scans plus column
expressions (and one join for order lines), so Catalyst prunes columns and
pushes any later filter on the raw columns into the parquet reader.

Mapping (all derivations fixed arithmetic, so every engine can reproduce them):

* startup log  <- events: mid = 'mid_' || user_id, one startup per event
* event log    <- events: mid = 'mid_' || (user_id % 5), evid from event_type
* order info   <- orders: pseudo time of day from the order key, phone number
* order detail <- lineitem join part
* user info    <- customer: gender, birthday, level from the customer key
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martlane.functions.scalar import epoch_ms

# Fixed values of the mapping.
APP_ID = "shop_app"
EVENT_DEVICES = 5                 # event logs: device = user_id % 5
EVID_BY_EVENT_TYPE = {
    "purchase": "coupon",
    "click": "clickItem",
    "view": "addCart",
    "signup": "addFavor",
    "error": "addComment",
}
VIEW_KINDS = 4                    # evid 'view_' || event_id % 4 of every third view
ORDER_TIME_MULT = 7919            # create_time = o_orderdate + (key * 7919) % 86400 s
SECONDS_PER_DAY = 86400
TEL_MULT = 1234577                # tel = '1' || lpad((key * 1234577) % 1e10, 10, '0')
TEL_MOD = 10_000_000_000
BIRTHDAY_BASE = "1950-01-01"      # birthday = base + (custkey * 7919) % 22000 days
BIRTHDAY_SPAN_DAYS = 22000
BIRTHDAY_MULT = 7919
USER_LEVELS = 4                   # user_level = custkey % 4 + 1
USER_AS_OF = "2020-01-01"         # reference "now" for user ages in fixtures


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _str(col: str | Column) -> Column:
    return (F.col(col) if isinstance(col, str) else col).cast("string")


def _null_str(name: str) -> Column:
    return F.lit(None).cast("string").alias(name)


def _day_range(ts: Column, day_from: str | None, day_to: str | None) -> Column | None:
    """Half-open range on the raw timestamp so the filter reaches the scan."""
    cond = None
    if day_from is not None:
        cond = ts >= F.lit(day_from).cast("timestamp_ntz")
    if day_to is not None:
        upper = ts < F.date_add(F.lit(day_to).cast("date"), 1).cast("timestamp_ntz")
        cond = upper if cond is None else cond & upper
    return cond


def _events(spark, sf_dir, day_from=None, day_to=None) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    cond = _day_range(F.col("ts"), day_from, day_to)
    return ev if cond is None else ev.filter(cond)


def startup_logs(spark: SparkSession, sf_dir: str, day_from: str | None = None,
                 day_to: str | None = None) -> DataFrame:
    """Startup logs (no log_date/log_hour yet) plus ``log_id`` as a tie-break."""
    ev = _events(spark, sf_dir, day_from, day_to)
    return ev.select(
        F.concat(F.lit("mid_"), _str("user_id")).alias("mid"),
        _str("user_id").alias("uid"),
        F.lit(APP_ID).alias("appid"),
        _null_str("area"), _null_str("os"), _null_str("ch"),
        F.lit("startup").alias("log_type"),
        _null_str("vs"),
        epoch_ms("ts").alias("ts"),
        F.col("event_id").alias("log_id"),
    )


def _evid(event_type: Column) -> Column:
    mapping = F.create_map(*[F.lit(x) for kv in EVID_BY_EVENT_TYPE.items() for x in kv])
    return F.element_at(mapping, event_type)


def client_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw client log lines as the collector receives them (before stamping)."""
    ev = table(spark, sf_dir, "events")
    is_startup = F.col("event_type") == "signup"
    return ev.select(
        F.when(is_startup, F.lit("startup")).otherwise(F.lit("event")).alias("type"),
        F.concat(F.lit("mid_"), _str("user_id")).alias("mid"),
        _str("user_id").alias("uid"),
        _null_str("os"),
        F.lit(APP_ID).alias("appid"),
        _null_str("area"), _null_str("ch"), _null_str("vs"),
        F.when(~is_startup, _evid(F.col("event_type"))).alias("evid"),
        _null_str("pgid"), _null_str("npgid"),
        F.when(~is_startup, F.get_json_object("props", "$.k")).alias("itemid"),
        epoch_ms("ts").alias("ts"),
        F.col("event_id").alias("log_id"),
    )


def event_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event logs of few devices, many accounts (the coupon-fraud input)."""
    ev = table(spark, sf_dir, "events")
    return ev.select(
        F.concat(F.lit("mid_"), _str(F.col("user_id") % EVENT_DEVICES)).alias("mid"),
        _str("user_id").alias("uid"),
        F.lit(APP_ID).alias("appid"),
        _null_str("area"), _null_str("os"), _null_str("ch"),
        F.lit("event").alias("type"),
        # every third view has an id of its own kind: ids are not a closed list
        F.when((F.col("event_type") == "view") & (F.col("event_id") % 3 == 0),
               F.concat(F.lit("view_"), _str(F.col("event_id") % VIEW_KINDS)))
        .otherwise(_evid(F.col("event_type"))).alias("evid"),
        _null_str("pgid"), _null_str("npgid"),
        F.get_json_object("props", "$.k").alias("itemid"),
        epoch_ms("ts").alias("ts"),
        F.col("event_id").alias("log_id"),
    )


def _create_time(orderdate: Column, orderkey: Column) -> Column:
    secs = F.unix_seconds(orderdate.cast("timestamp")) + (orderkey * ORDER_TIME_MULT) % SECONDS_PER_DAY
    return F.date_format(F.timestamp_seconds(secs), "yyyy-MM-dd HH:mm:ss")


def order_info_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order records as they arrive on the order topic (tel unmasked, no date/hour)."""
    o = table(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    tel = F.concat(F.lit("1"), F.lpad(_str((key * TEL_MULT) % TEL_MOD), 10, "0"))
    return o.select(
        _str(key).alias("id"),
        _null_str("province_id"), _null_str("consignee"), _null_str("order_comment"),
        tel.alias("consignee_tel"),
        F.col("o_orderstatus").alias("order_status"),
        _null_str("payment_way"),
        _str("o_custkey").alias("user_id"),
        _null_str("img_url"),
        F.col("o_totalprice").alias("total_amount"),
        _null_str("expire_time"), _null_str("delivery_address"),
        _create_time(F.col("o_orderdate"), key).alias("create_time"),
        _null_str("operate_time"), _null_str("tracking_no"), _null_str("parent_order_id"),
        _null_str("out_trade_no"), _null_str("trade_body"),
        epoch_ms("o_orderdate").alias("ts"),
    )


def user_province(spark: SparkSession, sf_dir: str) -> DataFrame:
    """user_id -> province_id (the customer's nation)."""
    c = table(spark, sf_dir, "customer")
    return c.select(_str("c_custkey").alias("user_id"), _str("c_nationkey").alias("province_id"))


def order_detail_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines with sku name and price; ``ts`` is the arrival time (ship date).

    ``version`` orders repeated ids (last write wins by ship date, then price).
    """
    li = table(spark, sf_dir, "lineitem")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_retailprice")
    joined = li.join(part, li.l_partkey == part.p_partkey, "inner")
    return joined.select(
        F.concat_ws("-", _str("l_orderkey"), _str("l_linenumber"), _str("l_partkey"),
                    _str("l_suppkey")).alias("id"),
        _str("l_orderkey").alias("order_id"),
        F.col("p_name").alias("sku_name"),
        _str("l_partkey").alias("sku_id"),
        _str("p_retailprice").alias("order_price"),
        _null_str("img_url"),
        _str("l_quantity").alias("sku_num"),
        epoch_ms("l_shipdate").alias("ts"),
        F.struct(epoch_ms("l_shipdate").alias("ts"),
                 F.col("l_extendedprice").alias("price")).alias("version"),
    )


def user_profile_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two versions of every profile: ``user_info_raw`` and, written just
    before it, one of level 0 and the other gender."""
    now = user_info_raw(spark, sf_dir)
    other = F.when(F.col("gender") == "M", F.lit("F")).otherwise(F.lit("M"))
    before = now.withColumns({"user_level": F.lit("0"), "gender": other, "seq": F.col("seq") - 1})
    return now.unionByName(before)


def user_info_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User profiles with ``seq`` (write order) for last-write-wins."""
    c = table(spark, sf_dir, "customer")
    key = F.col("c_custkey")
    birthday = F.date_add(F.lit(BIRTHDAY_BASE).cast("date"),
                          ((key * BIRTHDAY_MULT) % BIRTHDAY_SPAN_DAYS).cast("int"))
    return c.select(
        _str(key).alias("id"),
        F.col("c_name").alias("login_name"),
        _str(key % USER_LEVELS + 1).alias("user_level"),
        F.date_format(birthday, "yyyy-MM-dd").alias("birthday"),
        F.when(key % 2 == 0, F.lit("M")).otherwise(F.lit("F")).alias("gender"),
        key.alias("seq"),
    )
