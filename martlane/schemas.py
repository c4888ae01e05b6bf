"""Record schemas of the five topics and the derived records.

Field names are snake_case versions of the reference's record types.  Ids,
prices and counts that travel as JSON strings stay strings here; ``ts`` is
epoch milliseconds as in the client logs.
"""

from pyspark.sql import types as T

S = T.StringType()
L = T.LongType()
D = T.DoubleType()


def _struct(*fields):
    return T.StructType([T.StructField(name, typ, True) for name, typ in fields])


# Raw client log line (both startup and event logs share one collector).
CLIENT_LOG = _struct(
    ("type", S), ("mid", S), ("uid", S), ("os", S), ("appid", S), ("area", S),
    ("ch", S), ("vs", S), ("evid", S), ("pgid", S), ("npgid", S), ("itemid", S),
    ("ts", L),
)

STARTUP_LOG = _struct(
    ("mid", S), ("uid", S), ("appid", S), ("area", S), ("os", S), ("ch", S),
    ("log_type", S), ("vs", S), ("log_date", S), ("log_hour", S), ("ts", L),
)

# Columns the DAU sink keeps, in sink order.
DAU_COLUMNS = [f.name for f in STARTUP_LOG.fields]

EVENT_LOG = _struct(
    ("mid", S), ("uid", S), ("appid", S), ("area", S), ("os", S), ("ch", S),
    ("type", S), ("evid", S), ("pgid", S), ("npgid", S), ("itemid", S),
    ("log_date", S), ("log_hour", S), ("ts", L),
)

ORDER_INFO = _struct(
    ("id", S), ("province_id", S), ("consignee", S), ("order_comment", S),
    ("consignee_tel", S), ("order_status", S), ("payment_way", S), ("user_id", S),
    ("img_url", S), ("total_amount", D), ("expire_time", S), ("delivery_address", S),
    ("create_time", S), ("operate_time", S), ("tracking_no", S), ("parent_order_id", S),
    ("out_trade_no", S), ("trade_body", S), ("create_date", S), ("create_hour", S),
)

ORDER_COLUMNS = [f.name for f in ORDER_INFO.fields]

ORDER_DETAIL = _struct(
    ("id", S), ("order_id", S), ("sku_name", S), ("sku_id", S),
    ("order_price", S), ("img_url", S), ("sku_num", S),
)

USER_INFO = _struct(
    ("id", S), ("login_name", S), ("user_level", S), ("birthday", S), ("gender", S),
)

SALE_DETAIL = _struct(
    ("order_detail_id", S), ("order_id", S), ("order_status", S), ("create_time", S),
    ("user_id", S), ("sku_id", S), ("user_gender", S), ("user_age", T.IntegerType()),
    ("user_level", S), ("sku_price", D), ("sku_name", S), ("dt", S),
)

SALE_COLUMNS = [f.name for f in SALE_DETAIL.fields]

ALERT = _struct(
    ("alert_id", S), ("mid", S), ("uids", T.ArrayType(S)), ("item_ids", T.ArrayType(S)),
    ("events", T.ArrayType(_struct(("evid", S), ("n", L)))), ("ts", L),
)

# One captured change entry of the database log, in table form.
CDC_COLUMN = _struct(("name", S), ("value", S))
CDC_CHANGE = _struct(
    ("db", S), ("table_name", S), ("entry_type", S), ("event_type", S), ("seq", L),
    ("rows", T.ArrayType(_struct(("after", T.ArrayType(CDC_COLUMN))))),
)
