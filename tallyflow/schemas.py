"""Record schemas.

Wire records are decoded with every field as string: changelog values are strings even for
numbers, log fields may be numbers or strings.  Numeric fields are cast afterwards with
``try_cast`` so that one bad value gives a null, not a failed job.
"""

from pyspark.sql import types as T


def _strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


START_WIRE = _strings("type", "mid", "uid", "os", "appid", "area", "ch", "vs", "ts")

EVENT_WIRE = _strings(
    "type", "mid", "uid", "os", "appid", "area", "evid", "pgid", "npgid", "itemid", "ts")

ORDER_WIRE = _strings(
    "id", "province_id", "consignee", "order_comment", "consignee_tel", "order_status",
    "payment_way", "user_id", "img_url", "total_amount", "expire_time", "delivery_address",
    "create_time", "operate_time", "tracking_no", "parent_order_id", "out_trade_no",
    "trade_body")

ORDER_DETAIL_WIRE = _strings(
    "id", "order_id", "sku_name", "sku_id", "order_price", "img_url", "sku_num")

USER_WIRE = _strings("id", "login_name", "user_level", "birthday", "gender")

CHANGELOG = T.StructType([
    T.StructField("entry_type", T.StringType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("table_name", T.StringType()),
    T.StructField("after", T.ArrayType(T.StructType([
        T.StructField("name", T.StringType()),
        T.StructField("value", T.StringType()),
    ]))),
])

# A topic record: its text and the time it arrived.
TOPIC_RECORD = T.StructType([
    T.StructField("value", T.StringType()),
    T.StructField("timestamp", T.TimestampType()),
])

# Tables as stored.
DAU_TABLE = T.StructType(
    _strings("MID", "UID", "APP_ID", "AREA", "OS", "CH", "LOG_TYPE", "VS", "LOG_HOUR").fields
    + [T.StructField("TS", T.LongType()), T.StructField("LOG_DATE", T.StringType())])

ORDER_TABLE = T.StructType(
    [T.StructField(f.name.upper(), f.dataType) for f in ORDER_WIRE.fields
     if f.name != "total_amount"]
    + [T.StructField("TOTAL_AMOUNT", T.DoubleType()),
       T.StructField("CREATE_HOUR", T.StringType()),
       T.StructField("CREATE_DATE", T.StringType())])

USER_TABLE = T.StructType(
    USER_WIRE.fields + [T.StructField("arrival", T.TimestampType())])

SALE_TABLE = T.StructType(
    _strings("order_detail_id", "order_id", "order_status", "create_time", "user_id",
             "sku_id", "user_gender").fields
    + [T.StructField("user_age", T.IntegerType()),
       T.StructField("user_level", T.StringType()),
       T.StructField("sku_price", T.DoubleType()),
       T.StructField("sku_name", T.StringType()),
       T.StructField("dt", T.StringType())])

ALERT_TABLE = T.StructType([
    T.StructField("alert_id", T.StringType()),
    T.StructField("mid", T.StringType()),
    T.StructField("uids", T.ArrayType(T.StringType())),
    T.StructField("item_ids", T.ArrayType(T.StringType())),
    T.StructField("events", T.ArrayType(T.StringType())),
    T.StructField("ts", T.LongType()),
    T.StructField("alert_date", T.StringType()),
])

HOUR_TABLE = T.StructType(
    _strings("metric", "day", "hour").fields + [T.StructField("value", T.DoubleType())])

SEEN_TABLE = _strings("mid", "log_date")

PANE_TABLE = T.StructType(
    [T.StructField("pane", T.LongType())] + _strings("mid", "kind", "name").fields
    + [T.StructField("n", T.LongType())])

UNMATCHED_TABLE = T.StructType(
    _strings("order_id", "order_detail_id", "order_status", "create_time", "user_id", "sku_id").fields
    + [T.StructField("sku_price", T.DoubleType())] + _strings("sku_name", "dt").fields)

WAITING_TABLE = T.StructType(
    [T.StructField("batch", T.LongType()), T.StructField("row", T.LongType()), T.StructField("at", T.LongType())]
    + _strings("side").fields + UNMATCHED_TABLE.fields)

POSTING_TABLE = _strings("word", "order_detail_id", "dt")
