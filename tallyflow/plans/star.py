"""Records of the shop taken from the star-schema tables.

========  =====================================================================
record    from
========  =====================================================================
start     ``events``: device and user = user_id
event     ``events``: 15 neighbouring users share a device; ``purchase`` is the
          coupon event, ``click`` the item click, the item id is ``k`` of props
purchase  ``events`` of type ``purchase`` as orders, which have a time of day
order     ``orders`` (and ``customer`` for the phone stand-in and the province)
line      ``lineitem`` with the product name from ``part``
user      ``customer``; gender and birthday derived from its key
change    ``orders``, ``lineitem`` and ``customer`` as table changes
========  =====================================================================

Ids keep the type of the tables; the operators do not depend on it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyflow import fixed
from tallyflow.functions import columns as C

USERS_PER_DEVICE = 15
EVENT_NAMES = {"purchase": fixed.EVENT_COUPON, "click": fixed.EVENT_CLICK_ITEM}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _events(spark: SparkSession, folder: str, days: tuple[str, str] | None) -> DataFrame:
    rows = table(spark, folder, "events")
    return rows if days is None else rows.filter(C.on_days(rows, "ts", *days))


def starts(spark: SparkSession, folder: str, days: tuple[str, str] | None = None) -> DataFrame:
    return start_columns(_events(spark, folder, days))


def start_columns(events: DataFrame) -> DataFrame:
    return events.select("event_id", F.col("user_id").alias("mid"), F.col("user_id").alias("uid"),
                         F.col("event_type").alias("log_type"), F.col("ts").alias("event_time"))


def device_events(spark: SparkSession, folder: str) -> DataFrame:
    return event_columns(table(spark, folder, "events"))


def event_columns(events: DataFrame) -> DataFrame:
    evid = F.col("event_type")
    for name, known in EVENT_NAMES.items():
        evid = F.when(F.col("event_type") == name, known).otherwise(evid)
    return events.select(
        F.floor(F.col("user_id") / USERS_PER_DEVICE).alias("mid"),
        F.col("user_id").cast("string").alias("uid"),
        evid.alias("evid"),
        C.json_field(F.col("props"), "k").alias("itemid"),
        F.col("ts").cast("timestamp").alias("event_time"))


def purchases(spark: SparkSession, folder: str,
              days: tuple[str, str] | None = None) -> DataFrame:
    rows = _events(spark, folder, days).filter(F.col("event_type") == "purchase")
    return rows.select(F.col("event_id").alias("id"), F.col("user_id"),
                       F.lit(None).cast("string").alias("consignee_tel"),
                       F.col("value").alias("total_amount"),
                       F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("create_time"))


def buyer() -> Column:
    """The buyer of an order; that of every order whose number ends in 3 is unknown."""
    return F.when(F.col("o_orderkey") % 10 == 3, -F.col("o_custkey")).otherwise(F.col("o_custkey"))


def order_columns(orders: DataFrame, tel: Column | None = None,
                  *extra: Column) -> DataFrame:
    tel = F.lit(None).cast("string") if tel is None else tel
    return orders.select(F.col("o_orderkey").alias("id"), buyer().alias("user_id"),
                         F.col("o_orderstatus").alias("order_status"),
                         F.col("o_totalprice").alias("total_amount"),
                         F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("create_time"),
                         F.col("o_orderdate").cast("timestamp").alias("order_time"),
                         tel.alias("consignee_tel"), *extra)


def orders(spark: SparkSession, folder: str, day: str | None = None) -> DataFrame:
    """Orders without contact columns (enough for the wide rows, and no join)."""
    rows = table(spark, folder, "orders")
    if day is not None:
        rows = rows.filter(C.on_days(rows, "o_orderdate", day, day))
    return order_columns(rows)


def orders_with_contact(spark: SparkSession, folder: str) -> DataFrame:
    customer = table(spark, folder, "customer").select("c_custkey", "c_name", "c_nationkey")
    joined = table(spark, folder, "orders").join(
        customer, F.col("o_custkey") == F.col("c_custkey"), "left")
    return order_columns(joined, F.col("c_name"), F.col("c_nationkey").alias("province_id"))


def short_line_id() -> Column:
    return F.concat_ws("-", "l_orderkey", "l_linenumber")


def long_line_id() -> Column:
    return F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


def order_of_line() -> Column:
    """The order of a line; the seventh lines name orders that are not there."""
    return F.when(F.col("l_linenumber") == 7, -F.col("l_orderkey")).otherwise(F.col("l_orderkey"))


def _line_columns(name: Column) -> list[Column]:
    return [long_line_id().alias("id"), order_of_line().alias("order_id"),
            F.col("l_partkey").alias("sku_id"), name.alias("sku_name"),
            F.col("l_extendedprice").alias("order_price"), F.col("l_quantity").alias("sku_num"),
            F.col("l_shipdate").cast("timestamp").alias("line_time")]


def lines(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines; one whose product is unknown has no product name."""
    part = table(spark, folder, "part").select("p_partkey", "p_name")
    joined = table(spark, folder, "lineitem").join(
        part, F.col("l_partkey") == F.col("p_partkey"), "left")
    return joined.select(_line_columns(F.col("p_name")))


def unnamed_lines(lineitem: DataFrame) -> DataFrame:
    return lineitem.select(_line_columns(F.lit(None).cast("string")))


def users(spark: SparkSession, folder: str) -> DataFrame:
    birthday = F.date_add(F.lit("1965-01-01").cast("date"),
                          F.pmod(F.col("c_custkey") * 37, F.lit(16000)).cast("int"))
    return table(spark, folder, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("login_name"),
        F.col("c_mktsegment").alias("user_level"),
        F.date_format(birthday, "yyyy-MM-dd").alias("birthday"),
        F.when(F.col("c_custkey") % 2 == 0, "M").otherwise("F").alias("gender"))


def _after(**fields: Column) -> Column:
    return F.array(*[F.struct(F.lit(n).alias("name"), v.cast("string").alias("value"))
                     for n, v in fields.items()]).alias("after")


def _change(event_type: Column, table_name: str, after: Column,
            entry_type: Column | None = None) -> list[Column]:
    kind = F.lit(fixed.ENTRY_ROW_DATA) if entry_type is None else entry_type
    return [kind.alias("entry_type"), event_type.alias("event_type"),
            F.lit(table_name).alias("table_name"), after]


def changes(spark: SparkSession, folder: str) -> DataFrame:
    """Table changes.

    Open orders and returned lines are updates and pending orders deletions, which are not
    forwarded; nor are entries of other kinds (orders whose number ends in 7).  The changes of users
    name a field twice, of which the last value counts.
    """
    def insert_unless(cond: Column, other: str = "UPDATE") -> Column:
        return F.when(cond, other).otherwise("INSERT")

    status, key = F.col("o_orderstatus"), F.col("o_orderkey")
    order = table(spark, folder, "orders").select(_change(
        F.when(status == "P", "DELETE").otherwise(insert_unless(status == "O")), "order_info",
        _after(id=key, user_id=F.col("o_custkey"), order_status=status,
               total_amount=F.col("o_totalprice"),
               create_time=F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")),
        F.when(key % 10 == 7, "TRANSACTIONEND").otherwise(fixed.ENTRY_ROW_DATA)))
    line = table(spark, folder, "lineitem").select(_change(
        insert_unless(F.col("l_returnflag") == "R"), "order_detail",
        _after(id=long_line_id(), order_id=F.col("l_orderkey"), sku_id=F.col("l_partkey"),
               order_price=F.col("l_extendedprice"), sku_num=F.col("l_quantity"))))
    user = table(spark, folder, "customer").select(_change(
        insert_unless(F.col("c_acctbal") < 0), "user_info",
        F.concat(_after(id=F.col("c_custkey"), login_name=F.lit("old name"),
                        user_level=F.col("c_mktsegment")),
                 _after(login_name=F.col("c_name"))).alias("after")))
    return order.unionByName(line).unionByName(user)


def log_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Events as JSON log lines: sign-ups are starts, errors have no type."""
    kind = (F.when(F.col("event_type") == "signup", fixed.TYPE_STARTUP)
             .when(F.col("event_type") == "error", None).otherwise("event"))
    line = F.to_json(F.struct(kind.alias("type"), F.col("user_id").alias("mid"),
                              F.col("user_id").alias("uid"), F.col("event_type").alias("evid"),
                              C.json_field(F.col("props"), "k").cast("int").alias("itemid")))
    return table(spark, folder, "events").select(
        "event_id", F.col("ts").cast("timestamp").alias("timestamp"), line.alias("value"))
