"""Wide sale rows: order, order line and user."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyflow.functions import columns as C
from tallyflow.operators.latest import latest_per_key

SALE_FIELDS = ("order_detail_id", "order_id", "order_status", "create_time", "user_id",
               "sku_id", "user_gender", "user_age", "user_level", "sku_price", "sku_name", "dt")


def order_side(orders: DataFrame, *keep: str) -> DataFrame:
    """The order fields a wide row needs, so that nothing else is shuffled."""
    return orders.select(F.col("id").alias("order_id"), "order_status", "create_time", "user_id",
                         F.col("create_date").alias("dt"), *keep)


def line_side(lines: DataFrame, *keep: str) -> DataFrame:
    """The line fields a wide row needs; a price that is no number counts as 0."""
    price = F.coalesce(C.to_double(F.col("order_price")), F.lit(0.0))
    return lines.select(F.col("id").alias("order_detail_id"), "order_id", "sku_id", "sku_name",
                        price.alias("sku_price"), *keep)


def join_lines(orders: DataFrame, lines: DataFrame) -> DataFrame:
    """Order lines with their order.  One order has many lines.

    A plain inner join: an order that holds a large share of all lines is split by the adaptive
    skew join, and a side that turns out small is broadcast by its measured size.
    """
    return line_side(lines).join(order_side(orders), "order_id")


def join_lines_within(orders: DataFrame, lines: DataFrame, wait: str = "1 hour",
                      order_time: str = "order_time", line_time: str = "line_time") -> DataFrame:
    """Order lines with their order, where both came within ``wait`` of each other."""
    bound = F.expr(f"INTERVAL {wait}")
    near = F.col(line_time).between(F.col(order_time) - bound, F.col(order_time) + bound)
    joined = line_side(lines, line_time).join(order_side(orders, order_time), "order_id")
    return joined.filter(near).drop(order_time, line_time)


def join_lines_outer(orders: DataFrame, lines: DataFrame) -> DataFrame:
    """Pairs, lines without order and orders without line.

    A full outer join cannot be split when one key is hot.  It is therefore put together from a
    left join, which can, and the orders that no line names, found against the distinct order
    ids of the lines.
    """
    line, order = line_side(lines), order_side(orders)
    with_lines = line.join(order, "order_id", "left")
    named = line.select("order_id").distinct()
    without = order.join(named, "order_id", "left_anti")
    return with_lines.unionByName(without, allowMissingColumns=True)


def _sides(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Orders and lines of ``rows``, which have a ``side`` and a time ``at`` in microseconds."""
    order = rows.where("side = 'order'").select("order_id", "order_status", "create_time", "user_id", "dt", "at", "new")
    line = rows.where("side = 'line'").select("order_detail_id", "order_id", "sku_id", "sku_price", "sku_name", "at", "new")
    return order, line


def join_arrived(rows: DataFrame, wait: int) -> DataFrame:
    """Lines with their order, both in ``rows`` and at most ``wait`` microseconds apart, where one of them is ``new``.

    A plain inner join of a batch and what waits: a hot order is split by the skew join.
    """
    order, line = _sides(rows)
    o, l = order.alias("o"), line.alias("l")
    near = F.col("l.at").between(F.col("o.at") - wait, F.col("o.at") + wait)
    return (l.join(o, (F.col("l.order_id") == F.col("o.order_id")) & near & (F.col("l.new") | F.col("o.new")))
            .select("order_detail_id", "l.order_id", "order_status", "create_time", "user_id", "sku_id", "sku_price",
                    "sku_name", "dt"))


def without_partner(rows: DataFrame, after: int, until: int, wait: int) -> DataFrame:
    """Orders and lines of ``rows`` from ``after`` (not included) to ``until`` that have no partner within ``wait``."""
    sides = _sides(rows.where((F.col("at") > after - wait) & (F.col("at") <= until + wait)))

    def alone(own: DataFrame, other: DataFrame) -> DataFrame:
        o, p = own.where((F.col("at") > after) & (F.col("at") <= until)).alias("o"), other.select("order_id", "at").alias("p")
        near = F.col("p.at").between(F.col("o.at") - wait, F.col("o.at") + wait)
        return o.join(p, (F.col("o.order_id") == F.col("p.order_id")) & near, "left_anti").drop("at", "new")

    return alone(*sides).unionByName(alone(*reversed(sides)), allowMissingColumns=True)


def user_side(users: DataFrame, as_of: Column) -> DataFrame:
    return users.select(F.col("id").alias("user_id"),
                        F.col("gender").alias("user_gender"),
                        C.whole_years(F.col("birthday"), as_of).alias("user_age"),
                        "user_level")


def _known_age(sales: DataFrame) -> DataFrame:
    return sales.withColumn("user_age", C.or_zero(F.col("user_age")))


def add_user(sales: DataFrame, users: DataFrame, as_of: Column) -> DataFrame:
    """Gender, age and level of the buyer; an unknown buyer keeps nulls and age 0.

    ``users`` holds one row per id.  No broadcast is asked for: the dimension grows with the
    business, so its measured size decides, and a hot buyer is split by the skew join.
    """
    wide = sales.join(user_side(users, as_of), "user_id", "left")
    return _known_age(wide).select(*SALE_FIELDS)


def wide_sales(orders: DataFrame, lines: DataFrame, users: DataFrame,
               as_of: Column) -> DataFrame:
    """Wide rows of a whole batch: the same as ``add_user`` of ``join_lines``.

    The buyer is put on the order and not on each of its lines, so the lines, the largest side,
    are shuffled for one join only.
    """
    bought = _known_age(order_side(orders).join(user_side(users, as_of), "user_id", "left"))
    return line_side(lines).join(bought, "order_id").select(*SALE_FIELDS)


def repaired(pairs: DataFrame, unmatched: DataFrame) -> DataFrame:
    """Pairs and what is left of the unmatched rows, once the orders and lines that came too far apart are joined.

    ``unmatched`` holds lines, and orders without line; an order may have met some of its lines in time
    and miss others, so the orders of the pairs are partners, too.
    """
    order = ("order_id", "order_status", "create_time", "user_id", "dt")
    rows = pairs.select(*[c for c in unmatched.columns])
    lines = unmatched.where("order_detail_id is not null").select(
        "order_detail_id", "order_id", "sku_id", "sku_name", "sku_price")
    orders = unmatched.where("order_detail_id is null").select(*order)
    # Only orders that a waiting line names are looked for among the pairs.
    of_pairs = (pairs.select(*order).join(lines.select("order_id").distinct(), "order_id", "left_semi")
                .dropDuplicates(["order_id"]))
    late = lines.join(orders.unionByName(of_pairs).dropDuplicates(["order_id"]), "order_id", "left")
    without = orders.join(lines.select("order_id").distinct(), "order_id", "left_anti")
    return rows.unionByName(late).unionByName(without, allowMissingColumns=True)


def current_users(changes: DataFrame, version: list[str]) -> DataFrame:
    """User dimension: the last change of each user."""
    return latest_per_key(changes, ["id"], version)
