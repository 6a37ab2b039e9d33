"""Order cleaning and revenue."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyflow import fixed
from tallyflow.functions import columns as C


def clean_orders(orders: DataFrame) -> DataFrame:
    """Add day and hour of creation, mask the phone number."""
    created = F.col("create_time")
    return (orders.withColumn("create_date", C.text_day(created))
                  .withColumn("create_hour", C.text_hour(created))
                  .withColumn("consignee_tel", C.mask_phone(F.col("consignee_tel"))))


def to_order_table(orders: DataFrame) -> DataFrame:
    """Record fields to table columns, by name."""
    return orders.select([F.col(f).alias(c) for f, c in fixed.ORDER_COLUMNS.items()])


def revenue_of_day(orders: DataFrame, day: str) -> DataFrame:
    """Sum of the order amounts of a day, 0.0 on a day without orders."""
    total = F.coalesce(F.sum("total_amount"), F.lit(0.0))
    return orders.filter(F.col("create_date") == day).agg(total.alias("total_amount"))


def revenue_by_hour(orders: DataFrame, day: str) -> DataFrame:
    return (orders.filter(F.col("create_date") == day)
                  .groupBy("create_hour").agg(F.sum("total_amount").alias("total_amount")))
