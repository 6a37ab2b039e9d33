"""Sales by province, with the value bands of the map."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyflow import fixed


def value_band(value: Column) -> Column:
    """Lower end of the band of 100 a value falls in; the highest, from 500, has no end.

    Null below 0.
    """
    width, top = fixed.REGION_BAND_WIDTH, fixed.REGION_BAND_TOP
    return F.when(value >= 0, F.least(F.floor(value / width) * width, F.lit(top - width)))


def sales_by_province(orders: DataFrame) -> DataFrame:
    sums = orders.groupBy("province_id").agg(F.sum("total_amount").alias("total_amount"),
                                             F.count(F.lit(1)).alias("order_count"))
    return sums.withColumn("band", value_band(F.col("order_count")))
