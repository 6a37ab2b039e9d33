"""The three serving queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyflow import fixed
from tallyflow.operators import first_start, hourly, orders as order_ops, search


def realtime_total(dau: DataFrame, orders: DataFrame, day: str) -> DataFrame:
    """Key figures of a day: (id, name, value), active devices first, then revenue."""
    def figure(df: DataFrame, metric: str, value: str) -> DataFrame:
        return df.select(F.lit(metric).alias("id"),
                         F.lit(fixed.METRIC_NAMES[metric]).alias("name"),
                         F.col(value).cast("double").alias("value"))

    devices = figure(first_start.devices_of_day(dau, day), fixed.METRIC_DAU, "ct")
    revenue = figure(order_ops.revenue_of_day(orders, day), fixed.METRIC_ORDER_AMOUNT,
                     "total_amount")
    return devices.unionByName(revenue)


def realtime_hour_maps(metric: str, rows: DataFrame, day: str) -> DataFrame | None:
    """Maps hour -> value of a day and the day before; ``None`` for an unknown metric."""
    if metric == fixed.METRIC_DAU:
        return hourly.hour_maps(rows, "log_date", "log_hour", F.count("mid"), day)
    if metric == fixed.METRIC_ORDER_AMOUNT:
        return hourly.hour_maps(rows, "create_date", "create_hour", F.sum("total_amount"), day)
    return None


def realtime_hour(metric: str, rows: DataFrame, day: str) -> DataFrame | None:
    """The same as 24 rows (log_hour, yesterday, today)."""
    maps = realtime_hour_maps(metric, rows, day)
    return None if maps is None else hourly.hour_spine(maps)


def hour_figures(figures: DataFrame, metric: str, day: str) -> DataFrame:
    """24 rows (log_hour, yesterday, today) from stored figures (metric, day, hour, value)."""
    own = figures.filter(F.col("metric") == metric)
    return hourly.hour_spine(hourly.hour_maps(own, "day", "hour", F.max("value"), day))


def sale_detail(sales: DataFrame, day: str | None, keyword: str | None, page: int,
                size: int) -> dict[str, DataFrame]:
    """Search result: ``stat`` (one row: total, stat) and ``detail`` (the page).

    Each of the two reads the hits once with only its own columns; a cache of the hits would
    keep all columns of all hits.
    """
    hits = search.find_sales(sales, day, keyword)
    return {"stat": search.nested_stats(search.gender_age_counts(hits)),
            "detail": search.page_of(hits, page, size)}


def sale_detail_json(sales: DataFrame, day: str | None, keyword: str | None, page: int,
                     size: int) -> DataFrame:
    """The search result as one JSON text; collects no more than one page of rows."""
    parts = sale_detail(sales, day, keyword, page, size)
    rows = parts["detail"].select(F.struct(*parts["detail"].columns).alias("row"))
    detail = rows.agg(F.array_sort(F.collect_list("row")).alias("detail"))
    both = (parts["stat"].withColumn("detail", F.lit(None).cast(detail.schema["detail"].dataType))
            .unionByName(detail, allowMissingColumns=True))
    return both.agg(F.to_json(F.struct(F.max("total").alias("total"),
                                       F.first("stat", ignorenulls=True).alias("stat"),
                                       F.first("detail", ignorenulls=True).alias("detail")))
                    .alias("result"))
