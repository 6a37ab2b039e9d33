"""Hourly series of a day beside the day before."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyflow.functions import columns as C


def hour_maps(rows: DataFrame, day_col: str, hour_col: str, value: Column,
              day: str) -> DataFrame:
    """One row with two maps hour -> value: ``yesterday`` and ``today``.

    One pass over both days; only hours that have rows are in a map.  The maps are built from
    the grouped rows, at most 24 for each day.
    """
    before = C.day_before(day)
    hours = (rows.filter(F.col(day_col).isin(before, day))
                 .groupBy(F.col(day_col).alias("_day"), F.col(hour_col).alias("_hour"))
                 .agg(value.alias("_value")))

    def series(of: str) -> Column:
        entry = F.when((F.col("_day") == of) & F.col("_hour").isNotNull(),
                       F.struct("_hour", "_value"))
        return F.map_from_entries(F.array_sort(F.collect_list(entry)))

    return hours.agg(series(before).alias("yesterday"), series(day).alias("today"))


def hour_spine(maps: DataFrame) -> DataFrame:
    """All 24 hours with both values; a missing hour counts as 0."""
    hour = F.explode(F.transform(F.sequence(F.lit(0), F.lit(23)),
                                 lambda h: F.lpad(h.cast("string"), 2, "0")))
    return (maps.select(hour.alias("log_hour"), "yesterday", "today")
                .select("log_hour",
                        C.or_zero(F.try_element_at("yesterday", "log_hour")).alias("yesterday"),
                        C.or_zero(F.try_element_at("today", "log_hour")).alias("today")))
