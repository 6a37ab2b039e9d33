"""Hourly figures that follow their rows: each change takes the old row's value back and adds the new one's."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyflow import fixed

FIGURE = ("metric", "day", "hour")


def _moved(now: DataFrame, before: DataFrame, key: list[str], metric: str, day: str, hour: str,
           value: Column) -> DataFrame:
    """(metric, day, hour, change) of the rows ``now``, which replace those of ``before`` by key."""
    def signed(rows: DataFrame, sign: int) -> DataFrame:
        return rows.select(F.lit(metric).alias("metric"), F.col(day).alias("day"), F.col(hour).alias("hour"),
                           (F.lit(sign) * value).cast("double").alias("change"))

    gone = before.join(now.select(*key).distinct(), key, "left_semi")
    return (signed(now, 1).unionByName(signed(gone, -1)).groupBy(*FIGURE)
            .agg(F.sum("change").alias("change")))


def dau_changes(now: DataFrame, before: DataFrame) -> DataFrame:
    """Changes by first starts (table columns): an earlier start moves its device to another hour."""
    return _moved(now.where("MID is not null"), before, ["MID", "LOG_DATE"], fixed.METRIC_DAU,
                  "LOG_DATE", "LOG_HOUR", F.lit(1))


def amount_changes(now: DataFrame, before: DataFrame) -> DataFrame:
    """Changes by orders (table columns): an order that comes again replaces its amount."""
    return _moved(now.where("CREATE_DATE is not null"), before, ["ID"], fixed.METRIC_ORDER_AMOUNT, "CREATE_DATE", "CREATE_HOUR",
                  F.coalesce("TOTAL_AMOUNT", F.lit(0.0)))


def changed_figures(changes: DataFrame, figures: DataFrame) -> DataFrame:
    """The new values of the changed figures; ``figures`` holds the current ones (at most 24 per day)."""
    old = figures.select(*FIGURE, F.col("value").alias("old"))
    same = [changes[c].eqNullSafe(old[c]) for c in FIGURE]
    return (changes.join(old, same, "left")
            .select(*[changes[c] for c in FIGURE],
                    (F.col("change") + F.coalesce("old", F.lit(0.0))).alias("value")))
