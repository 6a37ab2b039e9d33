"""Daily active devices: the first start of each device per day."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyflow import fixed
from tallyflow.functions import columns as C
from tallyflow.operators.latest import one_per_key


def with_log_time(starts: DataFrame, ts: str = "event_time") -> DataFrame:
    """Add ``log_date`` and ``log_hour``."""
    return (starts.withColumn("log_date", C.day_text(F.col(ts)))
                  .withColumn("log_hour", C.hour_text(F.col(ts))))


def first_starts(starts: DataFrame, ts: str = "event_time",
                 tie_breakers: Sequence[str] = ()) -> DataFrame:
    """The whole row of the first start of each device on each day.

    The key is the day as a date; the text columns are made for the surviving rows only.
    """
    rows = one_per_key(starts, ["mid", F.to_date(ts)], [ts, *tie_breakers])
    return with_log_time(rows, ts)


def first_start_times(starts: DataFrame, ts: str = "event_time") -> DataFrame:
    """Only when each device started first on each day: enough to count devices.

    A hash aggregate with a fixed-width buffer: combined before the shuffle, and no sort.
    """
    times = starts.groupBy("mid", F.to_date(ts).alias("_day")).agg(F.min(ts).alias(ts))
    return with_log_time(times.drop("_day"), ts)


def unseen(first: DataFrame, seen: DataFrame) -> DataFrame:
    """First starts of devices not yet in the table for that day.

    Both sides hold one row per device and day, so no key is hot here; the plan (broadcast or
    shuffle) is left to the measured size of ``seen``, which grows with the number of devices.
    """
    return first.join(seen.select("mid", "log_date"), ["mid", "log_date"], "left_anti")


def to_dau_table(first: DataFrame) -> DataFrame:
    """Record fields to table columns, by name."""
    return first.select([F.col(f).alias(c) for f, c in fixed.DAU_COLUMNS.items()])


def devices_of_day(dau: DataFrame, day: str) -> DataFrame:
    return dau.filter(F.col("log_date") == day).agg(F.count("mid").alias("ct"))


def devices_by_hour(dau: DataFrame, day: str) -> DataFrame:
    """New active devices per hour of a day; the hours add up to ``devices_of_day``."""
    return (dau.filter(F.col("log_date") == day)
               .groupBy("log_hour").agg(F.count("mid").alias("ct")))
