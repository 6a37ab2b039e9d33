"""Sets of devices as bitmaps: exact counts over any days, merged without going back to the rows.

A dictionary numbers the devices; a day's set is one bitmap of 4 KB for each 32,768 numbers that hold a
device of the day.  Bitmaps of several days are merged by bit operations in the engine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def numbered(devices: DataFrame) -> DataFrame:
    """(mid, no) of distinct devices, in order of their ids.

    Numbers are close together inside a range of ids, so bitmaps are full.  They are made while the rows are
    written: store the result before it is used twice.
    """
    return (devices.select("mid").where("mid is not null").distinct()
            .repartitionByRange("mid").sortWithinPartitions("mid")
            .select("mid", F.monotonically_increasing_id().alias("no")))


def added(dictionary: DataFrame, devices: DataFrame) -> DataFrame:
    """The dictionary with devices that it lacks, which get numbers behind its own."""
    top = dictionary.agg(F.max("no")).first()[0]
    new = numbered(devices.join(dictionary.select("mid"), "mid", "left_anti"))
    return dictionary.unionByName(new.select("mid", (F.col("no") + F.lit(0 if top is None else top + 1)).alias("no")))


def day_sets(first: DataFrame, dictionary: DataFrame, day: str = "log_date") -> DataFrame:
    """(day, part, bits) from rows (mid, day): the devices of each day."""
    rows = first.select("mid", F.col(day).alias("day")).join(dictionary, "mid")
    return rows.groupBy("day", F.bitmap_bucket_number("no").alias("part")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("no")).alias("bits"))


def trailing(sets: DataFrame, days: int) -> DataFrame:
    """(day, n): distinct devices of each day that has any and of the days before it, ``days`` together."""
    have = sets.select(F.to_date("day").alias("day")).distinct()
    spread = sets.select(F.explode(F.sequence(F.to_date("day"), F.date_add(F.to_date("day"), days - 1))).alias("day"),
                         "part", "bits").join(have, "day", "left_semi")
    merged = spread.groupBy("day", "part").agg(F.bitmap_or_agg("bits").alias("bits"))
    return (merged.groupBy("day").agg(F.sum(F.bitmap_count("bits")).alias("n"))
            .select(F.date_format("day", "yyyy-MM-dd").alias("day"), "n"))


def returning(sets: DataFrame, after: int = 1) -> DataFrame:
    """(day, n): devices of each day that were there ``after`` days before, too."""
    own = sets.select("day", "part", "bits")
    before = sets.select(F.date_format(F.date_add(F.to_date("day"), after), "yyyy-MM-dd").alias("day"), "part", "bits")
    both = (own.unionByName(before).groupBy("day", "part")
            .agg(F.bitmap_and_agg("bits").alias("bits"), F.count(F.lit(1)).alias("k"))
            .select("day", F.when(F.col("k") == 2, F.bitmap_count("bits")).otherwise(0).alias("n")))
    counts = both.groupBy("day").agg(F.sum("n").alias("n"))
    return counts.join(sets.select("day").distinct(), "day", "left_semi")
