"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def one_per_key(df: DataFrame, keys: Sequence[str | Column],
                order: Sequence[str | Column]) -> DataFrame:
    """The first row of each key in the given order.

    ``row_number() = 1`` is planned as a partial group limit before the shuffle and a final one
    after it: each map task sends at most one row per key, so a key that holds a third of all
    rows costs its reducer no more than one row per map task.
    """
    ranked = Window.partitionBy(*keys).orderBy(*order)
    return (df.withColumn("_rank", F.row_number().over(ranked))
              .filter(F.col("_rank") == 1)
              .drop("_rank"))


def latest_per_key(df: DataFrame, keys: Sequence[str | Column],
                   version: Sequence[str]) -> DataFrame:
    """The newest version of each key: an upsert, seen from the reader."""
    return one_per_key(df, keys, [F.col(v).desc_nulls_last() for v in version])
