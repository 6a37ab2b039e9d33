"""Streaming forms of the operators that keep state."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyflow import fixed
from tallyflow.operators import alerts, first_start, sales

# A day, and two hours for late records.
DAU_DELAY = "26 hours"
ALERT_DELAY = "1 minute"
JOIN_DELAY = "10 minutes"
SALTS = 8


def _spread(by: str, salts: int) -> Column:
    return F.pmod(F.xxhash64(by), F.lit(salts))


def first_starts(starts: DataFrame, delay: str = DAU_DELAY,
                 tie_breakers: Sequence[str] = ()) -> DataFrame:
    """The earliest start of each device and day so far, for a stream in update mode.

    An aggregate of the least (time, tie breakers, record): it is combined before the shuffle, so
    a device with very many starts sends one row per task, and holds one state row per device and
    day until ``delay`` has passed the end of the day.  A day's start is given out again when an
    earlier one comes late; the upsert by device and day keeps the last.
    """
    day = F.window("event_time", "1 day")
    order = ["event_time", *tie_breakers]
    rest = [c for c in starts.columns if c not in order and c != "mid"]
    first = (starts.withWatermark("event_time", delay)
             .groupBy("mid", day.alias("_day"))
             .agg(F.min(F.struct(*order, *rest)).alias("_first")))
    return first_start.with_log_time(first.select("mid", "_first.*"))


def _salt(key: str, by: Column, hot: Sequence[str], salts: int) -> Column:
    """0, or one of ``salts`` numbers for keys known to be hot."""
    return F.when(F.col(key).cast("string").isin(*hot), by).otherwise(F.lit(0)) if hot else F.lit(0)


def join_lines(orders: DataFrame, lines: DataFrame, wait: str = fixed.JOIN_WAIT,
               delay: str = JOIN_DELAY, order_time: str = "order_time",
               line_time: str = "line_time", hot: Sequence[str] = (), salts: int = SALTS,
               how: str = "inner") -> DataFrame:
    """Order lines with their order, where both came within ``wait`` of each other.

    Both sides wait in the join state until the watermark says no partner can come.  Streams
    have no skew join: the lines of ``hot`` orders are spread over ``salts`` keys and such an order, of
    which there is only one, is put under each of them; every pair still meets exactly once.
    ``how`` is ``inner``, or ``full_outer`` to give out as well what found no partner in time.
    """
    line = (sales.line_side(lines, line_time).withWatermark(line_time, delay)
            .withColumn("_salt", _salt("order_id", _spread("order_detail_id", salts).cast("int"), hot, salts)))
    order = sales.order_side(orders, order_time).withWatermark(order_time, delay)
    order = (order.withColumn("_salt", F.explode(F.when(
        F.col("order_id").cast("string").isin(*hot), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(
            F.array(F.lit(0))))) if hot else order.withColumn("_salt", F.lit(0)))
    bound = F.expr(f"INTERVAL {wait}")
    left, right = line.alias("l"), order.alias("o")
    near = (F.col(f"l.{line_time}").between(F.col(f"o.{order_time}") - bound,
                                            F.col(f"o.{order_time}") + bound))
    same = (F.col("l.order_id") == F.col("o.order_id")) & (F.col("l._salt") == F.col("o._salt"))
    return (left.join(right, same & near, how)
            .select("order_detail_id", F.coalesce("l.order_id", "o.order_id").alias("order_id"), "order_status",
                    "create_time", "user_id", "sku_id", "sku_price", "sku_name", "dt",
                    (F.col("l.order_id").isNotNull() & F.col("o.order_id").isNotNull()).alias("matched")))


def arrivals(orders: DataFrame, lines: DataFrame, delay: str = JOIN_DELAY, order_time: str = "order_time",
             line_time: str = "line_time") -> DataFrame:
    """Orders and lines as one stream with ``side`` and ``at`` (microseconds), for a job that joins whole batches.

    Only rows within the wait of a batch's ends can meet another batch, so no row goes through a state store.  The
    rows are counted by day (side ``day``) with the delay as watermark: this small state tells what came late and
    lets a last batch without rows complete what waits.  For update mode.
    """
    sides = [sales.order_side(orders, F.col(order_time).alias("_time")).withColumn("side", F.lit("order")),
             sales.line_side(lines, F.col(line_time).alias("_time")).withColumn("side", F.lit("line"))]
    order, line = [side.withColumn("at", F.unix_micros("_time")).drop("_time") for side in sides]
    times = [side.select("_time", "side").withWatermark("_time", delay) for side in sides]
    days = (times[0].union(times[1]).groupBy(F.window("_time", "1 day"), "side").agg(F.count(F.lit(1)).alias("at"))
            .select(F.lit("day").alias("side"), "at"))
    return (order.unionByName(line, allowMissingColumns=True).unionByName(days, allowMissingColumns=True))


def pane_counts(events: DataFrame, window: str = fixed.ALERT_WINDOW,
                slide: str = fixed.ALERT_SLIDE, delay: str = ALERT_DELAY) -> DataFrame:
    """Counted parts per pane and device, given out once a pane is complete."""
    return alerts.stream_pane_counts(events.withWatermark("event_time", delay), window, slide)
