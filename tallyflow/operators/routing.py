"""Routing of log lines and table changes to topics."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyflow import fixed
from tallyflow.functions import columns as C


def stamp_arrival(lines: DataFrame, at: Column | None = None) -> DataFrame:
    """Put the arrival time into each log line as field ``ts`` (epoch ms) and as a column.

    A line that is no JSON object is refused, as the collector would refuse it.
    """
    arrived = F.current_timestamp() if at is None else at
    stamped = C.json_with(F.col("value"), "ts", F.unix_millis("timestamp"))
    return (C.with_computed(lines.withColumn("timestamp", arrived), "value", stamped)
            .filter(F.col("value").isNotNull()))


def route_logs(lines: DataFrame, prefix: str = "") -> DataFrame:
    """Add the topic: start lines to one, all others (also lines without a type) to another."""
    is_start = C.json_field(F.col("value"), "type").eqNullSafe(fixed.TYPE_STARTUP)
    return lines.withColumn("topic", F.when(is_start, prefix + fixed.TOPIC_START)
                                      .otherwise(prefix + fixed.TOPIC_EVENT))


def archive_lines(lines: DataFrame) -> DataFrame:
    """Raw lines with the day they arrived on, for the daily archive."""
    return lines.select(C.day_text(F.col("timestamp")).alias("log_date"), "value")


def route_changes(changes: DataFrame, prefix: str = "") -> DataFrame:
    """Forward the row changes of known tables as (topic, value); drop the rest.

    ``value`` is the row after the change as a JSON object; of a repeated field the last value
    wins.
    """
    routes = [((F.col("event_type") == event) & (F.col("table_name") == table), prefix + name)
              for (event, table), name in fixed.CHANGE_ROUTES.items()]
    # Compared column by column, not as one text, so that a reader can skip by table and event.
    known = reduce(lambda a, b: a | b, [cond for cond, _ in routes])
    topic = F.lit(None).cast("string")
    for cond, name in routes:
        topic = F.when(cond, name).otherwise(topic)
    return (changes.filter((F.col("entry_type") == fixed.ENTRY_ROW_DATA) & known)
                   .withColumn("topic", topic)
                   .withColumn("value", F.to_json(F.map_from_entries("after")))
                   .drop("entry_type", "event_type", "table_name", "after"))
