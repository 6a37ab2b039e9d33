"""Sinks of the streaming jobs.  Each needs its own checkpoint folder."""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from tallyflow import fixed
from tallyflow.operators import figures, routing
from tallyflow.sources.commits import Log, job_name
from tallyflow.sources.tables import HOURS, ServingTable, tidy

BatchWriter = Callable[[DataFrame, int], None]


def start(writer: DataStreamWriter, name: str, checkpoint: str, once: bool = False,
          every: str = fixed.TRIGGER_INTERVAL) -> StreamingQuery:
    """Start a job: every five seconds, or once over all that is there."""
    trigger = {"availableNow": True} if once else {"processingTime": every}
    return (writer.queryName(name).option("checkpointLocation", checkpoint)
            .trigger(**trigger).start())


@contextmanager
def adaptive(batch: DataFrame):
    """Adaptive planning while a micro-batch is written.

    Streams plan without it, and what ``foreachBatch`` does with a batch inherits that; there
    it is a plain batch job and should split skewed joins and size its output files.
    """
    conf = batch.sparkSession.conf
    before = conf.get("spark.sql.adaptive.enabled")
    conf.set("spark.sql.adaptive.enabled", "true")
    try:
        yield
    finally:
        conf.set("spark.sql.adaptive.enabled", before)


def commit_batch(spark: SparkSession, root: str, job: str, batch_id: int,
                 rows: Callable[[Log], dict[ServingTable, DataFrame | dict | None]],
                 notes: Callable[[], dict] = dict) -> bool:
    """Write the rows of a batch (or take parts written before) to their tables under one commit, once.

    Spark repeats a batch whose end it has not seen.  If its commit is in place it is left out; if not, what
    was written of it counts for nothing, since no commit names it.  Then the tables are gathered
    where that is due.
    """
    log = Log(spark, root)
    if log.has(job, batch_id):
        return False
    parts = {table: table.write_part(part, root) if isinstance(part, DataFrame) else part
             for table, part in rows(log).items()}
    done = log.append({table.name: part for table, part in parts.items()}, job, batch_id, notes())
    tidy(spark, root, *parts)
    return done is not None


def upsert(spark: SparkSession, table: ServingTable, root: str, checkpoint: str,
           shape: Callable[[DataFrame], DataFrame] = lambda batch: batch) -> BatchWriter:
    """Write each batch as the newest rows of its keys, after ``shape``."""
    job = job_name(spark, checkpoint)

    def write(batch: DataFrame, batch_id: int) -> None:
        with adaptive(batch):
            commit_batch(batch.sparkSession, root, job, batch_id, lambda _: {table: shape(batch)})
    return write


def with_figures(spark: SparkSession, table: ServingTable, root: str, checkpoint: str,
                 shape: Callable[[DataFrame], DataFrame],
                 changes: Callable[[DataFrame, DataFrame], DataFrame],
                 *more: tuple[ServingTable, Callable[[DataFrame], DataFrame]]) -> BatchWriter:
    """The same, and the figures by hour brought up to date under the same commit: ``changes`` compares the new rows
    with those they replace, read from the files of their days.  ``more`` tables get the rows in other shapes."""
    job = job_name(spark, checkpoint)

    def write(batch: DataFrame, batch_id: int) -> None:
        own = batch.sparkSession

        def rows(log: Log) -> dict:
            # Written first and read back: the batch is computed once, and no cache holds it.
            part, state = table.write_part(shape(batch), root), log.head()
            if part is None:
                return {}
            now = table.part_rows(own, root, part)
            days = [r[0] for r in now.select(table.day).distinct().collect() if r[0] is not None]
            before = table.read(own, root, *days, state=state) if days else now.limit(0)
            hours = HOURS.read(own, root, *days, state=state) if days else HOURS.none(own)
            moved = figures.changed_figures(changes(now, before), hours)
            return {table: part, HOURS: moved, **{t: other(now) for t, other in more}}

        with adaptive(batch):
            commit_batch(own, root, job, batch_id, rows)
    return write


def topics_to_folder(routed: DataFrame, path: str) -> DataStreamWriter:
    """Routed records as Parquet by topic; for ``topics.folder_topic``."""
    return (routed.select("topic", "value", "timestamp").writeStream
            .format("parquet").option("path", path).partitionBy("topic"))


def topics_to_kafka(routed: DataFrame, servers: str) -> DataStreamWriter:
    """Routed records to their Kafka topics, without key."""
    return (routed.select("topic", "value").writeStream
            .format("kafka").option("kafka.bootstrap.servers", servers))


def archive_to_folder(records: DataFrame, path: str) -> DataStreamWriter:
    """Raw lines as text, one folder per day."""
    return (routing.archive_lines(records).writeStream
            .format("text").option("path", path).partitionBy("log_date"))


def console(rows: DataFrame) -> DataStreamWriter:
    """First rows of each batch on the console."""
    return rows.writeStream.format("console")


def dropped_late(query: StreamingQuery) -> int:
    """Rows that the recent batches left out because they came after the job's delay.

    If it is not 0, the delay is too short: the lag between a record's time and the newest one
    that was seen before it has to stay below it.  State grows with the delay.
    """
    return sum(state.numRowsDroppedByWatermark for progress in query.recentProgress
               for state in progress.stateOperators)


def counted(rows: DataFrame, name: str) -> DataFrame:
    """Row count of each batch as an observed metric of the query progress; no extra job."""
    return rows.observe(name, F.count(F.lit(1)).alias("rows"))
