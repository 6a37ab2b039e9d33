"""The streaming jobs: topics in, serving tables out."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallyflow import fixed
from tallyflow.functions import columns
from tallyflow.operators import alerts, figures, first_start, orders as order_ops, routing, sales, search
from tallyflow.operators.latest import latest_per_key
from tallyflow.session import configure, keep_state_on_disk
from tallyflow.sources import tables, topics
from tallyflow.sources.commits import Log, job_name
from tallyflow.sources.slices import freed
from tallyflow.streaming import sinks, transforms


def _prepared(spark: SparkSession) -> SparkSession:
    return keep_state_on_disk(configure(spark))


def run_log_router(lines: DataFrame, path: str, checkpoint: str, prefix: str = "",
                   once: bool = False) -> StreamingQuery:
    """Log lines (value) to the start and the event topic, stamped with their arrival."""
    _prepared(lines.sparkSession)
    routed = routing.route_logs(routing.stamp_arrival(lines), prefix)
    return sinks.start(sinks.topics_to_folder(routed, path), "log_router", checkpoint, once)


def run_change_router(changes: DataFrame, path: str, checkpoint: str, prefix: str = "",
                      once: bool = False) -> StreamingQuery:
    """Table changes to the order, order line and user topics."""
    _prepared(changes.sparkSession)
    routed = routing.route_changes(changes, prefix)
    return sinks.start(sinks.topics_to_folder(routed, path), "change_router", checkpoint, once)


def run_archive(records: DataFrame, path: str, checkpoint: str, once: bool = False,
                every: str = "1 minute") -> StreamingQuery:
    """Stamped log lines to the daily archive; nobody waits for it, so in larger files."""
    _prepared(records.sparkSession)
    return sinks.start(sinks.archive_to_folder(records, path), "archive", checkpoint, once, every)


def run_dau(records: DataFrame, root: str, checkpoint: str, delay: str = transforms.DAU_DELAY,
            once: bool = False) -> StreamingQuery:
    """Start records to the DAU table, the devices seen and the figures by hour."""
    starts = sinks.counted(topics.decode_starts(records), "starts")
    return write_dau(starts, root, checkpoint, delay, once=once)


def write_dau(starts: DataFrame, root: str, checkpoint: str, delay: str = transforms.DAU_DELAY,
              tie_breakers: Sequence[str] = (), once: bool = False) -> StreamingQuery:
    """One batch goes to three tables under one commit; rows are counted before and after."""
    spark = _prepared(starts.sparkSession)
    first = sinks.counted(transforms.first_starts(starts, delay, tie_breakers), "first_starts")
    seen = (tables.SEEN, lambda rows: rows.select(F.col("MID").alias("mid"), F.col("LOG_DATE").alias("log_date")))
    writer = first.writeStream.outputMode("update").foreachBatch(sinks.with_figures(
        spark, tables.DAU, root, checkpoint, first_start.to_dau_table, figures.dau_changes, seen))
    return sinks.start(writer, "dau", checkpoint, once)


def run_orders(records: DataFrame, root: str, checkpoint: str,
               once: bool = False) -> StreamingQuery:
    """Order records to the order table and the figures by hour."""
    clean = order_ops.clean_orders(topics.decode_orders(records))
    return write_orders(clean.withColumnRenamed("timestamp", "arrival"), root, checkpoint, once)


def write_orders(orders: DataFrame, root: str, checkpoint: str, once: bool = False) -> StreamingQuery:
    spark = _prepared(orders.sparkSession)

    def newest(batch: DataFrame) -> DataFrame:
        return order_ops.to_order_table(latest_per_key(batch, ["id"], ["arrival"]))

    writer = orders.writeStream.foreachBatch(sinks.with_figures(
        spark, tables.ORDERS, root, checkpoint, newest, figures.amount_changes))
    return sinks.start(writer, "orders", checkpoint, once)


def run_users(records: DataFrame, root: str, checkpoint: str,
              once: bool = False) -> StreamingQuery:
    """User records to the user dimension."""
    return write_users(topics.decode_users(records).withColumnRenamed("timestamp", "arrival"), root,
                       checkpoint, once)


def write_users(users: DataFrame, root: str, checkpoint: str, once: bool = False) -> StreamingQuery:
    spark = _prepared(users.sparkSession)
    writer = users.writeStream.foreachBatch(sinks.upsert(
        spark, tables.USERS, root, checkpoint, lambda batch: latest_per_key(batch, ["id"], ["arrival"])))
    return sinks.start(writer, "users", checkpoint, once)


def run_alerts(records: DataFrame, root: str, checkpoint: str,
               window: str = fixed.ALERT_WINDOW, slide: str = fixed.ALERT_SLIDE,
               delay: str = transforms.ALERT_DELAY,
               min_accounts: int = fixed.ALERT_MIN_ACCOUNTS,
               once: bool = False) -> StreamingQuery:
    """Event records to alert documents."""
    return write_alerts(topics.decode_events(records), root, checkpoint, window, slide, delay,
                        min_accounts, once)


def write_alerts(events: DataFrame, root: str, checkpoint: str, window: str, slide: str,
                 delay: str, min_accounts: int = fixed.ALERT_MIN_ACCOUNTS,
                 once: bool = False) -> StreamingQuery:
    """The stream counts panes; complete panes go to a table of their own, which holds the last window's time.

    After each batch the windows that its last pane completes are swept for alerts.  Panes, documents and how far
    the windows are done are one commit.  Windows are given out when a later pane of any device is complete.
    """
    spark = _prepared(events.sparkSession)
    job = job_name(spark, checkpoint)
    width, size, note = alerts.micros(window), alerts.pane_size(window, slide), f"alerts until {job}"

    def write(batch: DataFrame, batch_id: int) -> None:
        own, done = batch.sparkSession, {}

        def rows(log: Log) -> dict:
            part, state = tables.PANES.write_part(batch, root), log.head()
            if part is None:
                return {}
            after = state["notes"].get(note)
            until = max(part["high"] + size, after or part["high"])
            before = tables.PANES.versions(own, root, None, state, None if after is None else after - width)
            panes = tables.PANES.part_rows(own, root, part).unionByName(before.drop(tables.VERSION))
            done[note] = until
            return {tables.PANES: part, tables.ALERTS: alerts.documents_of_panes(
                panes, window, slide, min_accounts, after, until)}

        with sinks.adaptive(batch):
            if sinks.commit_batch(own, root, job, batch_id, rows, lambda: done) and done:
                tables.expire(own, tables.PANES, root, done[note] - width)

    counts = transforms.pane_counts(events, window, slide, delay)
    return sinks.start(counts.writeStream.foreachBatch(write), "alerts", checkpoint, once)


def run_sales(order_records: DataFrame, line_records: DataFrame, root: str, checkpoint: str,
              wait: str = fixed.JOIN_WAIT, delay: str = transforms.JOIN_DELAY,
              as_of: Column | None = None, once: bool = False, keep_unmatched: bool = False) -> StreamingQuery:
    """Order and line records to wide sale rows; their times are their arrival times."""
    orders = order_ops.clean_orders(topics.decode_orders(order_records))
    return write_sales(orders.withColumnRenamed("timestamp", "order_time"),
                       topics.decode_order_details(line_records)
                       .withColumnRenamed("timestamp", "line_time"),
                       root, checkpoint, wait, delay, as_of, once, keep_unmatched=keep_unmatched)


def write_sales(orders: DataFrame, lines: DataFrame, root: str, checkpoint: str, wait: str,
                delay: str, as_of: Column | None = None, once: bool = False,
                complete: Callable[[DataFrame], DataFrame] = lambda batch: batch,
                keep_unmatched: bool = False, index: bool = False) -> StreamingQuery:
    """``complete`` is applied to the pairs of a batch, for what only lines with an order need.

    The rows of a batch go to a table of the job, which holds the wait, and are joined with each other and with those
    within the wait of them there.  Rows at or before the watermark of the last batch but one are left out, as
    by Spark's stateful operators.
    With ``index`` the words of the product names go to the search index.  With ``keep_unmatched`` lines and orders that met no partner in time go to a table of their own, under the same
    commit; ``sales.repaired`` joins them later.
    """
    spark = _prepared(orders.sparkSession)
    day = F.current_date() if as_of is None else as_of
    job = job_name(spark, checkpoint)
    note, waiting = f"sales until {job}", tables.waiting(job)
    reach, lag = columns.micros(spark, wait), columns.micros(spark, delay)
    arrived = transforms.arrivals(orders, lines, delay)
    types = {f.name: f.dataType for f in arrived.schema.fields}

    def write(batch: DataFrame, batch_id: int) -> None:
        own, done, held = batch.sparkSession, {}, []

        def rows(log: Log) -> dict:
            state = log.head()
            before = state["notes"].get(note, {"seen": {}, "until": 0})
            seen, late = before["seen"], before["until"]
            # The watermark of the batches before: the newest row of the side that lags, less the delay.
            until = max(late, min(seen.values()) // 1000 * 1000 - lag) if len(seen) == 2 else late
            done[note] = {"seen": seen, "until": until}
            part = waiting.write_part(
                batch.where("side <> 'day'").where(F.col("at") > late)
                .withColumns({"batch": F.lit(batch_id), "row": F.monotonically_increasing_id()}), root)
            out: dict = {waiting: part}
            came = waiting.part_rows(own, root, part) if part else waiting.none(own)

            def since(first: int) -> DataFrame:
                waited = waiting.versions(own, root, None, state, first).where(F.col("at") >= first)
                return came.withColumn("new", F.lit(True)).unionByName(
                    waited.drop(tables.VERSION).withColumn("new", F.lit(False)))

            if part:
                newest = came.groupBy("side").agg(F.max("at").alias("at")).collect()
                done[note] = {"seen": {**seen, **{r.side: max(r["at"], seen.get(r.side, r["at"])) for r in newest}},
                              "until": until}
                met = sales.join_arrived(since(part["low"] - reach), reach)
                # Read for the buyers and for the rows: without a cache the join would run twice.
                pairs = met.select([F.col(c).cast(types[c]).alias(c) for c in met.columns]).persist()
                held.append(pairs)
                # The dimension as it is now: each batch sees the latest users, from its buyers' files.
                buyers = pairs.select(F.col("user_id").cast("string").alias("id")).where("id is not null").distinct()
                users = tables.USERS.read_keys(buyers, root, state)
                out[tables.SALES] = tables.SALES.write_part(sales.add_user(complete(pairs), users, day), root)
                if index and out[tables.SALES]:
                    out[tables.POSTINGS] = search.postings(tables.SALES.part_rows(own, root, out[tables.SALES]))
            if keep_unmatched and until > late:
                out[tables.UNMATCHED] = sales.without_partner(since(late - 2 * reach), late - reach, until - reach, reach)
            return out

        try:
            with sinks.adaptive(batch), freed(own):
                if sinks.commit_batch(own, root, job, batch_id, rows, lambda: done):
                    # Partners of rows that are given out as unmatched may be a wait older.  Only this job reads the table.
                    tables.expire(own, waiting, root, done[note]["until"] - (2 if keep_unmatched else 1) * reach, True)
        finally:
            for pairs in held:
                pairs.unpersist()

    return sinks.start(arrived.writeStream.outputMode("update").foreachBatch(write), "sales", checkpoint, once)
