"""The named queries over the star-schema tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyflow import fixed
from tallyflow.functions import columns as C
from tallyflow.operators import (alerts, device_sets, first_start, orders as order_ops, regions, routing,
                                 sales, search)
from tallyflow.operators.latest import latest_per_key, one_per_key
from tallyflow.plans import api, serving, star
from tallyflow.session import configure, keep_state_on_disk, work_dir
from tallyflow.sources import store, tables, topics
from tallyflow.sources.commits import Log
from tallyflow.sources.slices import freed, laid_aside, slice_of, slices_for
from tallyflow.streaming import jobs, sinks, transforms

# Query parameters; the comparison SQL states the same values.
DAY = "2024-01-09"
DAY_BEFORE = "2024-01-08"
SALE_DAY = "1998-10-03"
KEYWORD = "red widget"
ONE_WORD = "red"
AS_OF = "2001-08-01"
LINE_WAIT = "30 days"
STREAM_PIECES = 6
HALF_PIECES = 3
# Users change before the rows of these days come.
USER_SLICES = ("1996-01-01", "1999-01-01")
WIDE_WINDOW = ("6 hours", "1 hour")

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return fn(configure(spark), folder)

    run.__doc__ = fn.__doc__
    QUERIES[fn.__name__] = run
    return run


def money(value: Column) -> Column:
    """Sums of doubles depend on the order of the rows in their last digits."""
    return F.round(value, 2)


def joined(items: Column) -> Column:
    return F.array_join(items, ",")


# --- active devices -------------------------------------------------------------

@query
def dau_first_seen(spark, folder):
    """First start of each device per day."""
    return (first_start.first_starts(star.starts(spark, folder), tie_breakers=["event_id"])
            .select("mid", "uid", "log_type", "log_date", "log_hour", "event_id",
                    F.unix_millis(F.col("event_time").cast("timestamp")).alias("ts")))


@query
def dau_total(spark, folder):
    first = first_start.first_start_times(star.starts(spark, folder, (DAY, DAY)))
    return first_start.devices_of_day(first, DAY)


@query
def dau_hour(spark, folder):
    first = first_start.first_start_times(star.starts(spark, folder, (DAY, DAY)))
    return first_start.devices_by_hour(first, DAY)


@query
def dau_per_day(spark, folder):
    """Active devices of every day."""
    first = first_start.first_start_times(star.starts(spark, folder))
    return first.groupBy("log_date").agg(F.count("mid").alias("ct"))


@query
def dau_unseen(spark, folder):
    """First starts of devices that had no start before noon of that day."""
    rows = star.starts(spark, folder)
    morning = F.hour("event_time") < 12
    seen = first_start.first_start_times(rows.filter(morning))
    late = first_start.first_starts(rows.filter(~morning), tie_breakers=["event_id"])
    return first_start.unseen(late, seen).select("mid", "log_date", "log_hour", "event_id")


@query
def dau_from_log(spark, folder):
    """Log lines to active devices: route, decode, first start."""
    lines = routing.route_logs(routing.stamp_arrival(star.log_lines(spark, folder),
                                                     F.col("timestamp")))
    start = topics.decode_starts(lines.filter(F.col("topic") == fixed.TOPIC_START))
    return (first_start.first_starts(start, tie_breakers=["event_id"])
            .select("mid", "uid", "log_type", "log_date", "log_hour", "ts"))


@query
def dau_table(spark, folder):
    """The rows of the serving table under its column names."""
    lines = routing.stamp_arrival(star.log_lines(spark, folder), F.col("timestamp"))
    start = topics.decode_starts(
        routing.route_logs(lines).filter(F.col("topic") == fixed.TOPIC_START))
    return first_start.to_dau_table(
        first_start.first_starts(start, tie_breakers=["event_id"]))


# --- serving queries: totals and hours --------------------------------------------

def _devices(spark, folder, first_day, last_day):
    return first_start.first_start_times(star.starts(spark, folder, (first_day, last_day)))


def _purchases(spark, folder, first_day, last_day):
    return order_ops.clean_orders(star.purchases(spark, folder, (first_day, last_day)))


@query
def realtime_total(spark, folder):
    figures = serving.realtime_total(_devices(spark, folder, DAY, DAY),
                                     _purchases(spark, folder, DAY, DAY), DAY)
    return figures.withColumn("value", money(F.col("value")))


@query
def realtime_hour_dau(spark, folder):
    return serving.realtime_hour(fixed.METRIC_DAU,
                                 _devices(spark, folder, DAY_BEFORE, DAY), DAY)


@query
def realtime_hour_amount(spark, folder):
    hours = serving.realtime_hour(fixed.METRIC_ORDER_AMOUNT,
                                  _purchases(spark, folder, DAY_BEFORE, DAY), DAY)
    return hours.select("log_hour", money(F.col("yesterday")).alias("yesterday"),
                        money(F.col("today")).alias("today"))


@query
def realtime_hour_map(spark, folder):
    """Hours with new devices only, as the two maps of the query interface."""
    maps = serving.realtime_hour_maps(fixed.METRIC_DAU,
                                      _devices(spark, folder, DAY_BEFORE, DAY), DAY)

    def text(m: str) -> Column:
        return joined(F.transform(F.map_entries(m), lambda e: F.concat_ws(
            "=", e["key"], e["value"].cast("string"))))
    return maps.select(text("yesterday").alias("yesterday"), text("today").alias("today"))


# --- orders -----------------------------------------------------------------------

@query
def order_clean(spark, folder):
    return (order_ops.clean_orders(star.orders_with_contact(spark, folder))
            .select("id", "province_id", "consignee_tel", "order_status", "user_id",
                    "total_amount", "create_time", "create_date", "create_hour"))


@query
def order_day_amount(spark, folder):
    """Revenue of one day, from ``orders``."""
    rows = order_ops.clean_orders(star.orders(spark, folder, SALE_DAY))
    return (order_ops.revenue_of_day(rows, SALE_DAY)
            .select(money(F.col("total_amount")).alias("total_amount")))


@query
def order_hour_amount(spark, folder):
    rows = order_ops.revenue_by_hour(_purchases(spark, folder, DAY, DAY), DAY)
    return rows.withColumn("total_amount", money(F.col("total_amount")))


@query
def sales_by_province(spark, folder):
    rows = regions.sales_by_province(star.orders_with_contact(spark, folder))
    return rows.withColumn("total_amount", money(F.col("total_amount")))


# --- wide sale rows -----------------------------------------------------------------

def _orders(spark, folder, day=None):
    return order_ops.clean_orders(star.orders(spark, folder, day))


def _sales(spark, folder, day=None, part=None):
    """``part`` (k, n): the sales of the k-th of n slices of the orders."""
    orders, lines = _orders(spark, folder, day), star.lines(spark, folder)
    if part:
        k, n = part
        orders, lines = orders.where(slice_of("id", n) == k), lines.where(slice_of("order_id", n) == k)
    return sales.wide_sales(orders, lines, star.users(spark, folder), F.lit(AS_OF).cast("date"))


@query
def sale_join(spark, folder):
    return sales.join_lines(_orders(spark, folder), star.lines(spark, folder))


@query
def sale_outer(spark, folder):
    """Pairs and both unmatched sides."""
    return sales.join_lines_outer(_orders(spark, folder), star.lines(spark, folder))


@query
def sale_interval(spark, folder):
    """Pairs that came within the wait of each other."""
    return sales.join_lines_within(_orders(spark, folder), star.lines(spark, folder), LINE_WAIT)


@query
def sale_enriched(spark, folder):
    return _sales(spark, folder)


@query
def user_dim(spark, folder):
    """Last change of each user: every order of a user is taken as one change."""
    orders = star.table(spark, folder, "orders").select(
        F.col("o_custkey").alias("id"), F.col("o_orderpriority").alias("user_level"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("changed"),
        F.col("o_orderkey").alias("change_id"))
    return sales.current_users(orders, ["changed", "change_id"])


@query
def sale_latest(spark, folder):
    """Upsert by a line id that repeats: the last shipped version stays.

    Ranked by the two numbers the id is made of; the texts are made for the rows that stay.
    """
    line = star.table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity",
        "l_shipdate")
    last = latest_per_key(line, ["l_orderkey", "l_linenumber"],
                          ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity"])
    return last.select(star.short_line_id().alias("order_detail_id"), "l_orderkey", "l_partkey",
                       "l_suppkey", "l_extendedprice", "l_quantity",
                       F.date_format("l_shipdate", "yyyy-MM-dd").alias("dt"))


# --- search ---------------------------------------------------------------------------

@query
def sale_search(spark, folder):
    """All hits of a two-word search over all days."""
    return search.find_sales(_sales(spark, folder), None, KEYWORD)


@query
def sale_page(spark, folder):
    """Second page of ten."""
    return search.page_of(search.find_sales(_sales(spark, folder), None, KEYWORD), 2, 10)


def _counts(spark, folder):
    return search.gender_age_counts(search.find_sales(_sales(spark, folder), None, KEYWORD))


@query
def sale_total(spark, folder):
    return search.hit_total(_counts(spark, folder))


@query
def sale_gender(spark, folder):
    return search.gender_facet(_counts(spark, folder))


@query
def sale_age(spark, folder):
    return search.age_facet(_counts(spark, folder))


@query
def sale_stats(spark, folder):
    return search.stat_rows(_counts(spark, folder))


@query
def sale_detail_day(spark, folder):
    """Statistics of one day and one word."""
    sale = _sales(spark, folder, SALE_DAY)
    stat = serving.sale_detail(sale, SALE_DAY, ONE_WORD, 1, 10)["stat"]
    return (stat.select("total", F.inline("stat"))
            .select("total", "title", F.inline("options")))


@query
def sale_detail_page(spark, folder):
    """First page of one day and one word."""
    sale = _sales(spark, folder, SALE_DAY)
    return serving.sale_detail(sale, SALE_DAY, ONE_WORD, 1, 10)["detail"]


@query
def sale_detail_json(spark, folder):
    """The whole search answer as one JSON text; the page has two rows."""
    return serving.sale_detail_json(_sales(spark, folder), None, KEYWORD, 1, 2)


# --- alerts -----------------------------------------------------------------------------

@query
def device_profiles(spark, folder):
    """Every device in every wide window, alerting or not."""
    return (alerts.device_profiles(star.device_events(spark, folder), *WIDE_WINDOW)
            .select(F.unix_millis("window_end").alias("window_end"), "mid",
                    joined(F.col("uids")).alias("uids"),
                    joined(F.col("item_ids")).alias("item_ids"),
                    joined(alerts.event_list(F.col("event_counts"))).alias("events"),
                    "clicked"))


@query
def alert_windows(spark, folder):
    found = alerts.find_alerts(star.device_events(spark, folder), *WIDE_WINDOW)
    return found.select(F.unix_millis("window_end").alias("window_end"), "mid",
                        joined(F.col("uids")).alias("uids"),
                        joined(F.col("item_ids")).alias("item_ids"))


def _documents(docs):
    return docs.select("alert_id", "mid", joined(F.col("uids")).alias("uids"),
                       joined(F.col("item_ids")).alias("item_ids"),
                       joined(F.col("events")).alias("events"), "ts", "alert_date")


@query
def alert_docs(spark, folder):
    return _documents(alerts.find_documents(star.device_events(spark, folder), *WIDE_WINDOW))


@query
def alert_docs_5s(spark, folder):
    """The 5 min window that slides by 5 s, one account being enough: a document per minute."""
    return _documents(alerts.find_documents(star.device_events(spark, folder), min_accounts=1))


# --- routing ----------------------------------------------------------------------------

@query
def cdc_route(spark, folder):
    """Forwarded table changes as JSON records."""
    return routing.route_changes(star.changes(spark, folder))


@query
def cdc_orders(spark, folder):
    """Order changes routed, decoded and cleaned."""
    routed = routing.route_changes(star.changes(spark, folder))
    orders = topics.decode_orders(routed.filter(F.col("topic") == fixed.TOPIC_ORDER))
    return (order_ops.clean_orders(orders)
            .select("id", "user_id", "order_status", "total_amount", "create_time",
                    "create_date", "create_hour"))


@query
def cdc_sales(spark, folder):
    """Order and line changes routed, decoded and joined; only the joined fields are parsed."""
    routed = routing.route_changes(star.changes(spark, folder))
    orders = topics.decode_orders(routed.filter(F.col("topic") == fixed.TOPIC_ORDER),
                                  ("id", "user_id", "order_status", "create_time"))
    lines = topics.decode_order_details(
        routed.filter(F.col("topic") == fixed.TOPIC_ORDER_DETAIL),
        ("id", "order_id", "sku_id", "sku_name", "order_price"))
    dated = orders.withColumn("create_date", C.text_day(F.col("create_time")))
    return (sales.join_lines(dated, lines)
            .select("order_detail_id", "order_id", "order_status", "create_time", "user_id",
                    "sku_id", "sku_price", "dt"))


@query
def log_route(spark, folder):
    """Log lines with arrival time and topic."""
    lines = routing.stamp_arrival(star.log_lines(spark, folder), F.col("timestamp"))
    return routing.route_logs(lines).select("event_id", "topic", "value")


@query
def log_columns(spark, folder):
    """Hour, day, day before and item number of each event."""
    ts = F.col("ts").cast("timestamp")
    return star.table(spark, folder, "events").select(
        "event_id", C.day_hour_text(F.unix_millis(ts)).alias("day_hour"), C.today(ts).alias("day"),
        C.previous_day(C.day_text(ts)).alias("day_before"),
        C.to_int(C.json_field(F.col("props"), "k")).alias("item"))


@query
def cdc_keys(spark, folder):
    """Changes of each kind, forwarded or not."""
    key = C.route_key(F.col("event_type"), F.col("table_name"))
    return (star.changes(spark, folder).groupBy(key.alias("route_key"), "entry_type")
            .agg(F.count(F.lit(1)).alias("n")))


@query
def log_archive(spark, folder):
    """Daily archive: the lines of each day."""
    lines = routing.stamp_arrival(star.log_lines(spark, folder), F.col("timestamp"))
    return routing.archive_lines(lines)


# --- the query interface over stored tables ------------------------------------------------

def _stored(spark, folder, table, rows):
    """All rows written as the first part of a serving table of their own root."""
    root = work_dir(spark, "tables")
    table.put(rows, root)
    return root


def _cuts(counts, n):
    """Values that cut (value, number of rows) into ``n`` ranges of about as many rows."""
    total, done, cuts = sum(r[1] for r in counts), 0, []
    for value, rows in sorted(map(tuple, counts)):
        if done * n >= (len(cuts) + 1) * total:
            cuts.append(value)
        done += rows
    return cuts


def _stored_orders(spark, folder):
    cleaned = order_ops.clean_orders(star.purchases(spark, folder))
    missing = [c for c in fixed.ORDER_COLUMNS if c not in cleaned.columns]
    rows = cleaned.withColumns({c: F.lit(None).cast("string") for c in missing})
    return order_ops.to_order_table(rows)


def _stored_starts(spark, folder):
    first = first_start.first_starts(star.starts(spark, folder), tie_breakers=["event_id"])
    missing = [c for c in fixed.DAU_COLUMNS if c not in first.columns and c != "ts"]
    rows = first.withColumns({c: F.lit(None).cast("string") for c in missing}).withColumn(
        "ts", F.unix_millis(F.col("event_time").cast("timestamp")))
    return first_start.to_dau_table(rows)


def _order_columns(rows):
    return rows.select("ID", "USER_ID", "TOTAL_AMOUNT", "CREATE_TIME", "CREATE_DATE", "CREATE_HOUR")


@query
def table_orders(spark, folder):
    """The order table, all days, read back."""
    root = _stored(spark, folder, tables.ORDERS, _stored_orders(spark, folder))
    return _order_columns(tables.ORDERS.read(spark, root))


@query
def table_total(spark, folder):
    """Key figures of a day from the two stored tables."""
    root = _stored(spark, folder, tables.ORDERS, _stored_orders(spark, folder))
    tables.DAU.put(_stored_starts(spark, folder), root)
    figures = api.RetailQueries(spark, root).realtime_total(DAY)
    return figures.withColumn("value", money(F.col("value")))


@query
def table_hour(spark, folder):
    """Devices by hour from the stored table: two of its days are opened."""
    root = _stored(spark, folder, tables.DAU, _stored_starts(spark, folder))
    return api.RetailQueries(spark, root).realtime_hour(fixed.METRIC_DAU, DAY)


@query
def table_sale_detail(spark, folder):
    """Statistics of a day and a word from the stored sales of all days."""
    rows = _sales(spark, folder)
    root = _stored(spark, folder, tables.SALES, rows.select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in tables.SALES.schema.fields]))
    stat = api.RetailQueries(spark, root).sale_detail(SALE_DAY, ONE_WORD, 1, 10)["stat"]
    return stat.select("total", F.inline("stat")).select("total", "title", F.inline("options"))


@query
def search_index(spark, folder):
    """Sales of all days that have all words, through the index of words.

    Both tables are made in slices, as many as the lines ask for.
    """
    root, n = work_dir(spark, "tables"), slices_for(star.table(spark, folder, "lineitem").count())
    pieces = (_sales(spark, folder, part=(k, n) if n > 1 else None) for k in range(n))
    with freed(spark):
        days = _cuts(_orders(spark, folder).groupBy(F.coalesce("create_date", F.lit(""))).count().collect(), n)
    tables.SALES.put_pieces(spark, pieces, root, days)
    words = search.postings(tables.SALES.read(spark, root))
    tables.POSTINGS.put_pieces(spark, [words], root, [tables.BUCKETS * k // n for k in range(1, n)])
    return api.RetailQueries(spark, root).search_index(None, KEYWORD)


@query
def table_page(spark, folder):
    """A page far behind, from the files that hold it."""
    root = _stored(spark, folder, tables.PAGES, _sales(spark, folder))
    return tables.PAGES.page(spark, root, 400, 10)


@query
def sale_ranked(spark, folder):
    """The best ten sales of the two words by BM25."""
    found = search.ranked(_sales(spark, folder), None, KEYWORD, 10)
    return found.select("order_detail_id", "sku_name", F.round("score", 6).alias("score"))


def _device_sets(spark, folder):
    out = work_dir(spark, "devices")
    first = first_start.first_start_times(star.starts(spark, folder))
    device_sets.numbered(first).write.parquet(f"{out}/dictionary")
    device_sets.day_sets(first, spark.read.parquet(f"{out}/dictionary")).write.parquet(f"{out}/sets")
    return spark.read.parquet(f"{out}/sets")


@query
def dau_week(spark, folder):
    """Distinct devices of each day and the six before, from bitmaps."""
    return device_sets.trailing(_device_sets(spark, folder), 7)


@query
def dau_return(spark, folder):
    """Devices of each day that were there the day before, from bitmaps."""
    return device_sets.returning(_device_sets(spark, folder))


# --- streams: the jobs run once over the tables -------------------------------------------

def _stream(spark, folder, name):
    schema = star.table(spark, folder, name).schema
    return topics.table_stream(spark, f"{folder}/{name}.parquet", schema)


def _start_stream(events):
    starts = star.start_columns(events).select(
        F.col("mid").cast("string").alias("mid"), F.col("uid").cast("string").alias("uid"), "log_type",
        F.col("event_time").cast("timestamp").alias("event_time"),
        *[F.lit(None).cast("string").alias(c) for c in ("appid", "area", "os", "ch", "vs")])
    return starts.withColumn("ts", F.unix_millis("event_time"))


@query
def stream_dau(spark, folder):
    """The DAU table written by the stream: the earliest start of each device and day."""
    keep_state_on_disk(spark)
    out = work_dir(spark, "stream-dau")
    first = transforms.first_starts(_start_stream(_stream(spark, folder, "events")))
    writer = first.writeStream.outputMode("update").foreachBatch(sinks.upsert(
        spark, tables.DAU, out, f"{out}/checkpoint", first_start.to_dau_table))
    sinks.start(writer, "stream_dau", f"{out}/checkpoint", once=True).awaitTermination()
    return tables.DAU.read(spark, out).select(
        F.col("MID").alias("mid"), F.col("LOG_DATE").alias("log_date"),
        F.col("LOG_HOUR").alias("log_hour"), F.col("TS").alias("ts"))


@query
def stream_fanout(spark, folder):
    """One batch to the DAU table and the seen devices under one commit, and the rows counted before and after."""
    out = work_dir(spark, "stream-fanout")
    starts = sinks.counted(_start_stream(_stream(spark, folder, "events")), "starts")
    done = jobs.write_dau(starts, out, f"{out}/checkpoint", once=True)
    done.awaitTermination()
    observed = [p.observedMetrics for p in done.recentProgress if p.numInputRows]
    state = Log(spark, out).head()
    parts = [state["tables"][t.name] for t in (tables.DAU, tables.SEEN)]
    commits = [{p["commit"] for p in own} for own in parts]
    counts = [("starts", sum(o["starts"].rows for o in observed if "starts" in o)),
              ("first_starts", sum(p["rows"] for p in parts[0])),
              ("commits of one table only", len(commits[0] ^ commits[1]))]
    stored = [t.read(spark, out, state=state).agg(F.count(F.lit(1)).alias("n")).select(
        F.lit(t.name).alias("name"), "n") for t in (tables.DAU, tables.SEEN)]
    return spark.createDataFrame(counts, "name string, n long").unionByName(stored[0]).unionByName(stored[1])


def _replaced_orders(spark, folder):
    """Purchases as orders that arrive in no order of time, every third one first with another amount."""
    paid = star.purchases(spark, folder).select(
        F.col("id").cast("string").alias("id"), F.col("user_id").cast("string").alias("user_id"),
        "consignee_tel", "total_amount", "create_time", F.pmod(F.xxhash64("id"), F.lit(1_000_000)).alias("k"))
    early = paid.where("k % 3 = 0").withColumns({"total_amount": F.col("total_amount") + 100, "k": F.col("k") - 500_000})
    missing = [c for c in fixed.ORDER_COLUMNS if c not in (*paid.columns, "create_date", "create_hour")]
    rows = paid.unionByName(early).withColumn("arrival", F.timestamp_seconds(F.col("k"))).drop("k")
    return order_ops.clean_orders(rows.withColumns({c: F.lit(None).cast("string") for c in missing}))


@query
def stream_hour_figures(spark, folder):
    """Figures by hour that the jobs keep up to date while devices start earlier than known and orders are replaced."""
    out = work_dir(spark, "stream-figures")
    # In order of a hash: most batches hold earlier starts of devices that were counted already.
    shuffled = star.table(spark, folder, "events").withColumn("k", F.xxhash64("event_id"))
    starts = topics.ordered_stream(shuffled, "k", f"{out}/starts", HALF_PIECES)
    jobs.write_dau(_start_stream(starts), out, f"{out}/cp-starts", "60 days", once=True).awaitTermination()
    orders = topics.ordered_stream(_replaced_orders(spark, folder), "arrival", f"{out}/orders", HALF_PIECES)
    jobs.write_orders(orders, out, f"{out}/cp-orders", once=True).awaitTermination()
    answers = api.RetailQueries(spark, out)
    series = [answers.hour_figures(metric, DAY).select(
        F.lit(metric).alias("metric"), "log_hour", money(F.col("yesterday")).alias("yesterday"),
        money(F.col("today")).alias("today")) for metric in (fixed.METRIC_DAU, fixed.METRIC_ORDER_AMOUNT)]
    return series[0].unionByName(series[1])


class _Stopped(Exception):
    """The job is killed here."""


@query
def stream_recovery(spark, folder):
    """The order table after a job that was stopped before a batch, between its files and their commit, and
    between the commit and Spark's own note of the batch, and started again each time."""
    out = work_dir(spark, "stream-recovery")
    rows = _stored_orders(spark, folder)
    stream = topics.ordered_stream(rows, "CREATE_TIME", f"{out}/orders", HALF_PIECES)
    checkpoint, stops = f"{out}/checkpoint", {0: "between", 1: "after", 2: "before"}
    write = sinks.upsert(spark, tables.ORDERS, out, checkpoint)

    def stopped(batch, batch_id):
        at = stops.pop(batch_id, None)
        if at == "before":
            raise _Stopped(at)
        if at == "between":
            tables.ORDERS.write_part(batch, out)
            raise _Stopped(at)
        write(batch, batch_id)
        if at == "after":
            raise _Stopped(at)

    while True:
        job = sinks.start(stream.writeStream.foreachBatch(stopped), "stream_recovery", checkpoint, once=True)
        try:
            job.awaitTermination()
            break
        except StreamingQueryException as error:
            if "_Stopped" not in str(error):
                raise
    return _order_columns(tables.ORDERS.read(spark, out))


def _stream_alerts(spark, folder, window, slide, min_accounts=fixed.ALERT_MIN_ACCOUNTS):
    out = work_dir(spark, "stream-alerts")
    events = star.table(spark, folder, "events")
    # Two records long after all others: the first completes the windows before it, the second its own pane.
    last = events.agg(F.max("ts").alias("ts")).withColumn("days", F.explode(F.array(F.lit(100), F.lit(200)))).select(
        *[(F.col("ts") + F.make_dt_interval("days") if f.name == "ts" else F.lit(None))
          .cast(f.dataType).alias(f.name) for f in events.schema.fields])
    last.write.parquet(f"{out}/last")
    stream = _stream(spark, folder, "events").unionByName(
        topics.table_stream(spark, f"{out}/last", events.schema))
    jobs.write_alerts(star.event_columns(stream), out, f"{out}/checkpoint", window, slide, "1 hour",
                      min_accounts, once=True).awaitTermination()
    return _documents(tables.ALERTS.read(spark, out))


@query
def stream_alerts(spark, folder):
    """Alert documents of the wide windows, from the stream."""
    return _stream_alerts(spark, folder, *WIDE_WINDOW)


@query
def stream_alerts_5s(spark, folder):
    """The 5 min window that slides by 5 s, one account being enough, from the stream."""
    return _stream_alerts(spark, folder, fixed.ALERT_WINDOW, fixed.ALERT_SLIDE, 1)


def _sale_streams(spark, out, orders, lines, *sliced):
    return (topics.ordered_stream(orders, "order_time", f"{out}/orders", STREAM_PIECES, *sliced),
            topics.ordered_stream(lines, "line_time", f"{out}/lines", STREAM_PIECES, *sliced))


def _sale_rows(spark, folder):
    orders = order_ops.clean_orders(star.orders(spark, folder)).drop("consignee_tel")
    return (orders.withColumn("user_id", F.col("user_id").cast("string")),
            star.unnamed_lines(star.table(spark, folder, "lineitem")))


def _with_names(spark, folder):
    names = star.table(spark, folder, "part").select(F.col("p_partkey").alias("sku_id"), "p_name")

    def with_names(rows):
        return rows.drop("sku_name").join(names, "sku_id", "left").withColumnRenamed("p_name", "sku_name")
    return with_names


def _user_rows(spark, folder, arrival):
    return star.users(spark, folder).withColumn("arrival", F.lit(arrival).cast("timestamp"))


@query
def stream_sales(spark, folder):
    """Wide sale rows of lines that came within the wait of their order, over several batches.

    Orders and lines are fed in order of time, so a delay of a day is enough and the state holds
    about the wait.  Product names are put on the pairs of a batch only.
    """
    out = work_dir(spark, "stream-sales")
    tables.USERS.put(_user_rows(spark, folder, "2001-01-01"), out)
    jobs.write_sales(*_sale_streams(spark, out, *_sale_rows(spark, folder)), out, f"{out}/checkpoint", LINE_WAIT,
                     "1 day", F.lit(AS_OF).cast("date"), once=True,
                     complete=_with_names(spark, folder)).awaitTermination()
    return tables.SALES.read(spark, out)


@query
def stream_sales_repaired(spark, folder):
    """Pairs of the stream, and the orders and lines that missed each other there, joined afterwards.

    A table holds one row per id, so of lines that share one the dearest is fed.  What is shuffled before and after the
    stream is shuffled in slices, as many as the lines ask for.
    """
    out, n = work_dir(spark, "stream-repaired"), slices_for(star.table(spark, folder, "lineitem").count())
    orders, lines = _sale_rows(spark, folder)

    def part(rows, key, k, n):
        return rows if n == 1 else rows.where(slice_of(key, n) == k)

    lines = laid_aside((one_per_key(part(lines, "id", k, n), ["id"], [F.desc("order_price")]) for k in range(n)),
                       f"{out}/lines-once")

    def with_last(rows, time):
        """A last row long after all others, whose partner never comes, completes what waits."""
        last = rows.agg(F.max(time).alias("t")).select(
            *[(F.col("t") + F.expr("INTERVAL 400 DAYS") if f.name == time else
               F.lit("-1") if f.name == "id" else F.lit(None)).cast(f.dataType).alias(f.name) for f in rows.schema.fields])
        return rows.unionByName(last)

    streams = _sale_streams(spark, out, with_last(orders, "order_time"), with_last(lines, "line_time"), n, True)
    store.delete(spark, f"{out}/lines-once")
    jobs.write_sales(*streams, out, f"{out}/checkpoint", LINE_WAIT, "1 day", F.lit(AS_OF).cast("date"), once=True,
                     keep_unmatched=True).awaitTermination()
    for name in ("orders", "lines"):
        store.delete(spark, f"{out}/{name}")
    state, with_names = Log(spark, out).head(), _with_names(spark, folder)
    n = slices_for(sum(t.rows_in(spark, out, None, state) for t in (tables.SALES, tables.UNMATCHED)))
    if n == 1:
        return with_names(sales.repaired(tables.SALES.read(spark, out, state=state),
                                         tables.UNMATCHED.read(spark, out, state=state)))
    pairs, unmatched = tables.SALES.versions(spark, out, state=state), tables.UNMATCHED.versions(spark, out, state=state)
    # The newest rows of pairs by their own id, then all by their order, which repairing looks at.
    pairs = laid_aside((tables.SALES.latest(part(pairs, "order_detail_id", k, n)).withColumn("_slice", slice_of("order_id", n))
                        for k in range(n)), f"{out}/pairs", "_slice")
    found = laid_aside((with_names(sales.repaired(pairs.where(F.col("_slice") == k).drop("_slice"), tables.UNMATCHED.latest(
        part(unmatched, "order_id", k, n)))) for k in range(n)), f"{out}/repaired")
    store.delete(spark, f"{out}/pairs")
    return found


@query
def stream_users_sales(spark, folder):
    """Wide sale rows while users change: each batch sees the users as they are when it is written."""
    out = work_dir(spark, "stream-users")
    orders, lines = _sale_rows(spark, folder)

    def input_of(name, rows):
        return spark.readStream.schema(rows.schema).option("recursiveFileLookup", "true").parquet(f"{out}/{name}")

    for k, (low, high) in enumerate(zip(("1900-01-01", *USER_SLICES), (*USER_SLICES, "2100-01-01"))):
        for name, rows, time in (("orders", orders, "order_time"), ("lines", lines, "line_time")):
            rows.where((F.col(time) >= F.lit(low)) & (F.col(time) < F.lit(high))).write.parquet(f"{out}/{name}/{k}")
        users = _user_rows(spark, folder, low)
        if k:
            users = users.where("id % 3 = 1").withColumn("user_level", F.lit(f"level {k}"))
        users.write.parquet(f"{out}/users/{k}")
        jobs.write_users(input_of("users", users), out, f"{out}/cp-users", once=True).awaitTermination()
        jobs.write_sales(input_of("orders", orders), input_of("lines", lines), out, f"{out}/cp-sales", LINE_WAIT,
                         "1 day", F.lit(AS_OF).cast("date"), once=True).awaitTermination()
    return tables.SALES.read(spark, out).drop("sku_name")
