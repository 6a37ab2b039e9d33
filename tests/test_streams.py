"""Streams give what the batch form gives, with the input split so that state crosses batches."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from tallyflow import fixed, schemas
from tallyflow.operators import alerts, first_start, orders as order_ops, sales
from tallyflow.plans import serving, star
from tallyflow.plans.api import RetailQueries
from tallyflow.sources import tables, topics
from tallyflow.sources.commits import Log
from tallyflow.streaming import jobs, sinks, transforms

T0 = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)


def at(**passed):
    return T0 + dt.timedelta(**passed)


def feed(spark, folder, batches, schema):
    """A stream that gets one file per trigger, in the given order."""
    for i, rows in enumerate(batches):
        (spark.createDataFrame(rows, schema).coalesce(1)
         .write.mode("append").parquet(str(folder / f"part={i:03d}")))
    # Files are taken by modification time; one folder level keeps them apart.
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", 1)
            .option("recursiveFileLookup", "true").parquet(str(folder)))


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def split_events(spark, folder, pieces=4, order="ts"):
    """The events of the test tables as files, ordered by time."""
    events = star.table(spark, SMALL, "events").orderBy(order).toPandas()
    size = -(-len(events) // pieces)
    schema = star.table(spark, SMALL, "events").schema
    for i in range(pieces):
        (spark.createDataFrame(events[i * size:(i + 1) * size], schema).coalesce(1)
         .write.parquet(str(folder / f"part={i}")))
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", 1)
            .option("recursiveFileLookup", "true").parquet(str(folder)))


def collect(writer_df, tmp_path, name="out"):
    query = sinks.start(writer_df.writeStream.format("parquet")
                        .option("path", str(tmp_path / name)),
                        name, str(tmp_path / f"{name}_cp"), once=True)
    query.awaitTermination()
    return query


def collect_updates(rows, tmp_path, shown):
    """Rows that an update stream gives out, in order of batches."""
    got = []
    writer = rows.writeStream.outputMode("update").foreachBatch(
        lambda batch, _: got.append(rows_of(batch.select(*shown))))
    query = sinks.start(writer, "updates", str(tmp_path / "cp"), once=True)
    query.awaitTermination()
    return got, query


def test_first_starts_over_batches(spark, tmp_path):
    """Shuffled files: a late, earlier start replaces the one given out before."""
    stream = split_events(spark, tmp_path / "in", order=F.hash("event_id"))
    starts = star.start_columns(stream).withColumn("event_time", F.col("event_time").cast("timestamp"))
    shown = ["mid", "log_date", "log_hour", "event_id"]
    got, query = collect_updates(transforms.first_starts(starts, "60 days", ["event_id"]), tmp_path, shown)
    assert len(got) >= 4
    last = {row[:2]: row for batch in got for row in batch}
    want = rows_of(first_start.first_starts(star.starts(spark, SMALL), tie_breakers=["event_id"]).select(*shown))
    assert sorted(last.values(), key=repr) == want
    assert query.lastProgress.stateOperators[0].numRowsTotal <= len(want)


def test_dau_state_expires(spark, tmp_path):
    stream = split_events(spark, tmp_path / "in")
    starts = star.start_columns(stream).withColumn("event_time", F.col("event_time").cast("timestamp"))
    got, query = collect_updates(transforms.first_starts(starts), tmp_path, ["mid", "log_date"])
    assert query.lastProgress.stateOperators[0].numRowsTotal < len({r for batch in got for r in batch})


def test_alerts_over_batches(spark, tmp_path):
    window, slide = "6 hours", "1 hour"
    events = star.event_columns(split_events(spark, tmp_path / "in"))
    events = events.withColumn("mid", F.col("mid").cast("string"))
    jobs.write_alerts(events, str(tmp_path / "t"), str(tmp_path / "cp"), window, slide,
                      delay="1 hour", min_accounts=2, once=True).awaitTermination()
    got = tables.ALERTS.read(spark, str(tmp_path / "t"))
    last = star.table(spark, SMALL, "events").agg(F.max(F.col("ts").cast("timestamp")))
    mark = last.first()[0] - dt.timedelta(hours=1)
    found = alerts.find_alerts(star.device_events(spark, SMALL), window, slide, 2)
    want = alerts.alert_documents(found.filter(F.col("window_end") <= F.lit(mark)))
    want = want.withColumn("mid", F.col("mid").cast("string"))
    assert want.count() > 0
    assert rows_of(got) == rows_of(want.select(*got.columns))


ORDERS = ["id", "user_id", "order_status", "create_time", "create_date", "order_time"]
LINES = ["id", "order_id", "sku_id", "sku_name", "order_price", "line_time"]
ORDER_SCHEMA = ("id string, user_id string, order_status string, create_time string, "
                "create_date string, order_time timestamp")
LINE_SCHEMA = ("id string, order_id string, sku_id string, sku_name string, "
               "order_price string, line_time timestamp")


def order(i, when):
    return (f"o{i}", f"u{i}", "paid", "2024-01-01 00:00:00", "2024-01-01", when)


def line(i, o, when):
    return (f"l{i}", f"o{o}", f"s{i}", "red ring", "1.5", when)


@pytest.mark.parametrize("hot", [(), ("o1", "o3")])
def test_join_waits_on_both_sides(spark, tmp_path, hot):
    orders = [[order(1, at(minutes=0)), order(2, at(minutes=1))],
              [order(3, at(minutes=40))], [order(4, at(minutes=62))], [order(9, at(hours=9))]]
    lines = [[line(1, 1, at(minutes=0)), line(2, 1, at(minutes=0)),   # same batch, two lines
              line(3, 3, at(minutes=5))],                             # line before its order
             [line(4, 2, at(minutes=30))],                            # order before its line
             [line(5, 1, at(minutes=61)), line(6, 4, at(minutes=1))],  # 61 minutes apart
             [line(7, 8, at(hours=9))]]                               # no order
    # Identical line twice: a pair each; the table keeps one of them.
    lines[0].append(line(1, 1, at(minutes=0)))
    out = transforms.join_lines(feed(spark, tmp_path / "o", orders, ORDER_SCHEMA),
                                feed(spark, tmp_path / "l", lines, LINE_SCHEMA),
                                hot=hot)
    collect(out, tmp_path)
    got = rows_of(spark.read.parquet(str(tmp_path / "out")).select("order_detail_id", "order_id"))
    want = sales.join_lines_within(
        spark.createDataFrame(sum(orders, []), ORDER_SCHEMA),
        spark.createDataFrame(sum(lines, []), LINE_SCHEMA)).select("order_detail_id", "order_id")
    assert got == rows_of(want)
    assert set(got) == {("l1", "o1"), ("l2", "o1"), ("l3", "o3"), ("l4", "o2"), ("l6", "o4")} - {
        ("l6", "o4")}


def start_line(mid, **more):
    return json.dumps({"type": "startup", "mid": mid, "uid": "u", "os": "ios", "appid": "a",
                       "area": "x", "ch": "c", "vs": "1", **more})


def test_log_to_dau_table(spark, tmp_path):
    """Lines are routed, archived, decoded and deduplicated; then the serving query runs."""
    src = tmp_path / "lines"
    src.mkdir()
    (src / "a.txt").write_text("\n".join([
        start_line("m1"), start_line("m1"), start_line("m2"),
        '{"mid":"m3","evid":"coupon","pgid":3}',
        '{"type":"event","mid":"m3","evid":"clickItem"}']))
    lines = spark.readStream.text(str(src))
    path, root = str(tmp_path / "topics"), str(tmp_path / "tables")
    jobs.run_log_router(lines, path, str(tmp_path / "c1"), once=True).awaitTermination()
    jobs.run_archive(topics.folder_topic(spark, path, fixed.TOPIC_START, fixed.TOPIC_EVENT),
                     str(tmp_path / "archive"), str(tmp_path / "c2"), once=True
                     ).awaitTermination()
    starts = topics.folder_topic(spark, path, fixed.TOPIC_START)
    query = jobs.run_dau(starts, root, str(tmp_path / "c3"), once=True)
    query.awaitTermination()

    assert spark.read.text(str(tmp_path / "archive")).count() == 5
    events = spark.read.parquet(path).filter(F.col("topic") == "event")
    assert events.filter(F.col("value").contains('"pgid":3')).count() == 1
    assert events.count() == 2
    dau = tables.read_dau(spark, root)
    assert sorted(r.mid for r in dau.collect()) == ["m1", "m2"]
    assert {r.log_type for r in dau.collect()} == {"startup"}
    observed = [p.observedMetrics for p in query.recentProgress if p.numInputRows]
    assert observed[0]["starts"].rows == 3 and observed[0]["first_starts"].rows == 2

    day = dau.first().log_date
    orders = spark.createDataFrame([], "create_date string, create_hour string, "
                                       "total_amount double")
    total = serving.realtime_total(dau, orders, day).collect()
    assert [(r.id, r.value) for r in total] == [("dau", 2.0), ("order_amount", 0.0)]


def test_second_run_keeps_seen_devices(spark, tmp_path):
    root, cp, src = str(tmp_path / "t"), str(tmp_path / "cp"), tmp_path / "in"

    def run(rows, part):
        (spark.createDataFrame(rows, schemas.TOPIC_RECORD).coalesce(1)
         .write.parquet(str(src / part)))
        stream = (spark.readStream.schema(schemas.TOPIC_RECORD)
                  .option("recursiveFileLookup", "true").parquet(str(src)))
        jobs.run_dau(stream, root, cp, once=True).awaitTermination()

    def record(mid, when):
        return (start_line(mid, ts=int(when.timestamp() * 1000)), when)

    run([record("m1", at(hours=23)), record("m1", at(hours=23, minutes=1))], "p1")
    # The same day again, and the next day after midnight.
    run([record("m1", at(hours=23, minutes=59)), record("m1", at(hours=24)),
         record("m2", at(hours=24))], "p2")
    got = {(r.MID, r.LOG_DATE, r.LOG_HOUR) for r in tables.DAU.read(spark, root).collect()}
    assert got == {("m1", "2024-01-01", "23"), ("m1", "2024-01-02", "00"),
                   ("m2", "2024-01-02", "00")}


def change(event_type, table, entry_type="ROWDATA", **after):
    return {"entry_type": entry_type, "event_type": event_type, "table_name": table,
            "after": [{"name": k, "value": v} for k, v in after.items()]}


def test_changes_to_sale_table(spark, tmp_path):
    src = tmp_path / "changes"
    src.mkdir()
    order_row = dict(id="1", user_id="7", order_status="paid", total_amount="9.5",
                     consignee_tel="13812345678", create_time="2024-01-01 06:19:27")
    (src / "a.json").write_text("\n".join(map(json.dumps, [
        change("INSERT", "order_info", **order_row),
        change("UPDATE", "order_info", **{**order_row, "total_amount": "1"}),
        change("DELETE", "order_info", **order_row),
        change("INSERT", "order_info", entry_type="TRANSACTIONBEGIN", **order_row),
        change("INSERT", "order_detail", id="11", order_id="1", sku_id="3", sku_name="red ring",
               order_price="4.5", sku_num="1"),
        change("INSERT", "order_detail", id="12", order_id="1", sku_id="4", sku_name="box",
               order_price="bad", sku_num="1"),
        change("INSERT", "user_info", id="7", login_name="a", user_level="1",
               birthday="1990-01-01", gender="F"),
    ])))
    path, root = str(tmp_path / "topics"), str(tmp_path / "tables")
    jobs.run_change_router(topics.change_stream(spark, str(src)), path, str(tmp_path / "c1"),
                           once=True).awaitTermination()

    def topic(name):
        return topics.folder_topic(spark, path, name)

    jobs.run_users(topic(fixed.TOPIC_USER_INFO), root, str(tmp_path / "c2"), once=True
                   ).awaitTermination()
    jobs.run_orders(topic(fixed.TOPIC_ORDER), root, str(tmp_path / "c3"), once=True
                    ).awaitTermination()
    jobs.run_sales(topic(fixed.TOPIC_ORDER), topic(fixed.TOPIC_ORDER_DETAIL), root,
                   str(tmp_path / "c4"), as_of=F.lit("2024-01-01").cast("date"), once=True
                   ).awaitTermination()

    stored = tables.read_orders(spark, root).collect()
    assert [(r.id, r.total_amount, r.consignee_tel, r.create_date, r.create_hour)
            for r in stored] == [("1", 9.5, "1381*******", "2024-01-01", "06")]
    wide = tables.SALES.read(spark, root, "2024-01-01").orderBy("order_detail_id").collect()
    assert [(r.order_detail_id, r.sku_price, r.user_gender, r.user_age, r.dt) for r in wide] == [
        ("11", 4.5, "F", 34, "2024-01-01"), ("12", 0.0, "F", 34, "2024-01-01")]


def test_unmatched_rows_are_kept_and_repaired(spark, tmp_path):
    """Partners that missed each other in the stream are joined afterwards, under the commit of their batch."""
    orders = [[order(1, at(minutes=0)), order(2, at(minutes=0))], [order(3, at(hours=5))], [order(9, at(hours=30))]]
    lines = [[line(1, 1, at(minutes=5)), line(2, 7, at(minutes=5))],      # in time; no order at all
             [line(3, 1, at(hours=5)), line(4, 2, at(hours=5))],          # too late, of a met and an unmet order
             [line(9, 8, at(hours=30))]]
    root = str(tmp_path / "t")
    jobs.write_sales(feed(spark, tmp_path / "o", orders, ORDER_SCHEMA), feed(spark, tmp_path / "l", lines, LINE_SCHEMA),
                     root, str(tmp_path / "cp"), "1 hour", "10 minutes", F.lit("2024-01-01").cast("date"), once=True,
                     keep_unmatched=True).awaitTermination()
    pairs, rest = tables.SALES.read(spark, root), tables.UNMATCHED.read(spark, root)
    assert rows_of(pairs.select("order_detail_id", "order_id")) == [("l1", "o1")]
    assert set(rows_of(rest.select("order_detail_id", "order_id"))) == {
        ("l2", "o7"), ("l3", "o1"), ("l4", "o2"), (None, "o2"), (None, "o3")}
    found = sales.repaired(pairs, rest)
    want = sales.join_lines_outer(spark.createDataFrame(sum(orders[:2], []), ORDER_SCHEMA),
                                  spark.createDataFrame(sum(lines[:2], []), LINE_SCHEMA))
    assert rows_of(found.select(*want.columns)) == rows_of(want)


def test_figures_follow_moved_devices_and_replaced_orders(spark, tmp_path):
    root = str(tmp_path / "t")
    schema = "mid string, log_type string, event_time timestamp"
    batches = [[("a", "s", at(hours=9)), ("b", "s", at(hours=9)), (None, "s", at(hours=9))],
               [("a", "s", at(hours=7)), ("b", "s", at(hours=10)), ("c", "s", at(hours=25))]]
    starts = feed(spark, tmp_path / "in", batches, schema).withColumns(
        {c: F.lit(None).cast("string") for c in ("uid", "appid", "area", "os", "ch", "vs")}).withColumn(
            "ts", F.unix_millis("event_time"))
    done = jobs.write_dau(starts, root, str(tmp_path / "cp"), once=True)
    done.awaitTermination()
    figures = {(r.day, r.hour): r.value for r in tables.HOURS.read(spark, root).collect()}
    assert figures == {("2024-01-01", "07"): 1.0, ("2024-01-01", "09"): 1.0, ("2024-01-02", "01"): 1.0}
    state = Log(spark, root).head()
    assert ([p["commit"] for p in state["tables"]["dau"]] == [p["commit"] for p in state["tables"]["seen_device"]]
            == [p["commit"] for p in state["tables"]["hour_figure"]])
    assert tables.SEEN.read(spark, root, "2024-01-01").count() == 3

    kind = "id string, total_amount double, create_time string, arrival timestamp"
    orders = [[("1", 5.0, "2024-01-01 06:00:00", at(hours=6)), ("2", 7.0, "2024-01-01 06:30:00", at(hours=6))],
              [("1", 1.5, "2024-01-01 08:00:00", at(hours=8)), ("3", None, "2024-01-01 08:00:00", at(hours=8)),
               ("4", 2.0, "bad", at(hours=8))]]
    columns = [c for c in fixed.ORDER_COLUMNS if c not in ("id", "total_amount", "create_time", "create_date", "create_hour")]
    stream = order_ops.clean_orders(feed(spark, tmp_path / "orders", orders, kind).withColumns(
        {c: F.lit(None).cast("string") for c in columns}))
    jobs.write_orders(stream, root, str(tmp_path / "cp2"), once=True).awaitTermination()
    answer = RetailQueries(spark, root).hour_figures(fixed.METRIC_ORDER_AMOUNT, "2024-01-01").collect()
    assert {r.log_hour: r.today for r in answer if r.today} == {"06": 7.0, "08": 1.5}
    rows = tables.HOURS.read(spark, root, "2024-01-01")
    assert rows.where("metric = 'dau'").count() <= 24


def test_order_cleaning_is_the_same_in_stream_and_batch(spark, tmp_path):
    schema = "create_time string, consignee_tel string"
    rows = [("2024-01-01 06:00:00", "13812345678"), ("short", None)]
    collect(order_ops.clean_orders(feed(spark, tmp_path / "in", [rows], schema)), tmp_path)
    want = order_ops.clean_orders(spark.createDataFrame(rows, schema))
    assert rows_of(spark.read.parquet(str(tmp_path / "out"))) == rows_of(want)


def test_kafka_options():
    options = topics.kafka_options("a:9092", "start")
    assert options["subscribe"] == "start" and options["startingOffsets"] == "latest"


def test_out_of_order_events_within_the_delay(spark, tmp_path):
    """Events up to half an hour late, over batches, give the alerts of ordered ones."""
    schema = "mid string, uid string, evid string, itemid string, event_time timestamp"
    rows = [("m", str(i % 4), "clickItem" if i % 11 == 0 else "coupon", "1",
             at(minutes=10 * i - (25 if i % 3 == 0 else 0))) for i in range(60)]
    # A pane is done when the watermark has passed it; its windows when a later pane is.
    batches = [rows[:20], rows[20:40], rows[40:], [("z", "1", "coupon", "1", at(hours=20))],
               [("z", "1", "coupon", "1", at(hours=40))]]
    window, slide = "1 hour", "10 minutes"
    jobs.write_alerts(feed(spark, tmp_path / "in", batches, schema), str(tmp_path / "t"),
                      str(tmp_path / "cp"), window, slide, delay="1 hour", once=True
                      ).awaitTermination()
    got = tables.ALERTS.read(spark, str(tmp_path / "t"))
    want = alerts.alert_documents(alerts.find_alerts(
        spark.createDataFrame(rows, schema), window, slide))
    assert got.count() > 5
    assert rows_of(got) == rows_of(want.select(*got.columns))


def test_records_later_than_the_delay_are_left_out(spark, tmp_path):
    schema = "mid string, event_time timestamp"
    # A watermark set by one batch holds for late records from the next but one.
    batches = [[("a", at(hours=0))], [("b", at(hours=60))], [("c", at(hours=59))],
               [("late", at(hours=1)), ("d", at(hours=40))]]
    got, query = collect_updates(transforms.first_starts(
        feed(spark, tmp_path / "in", batches, schema)), tmp_path, ["mid"])
    assert sorted(r for batch in got for r in batch) == [("a",), ("b",), ("c",), ("d",)]
    assert sinks.dropped_late(query) == 1


def test_table_stream_takes_files_and_folders(spark, tmp_path):
    star.table(spark, SMALL, "nation").repartition(3).write.parquet(str(tmp_path / "n.parquet"))
    for i, path in enumerate([f"{SMALL}/nation.parquet", str(tmp_path / "n.parquet")]):
        schema = spark.read.parquet(path).schema
        collect(topics.table_stream(spark, path, schema), tmp_path, f"out{i}")
        assert spark.read.parquet(str(tmp_path / f"out{i}")).count() == 25


def test_ordered_stream_comes_in_order_of_time(spark, tmp_path):
    rows = spark.range(600).select(F.col("id").cast("string").alias("mid"),
                                   F.timestamp_seconds(F.pmod(F.xxhash64("id"), F.lit(10_000))).alias("event_time"))
    stream = topics.ordered_stream(rows, "event_time", str(tmp_path / "in"), 5)
    batches = []
    sinks.start(stream.writeStream.foreachBatch(lambda b, _: batches.append(
        [r.event_time for r in b.collect()])), "ordered", str(tmp_path / "cp"), once=True).awaitTermination()
    batches = [b for b in batches if b]
    assert len(batches) == 5 and sum(map(len, batches)) == 600
    assert all(max(a) <= min(b) for a, b in zip(batches, batches[1:]))


def test_sale_stream_holds_the_wait_only(spark):
    """The named query runs in at least five batches, with less state than input."""
    from tallyflow.plans.registry import QUERIES

    seen = []
    start = sinks.start

    def watched(*args, **kwargs):
        seen.append(start(*args, **kwargs))
        return seen[-1]

    sinks.start = watched
    try:
        QUERIES["stream_sales"](spark, SMALL)
    finally:
        sinks.start = start
    progress = [p for p in seen[0].recentProgress if p.numInputRows]
    assert len(progress) >= 5
    total = sum(p.numInputRows for p in progress)
    assert max(p.stateOperators[0].numRowsTotal for p in progress) < total
    assert sinks.dropped_late(seen[0]) == 0


def test_sales_job_keeps_rows_out_of_the_state(spark, tmp_path):
    """Pairs within and across batches, late rows left out, and a state that does not grow with the rows."""
    orders = [[order(i, at(minutes=i % 50)) for i in range(40)], [order(50, at(hours=2)), order(51, at(hours=9))],
              [order(52, at(hours=9))], [order(53, at(hours=1)), order(54, at(hours=9))]]
    lines = [[line(i, i, at(minutes=i % 50 + 5)) for i in range(40)],
             [line(60, 39, at(minutes=95)), line(61, 38, at(minutes=110)), line(62, 8, at(hours=9))],
             [line(63, 50, at(hours=3)), (None, "o52", "s", None, "bad", None)],
             [line(64, 52, at(hours=9)), line(65, 53, at(hours=1))]]
    root = str(tmp_path / "t")
    query = jobs.write_sales(feed(spark, tmp_path / "o", orders, ORDER_SCHEMA), feed(spark, tmp_path / "l", lines, LINE_SCHEMA),
                             root, str(tmp_path / "cp"), "1 hour", "10 minutes", F.lit("2024-01-01").cast("date"), once=True)
    query.awaitTermination()
    got = rows_of(tables.SALES.read(spark, root).select("order_detail_id", "order_id"))
    # o50 and l63 are an hour apart; o53 and l65 come after the watermark of nine o'clock.
    assert got == sorted([(f"l{i}", f"o{i}") for i in range(40)] + [("l60", "o39"), ("l63", "o50"), ("l64", "o52")],
                         key=repr)
    assert max(p.stateOperators[0].numRowsTotal for p in query.recentProgress) <= 2
    state = Log(spark, root).head()
    kept = [p for name, parts in state["tables"].items() if name.startswith("sale_waiting_") for p in parts]
    assert kept and all(p["high"] >= 1_000_000 * at(hours=7).timestamp() for p in kept)


def test_ordered_stream_reads_a_piece_in_several_files(spark, tmp_path):
    rows = spark.range(600).select(F.timestamp_seconds(F.pmod(F.xxhash64("id"), F.lit(10_000))).alias("event_time"))
    stream, batches = topics.ordered_stream(rows, "event_time", str(tmp_path / "in"), 2), []
    sinks.start(stream.writeStream.foreachBatch(lambda b, _: batches.append(
        (len(b.inputFiles()), [r.event_time for r in b.collect()]))), "pieces", str(tmp_path / "cp"), once=True
    ).awaitTermination()
    assert len(list((tmp_path / "in").glob("part-*"))) == 4  # as many as a shuffle has tasks
    assert len(batches) == 2 and sum(len(b) for _, b in batches) == 600
    assert max(batches[0][1]) <= min(batches[1][1])
