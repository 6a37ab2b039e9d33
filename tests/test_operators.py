"""Batch operators on hand-made rows."""

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from tallyflow import fixed, schemas
from tallyflow.operators import (alerts, first_start, hourly, orders as order_ops, regions,
                                 routing, sales, search)
from tallyflow.operators.latest import latest_per_key, one_per_key
from tallyflow.plans import serving
from tallyflow.session import configure, work_dir
from tallyflow.sources import topics
from tallyflow.streaming import sinks

T0 = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)


def at(**passed):
    return T0 + dt.timedelta(**passed)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture(autouse=True)
def configured(spark):
    configure(spark)


# --- one row per key ------------------------------------------------------------

def test_latest_per_key(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 3, "b"), (1, None, "c"), (2, 1, "d"),
                                (None, 1, "e")], "k int, v int, x string")
    assert rows_of(latest_per_key(df, ["k"], ["v"]).select("x")) == [("b",), ("d",), ("e",)]


def test_one_per_key_sends_one_row_per_task_and_key(spark):
    df = spark.range(1000).withColumn("k", F.col("id") % 3)
    plan = one_per_key(df, ["k"], ["id"])._jdf.queryExecution().executedPlan().toString()
    before_shuffle = plan.split("Exchange")[-1]
    assert "WindowGroupLimit" in before_shuffle


# --- devices ---------------------------------------------------------------------

@pytest.fixture
def starts(spark):
    return spark.createDataFrame(
        [("m1", at(hours=5), 2), ("m1", at(hours=3), 1), ("m1", at(hours=24), 3),
         ("m2", at(hours=23, minutes=59), 4), ("m2", at(hours=3), 5), ("m2", at(hours=3), 6)],
        "mid string, event_time timestamp, n int")


def test_first_starts(starts):
    got = first_start.first_starts(starts, tie_breakers=["n"])
    assert rows_of(got.select("mid", "log_date", "log_hour", "n")) == [
        ("m1", "2024-01-01", "03", 1), ("m1", "2024-01-02", "00", 3),
        ("m2", "2024-01-01", "03", 5)]


def test_start_times_agree_with_rows(starts):
    names = ["mid", "log_date", "log_hour"]
    assert rows_of(first_start.first_start_times(starts).select(names)) == rows_of(
        first_start.first_starts(starts).select(names))


def test_hours_add_up_to_the_day(starts):
    first = first_start.first_start_times(starts)
    hours = first_start.devices_by_hour(first, "2024-01-01")
    assert rows_of(hours) == [("03", 2)]
    assert first_start.devices_of_day(first, "2024-01-01").first().ct == 2
    assert first_start.devices_of_day(first, "2024-02-01").first().ct == 0


def test_unseen_is_by_device_and_day(spark, starts):
    first = first_start.first_start_times(starts)
    seen = spark.createDataFrame([("m1", "2024-01-01")], "mid string, log_date string")
    assert rows_of(first_start.unseen(first, seen).select("mid", "log_date")) == [
        ("m1", "2024-01-02"), ("m2", "2024-01-01")]


def test_dau_table_columns(spark):
    start = topics.decode_starts(spark.createDataFrame(
        [('{"type":"startup","mid":"m1","ts":1704067200000,"appid":"a"}', T0)],
        schemas.TOPIC_RECORD))
    row = first_start.to_dau_table(first_start.first_starts(start)).first()
    assert list(row.asDict()) == list(fixed.DAU_COLUMNS.values())
    assert (row.MID, row.APP_ID, row.LOG_TYPE, row.LOG_HOUR, row.TS) == (
        "m1", "a", "startup", "00", 1704067200000)


# --- orders and serving queries ------------------------------------------------------

@pytest.fixture
def orders(spark):
    return order_ops.clean_orders(spark.createDataFrame(
        [("1", "2024-01-01 05:10:00", "13812345678", 1.5), ("2", "2024-01-01 05:20:00", "1", 2.0),
         ("3", "2024-01-02 23:00:00", None, 4.0), ("4", "bad", "123456", 8.0)],
        "id string, create_time string, consignee_tel string, total_amount double"))


def test_clean_orders(orders):
    assert rows_of(orders.select("id", "create_date", "create_hour", "consignee_tel")) == [
        ("1", "2024-01-01", "05", "1381*******"), ("2", "2024-01-01", "05", "1*******"),
        ("3", "2024-01-02", "23", None), ("4", None, None, "1234*******")]


def test_revenue(orders):
    assert order_ops.revenue_of_day(orders, "2024-01-01").first().total_amount == 3.5
    assert order_ops.revenue_of_day(orders, "2024-05-01").first().total_amount == 0.0
    assert rows_of(order_ops.revenue_by_hour(orders, "2024-01-01")) == [("05", 3.5)]


def test_order_table_columns(spark):
    orders = topics.decode_orders(spark.createDataFrame(
        [('{"id":"1","total_amount":"9","create_time":"2024-01-01 05:10:00"}', T0)],
        schemas.TOPIC_RECORD))
    row = order_ops.to_order_table(order_ops.clean_orders(orders)).first()
    assert list(row.asDict()) == list(fixed.ORDER_COLUMNS.values())
    assert (row.TOTAL_AMOUNT, row.CREATE_DATE, row.CREATE_HOUR) == (9.0, "2024-01-01", "05")


def test_realtime_total(starts, orders):
    got = serving.realtime_total(first_start.first_start_times(starts), orders, "2024-01-01")
    assert [tuple(r) for r in got.collect()] == [
        ("dau", "新增日活", 2.0), ("order_amount", "新增交易额", 3.5)]


def test_realtime_hour(starts, orders):
    got = serving.realtime_hour("order_amount", orders, "2024-01-02").orderBy("log_hour").collect()
    assert len(got) == 24
    assert [tuple(r) for r in got if r.yesterday or r.today] == [
        ("05", 3.5, 0.0), ("23", 0.0, 4.0)]
    dau = serving.realtime_hour("dau", first_start.first_start_times(starts), "2024-01-02")
    assert [tuple(r) for r in dau.orderBy("log_hour").collect() if r.yesterday or r.today] == [
        ("00", 0, 1), ("03", 2, 0)]
    assert serving.realtime_hour("other", orders, "2024-01-02") is None


def test_realtime_hour_maps(orders):
    maps = serving.realtime_hour_maps("order_amount", orders, "2024-01-02").first()
    assert maps.yesterday == {"05": 3.5} and maps.today == {"23": 4.0}
    empty = hourly.hour_spine(serving.realtime_hour_maps("order_amount", orders, "2030-01-01"))
    assert {(r.yesterday, r.today) for r in empty.collect()} == {(0.0, 0.0)}


# --- sales ---------------------------------------------------------------------------------

ORDER = ("id string, user_id string, order_status string, create_time string, "
         "create_date string, order_time timestamp")
LINE = ("id string, order_id string, sku_id string, sku_name string, order_price string, "
        "line_time timestamp")
USER = "id string, birthday string, gender string, user_level string"


def order(i, user="u1", when=T0):
    return (f"o{i}", user, "paid", "2024-01-01 00:00:00", "2024-01-01", when)


def line(i, o, price="1.5", name="red ring", when=T0):
    return (f"l{i}", o and f"o{o}", f"s{i}", name, price, when)


def test_outer_join(spark):
    orders = spark.createDataFrame([order(1), order(2)], ORDER)
    lines = spark.createDataFrame([line(1, 1), line(2, 1), line(3, 7), line(4, None)], LINE)
    got = sales.join_lines_outer(orders, lines).select("order_detail_id", "order_id", "user_id")
    assert rows_of(got) == sorted([
        ("l1", "o1", "u1"), ("l2", "o1", "u1"), ("l3", "o7", None), ("l4", None, None),
        (None, "o2", "u1")], key=repr)
    inner = sales.join_lines(orders, lines)
    assert rows_of(inner.select("order_detail_id")) == [("l1",), ("l2",)]


def test_join_within_an_hour_either_way(spark):
    orders = spark.createDataFrame([order(1, when=at(hours=2))], ORDER)
    lines = spark.createDataFrame(
        [line(1, 1, when=at(hours=1)), line(2, 1, when=at(hours=3)),
         line(3, 1, when=at(minutes=59)), line(4, 1, when=at(minutes=181))], LINE)
    got = sales.join_lines_within(orders, lines)
    assert rows_of(got.select("order_detail_id")) == [("l1",), ("l2",)]


def test_unknown_user_and_bad_values(spark):
    orders = spark.createDataFrame([order(1), order(2, "u9"), order(3, None)], ORDER)
    lines = spark.createDataFrame([line(1, 1, "bad"), line(2, 2), line(3, 3)], LINE)
    users = spark.createDataFrame([("u1", "1990-01-01", "F", "2")], USER)
    wide = sales.add_user(sales.join_lines(orders, lines), users,
                          F.lit("2024-01-01").cast("date"))
    assert tuple(wide.columns) == sales.SALE_FIELDS
    assert rows_of(wide.select("order_detail_id", "user_id", "user_gender", "user_age",
                               "user_level", "sku_price")) == sorted([
        ("l1", "u1", "F", 34, "2", 0.0), ("l2", "u9", None, 0, None, 1.5),
        ("l3", None, None, 0, None, 1.5)], key=repr)
    at_once = sales.wide_sales(orders, lines, users, F.lit("2024-01-01").cast("date"))
    assert at_once.columns == wide.columns and rows_of(at_once) == rows_of(wide)


def test_hot_order_loses_nothing(spark):
    """A third of all lines in one order."""
    orders = spark.createDataFrame([order(i) for i in range(200)], ORDER)
    lines = (spark.range(3000).select(
        F.concat(F.lit("l"), "id").alias("id"),
        F.when(F.col("id") % 3 == 0, "o0").otherwise(
            F.concat(F.lit("o"), F.col("id") % 200)).alias("order_id"),
        F.lit("s").alias("sku_id"), F.lit("n").alias("sku_name"), F.lit("1").alias("order_price"),
        F.lit(T0).alias("line_time")))
    assert sales.join_lines(orders, lines).count() == 3000
    assert sales.join_lines_outer(orders, lines).count() == 3000 + orders.join(
        lines, orders.id == lines.order_id, "left_anti").count()


# --- search -----------------------------------------------------------------------------------

@pytest.fixture
def sold(spark):
    people = [("M", 19), ("M", 20), ("F", 30), ("F", 31), ("F", 31), (None, 0)]
    rows = [(f"d{i}", g, a, "Red Ring", "2024-01-01") for i, (g, a) in enumerate(people)]
    rows += [("d8", "M", 25, "blue ring", "2024-01-01"), ("d9", "M", 25, "red ring", "2024-01-02")]
    return spark.createDataFrame(
        rows, "order_detail_id string, user_gender string, user_age int, sku_name string, "
              "dt string")


def test_search_and_page(sold):
    hits = search.find_sales(sold, "2024-01-01", "ring red")
    assert hits.count() == 6
    assert [r[0] for r in search.page_of(hits, 2, 4).collect()] == ["d4", "d5"]
    assert search.page_of(hits, 3, 4).count() == 0
    assert search.find_sales(sold, "2024-01-01", "").count() == 0
    assert search.find_sales(sold, None, None).count() == 8


def test_facets(sold):
    counts = search.gender_age_counts(search.find_sales(sold, "2024-01-01", "red"))
    assert [tuple(r) for r in search.gender_facet(counts).collect()] == [("F", 3), ("M", 2)]
    assert [tuple(r) for r in search.age_facet(counts).collect()] == [
        (31, 2), (0, 1), (19, 1), (20, 1), (30, 1)]
    assert search.hit_total(counts).first().total == 6


def test_shares(sold):
    counts = search.gender_age_counts(search.find_sales(sold, "2024-01-01", "red"))
    assert [tuple(r) for r in search.stat_rows(counts).collect()] == [
        ("性别占比", "男", 33.3), ("性别占比", "女", 50.0), ("年龄段占比", "20岁以下", 33.3),
        ("年龄段占比", "20岁到30岁", 33.3), ("年龄段占比", "30岁以上", 33.3)]


def test_shares_without_hits(sold):
    counts = search.gender_age_counts(search.find_sales(sold, "2024-01-01", "nothing"))
    nested = search.nested_stats(counts).first()
    assert nested.total == 0
    assert {o.value for s in nested.stat for o in s.options} == {0.0}
    assert search.hit_total(counts).first().total == 0


def test_shares_are_of_all_genders(spark):
    counts = spark.createDataFrame([("X", 20, 5), ("U", 20, 4), ("F", 20, 3), ("M", 20, 2)],
                                   "user_gender string, user_age int, n long")
    shares = {r.name: r.value for r in search.stat_rows(counts).collect()}
    assert (shares["男"], shares["女"]) == (14.3, 21.4)
    assert [r[0] for r in search.gender_facet(counts).collect()] == ["X", "U"]
    assert search.gender_facet(counts, 4).count() == 4


def test_shares_are_of_all_ages(spark):
    counts = spark.createDataFrame([("F", age, 1) for age in range(121)],
                                   "user_gender string, user_age int, n long")
    assert search.age_facet(counts).count() == 100
    shares = {r.name: r.value for r in search.stat_rows(counts).collect()}
    ages = [shares["20岁以下"], shares["20岁到30岁"], shares["30岁以上"]]
    assert ages == [16.5, 9.1, 74.4]


def test_answer_as_json(sold):
    text = serving.sale_detail_json(sold, "2024-01-01", "red", 1, 1).first().result
    assert text.startswith('{"total":6,"stat":[{"title":"性别占比","options":[{"name":"男"')
    assert '"detail":[{"order_detail_id":"d0"' in text and '"d1"' not in text
    none = serving.sale_detail_json(sold, "2024-01-01", "nothing", 1, 1).first().result
    assert '"total":0' in none and '"detail":[]' in none


# --- alerts ---------------------------------------------------------------------------------------

EVENT = "mid string, uid string, evid string, itemid string, event_time timestamp"


def event(mid, uid, evid="coupon", item="1", **passed):
    return (mid, uid, evid, item, at(**passed))


def expected_alerts(rows, width, slide, least):
    """Brute force over every window."""
    found = {}
    starts = {int(r[4].timestamp()) // slide * slide - k * slide
              for r in rows for k in range(width // slide)}
    for start in starts:
        for mid in {r[0] for r in rows}:
            inside = [r for r in rows
                      if r[0] == mid and start <= r[4].timestamp() < start + width]
            uids = {r[1] for r in inside if r[2] == "coupon" and r[1] is not None}
            if len(uids) >= least and not any(r[2] == "clickItem" for r in inside):
                items = {r[3] for r in inside if r[2] == "coupon"}
                found[(start + width, mid)] = (sorted(uids), sorted(items),
                                               sorted(r[2] for r in inside))
    return found


def found_alerts(df):
    listed = df.withColumn("events", alerts.event_list(F.col("event_counts")))
    return {(int(r.window_end.timestamp()), r.mid): (r.uids, r.item_ids, sorted(r.events))
            for r in listed.collect()}


@pytest.fixture
def event_rows():
    return [
        # three accounts, no click
        event("a", "1", seconds=10), event("a", "2", item="2", seconds=70),
        event("a", "3", seconds=200), event("a", "3", "addCart", seconds=201),
        # three accounts, but a click; it leaves the window before the coupons do
        event("b", "1", "clickItem", seconds=0), event("b", "1", seconds=200),
        event("b", "2", seconds=230), event("b", "3", seconds=260),
        # two accounts and one without name
        event("c", "1", seconds=0), event("c", "2", seconds=1), event("c", None, seconds=2),
        # three accounts too far apart
        event("d", "1", seconds=0), event("d", "2", seconds=200), event("d", "3", seconds=301),
        # a device without id
        event(None, "1", seconds=400), event(None, "2", seconds=401), event(None, "3", seconds=402),
        event("e", "1", "addFavor", seconds=0)]


@pytest.mark.parametrize("width, slide, least", [
    (300, 5, 3), (300, 60, 3), (300, 5, 1), (60, 60, 2), (300, 120, 3)])
def test_alerts_against_brute_force(spark, event_rows, width, slide, least):
    events = spark.createDataFrame(event_rows, EVENT)
    window, step = f"{width} seconds", f"{slide} seconds"
    want = expected_alerts(event_rows, width, slide, least) if width % slide == 0 else None
    got = found_alerts(alerts.find_alerts(events, window, step, least))
    if want is None:
        want = found_alerts(alerts.coupon_alerts(alerts.device_profiles(events, window, step), least))
    assert got == want
    if slide == 5 and least == 3:
        assert {mid for _, mid in got} == {"a", "b", None}


def test_stretches_are_runs_of_alerting_starts(spark):
    """The sweep gives every start once, over block borders and gaps, and only alerting ones."""
    rows = [event("a", str(k % 4), "clickItem" if k % 37 == 5 else "coupon", seconds=17 * k) for k in range(150)]
    rows += [event("b", str(k % 3), seconds=5 * k) for k in range(500)]
    events = spark.createDataFrame(rows, EVENT)
    for width, slide in ((60, 5), (60, 20), (60, 60)):
        window, step = f"{width} seconds", f"{slide} seconds"
        found = alerts.alert_stretches(alerts.pane_counts(events, window, step), window, step, 3)
        starts = [tuple(r) for r in alerts.all_starts(found, step).collect()]
        assert len(starts) == len(set(starts))
        want = {(mid, (end - width) * 1_000_000) for end, mid in expected_alerts(rows, width, slide, 3)}
        assert set(starts) == want and {mid for mid, _ in want} == {"a", "b"}
        # A device that alerts all the time is one stretch per block.
        assert found.where("mid = 'b'").count() <= 2 + 2_500 // (alerts.SWEEP * width)


def test_documents_of_stretches(spark, event_rows):
    events = spark.createDataFrame(event_rows, EVENT)
    for window, slide in (("5 minutes", "5 seconds"), ("5 minutes", "30 seconds"), ("5 minutes", "2 minutes")):
        got = alerts.find_documents(events, window, slide, 2)
        want = alerts.alert_documents(alerts.find_alerts(events, window, slide, 2))
        assert got.count() > 0 and rows_of(got) == rows_of(want.select(*got.columns))


def test_documents_of_panes_step_by_step(spark, event_rows):
    """Windows taken in pieces of time give the documents of all windows together."""
    events = spark.createDataFrame(event_rows, EVENT)
    window, slide = "5 minutes", "5 seconds"
    panes = alerts.pane_counts(events, window, slide)
    start = int(T0.timestamp()) * 1_000_000
    marks = [None, *(start + s * 1_000_000 for s in (100, 103, 250, 320, 900))]
    docs = {}
    for after, until in zip(marks, marks[1:]):
        docs.update({r.alert_id: r for r in alerts.documents_of_panes(panes, window, slide, 3, after, until).collect()})
    assert sorted(map(tuple, docs.values()), key=repr) == rows_of(alerts.find_documents(events, window, slide, 3))


def test_one_document_per_minute(spark, event_rows):
    events = spark.createDataFrame(event_rows[:4], EVENT)
    docs = alerts.alert_documents(alerts.find_alerts(events)).orderBy("ts").collect()
    # Windows ending 00:03:25 .. 00:05:10 hold all three accounts.
    assert [d.alert_id for d in docs] == [f"a_{int(T0.timestamp()) // 60 + m}" for m in (3, 4, 5)]
    assert [(d.ts - int(T0.timestamp() * 1000)) // 1000 for d in docs] == [235, 295, 310]
    assert docs[0].events == ["addCart", "coupon", "coupon", "coupon"]
    assert docs[0].alert_date == "2024-01-01"


def test_hot_device(spark):
    """A device with most of the events, in one window: counted, not dropped."""
    events = (spark.range(20000).select(
        F.lit("hot").alias("mid"), (F.col("id") % 50).cast("string").alias("uid"),
        F.lit("coupon").alias("evid"), (F.col("id") % 3).cast("string").alias("itemid"),
        F.lit(T0).alias("event_time")))
    got = alerts.find_alerts(events, "1 minute", "1 minute").collect()
    assert len(got) == 1 and len(got[0].uids) == 50 and got[0].item_ids == ["0", "1", "2"]
    assert sum(e.n for e in got[0].event_counts) == 20000


# --- routing --------------------------------------------------------------------------------------

def test_log_routing(spark):
    lines = spark.createDataFrame(
        [('{"type":"startup","mid":"m"}',), ('{"type":"event"}',), ('{"mid":"x"}',),
         ('{"type":null}',), ("garbage",)], "value string")
    got = routing.route_logs(routing.stamp_arrival(lines, F.lit(T0)), "shop_")
    ms = int(T0.timestamp() * 1000)
    assert rows_of(got.select("topic", "value")) == sorted([
        ("shop_start", f'{{"type":"startup","mid":"m","ts":{ms}}}'),
        ("shop_event", f'{{"type":"event","ts":{ms}}}'), ("shop_event", f'{{"mid":"x","ts":{ms}}}'),
        ("shop_event", f'{{"type":null,"ts":{ms}}}')], key=repr)
    assert rows_of(routing.archive_lines(got).select("log_date").distinct()) == [("2024-01-01",)]


def test_change_routing(spark):
    after = [("id", "1"), ("x", "a"), ("x", "b")]
    changes = spark.createDataFrame(
        [("ROWDATA", e, t, after) for e in ("INSERT", "UPDATE", "DELETE")
         for t in ("order_info", "order_detail", "user_info", "other")]
        + [("TRANSACTIONEND", "INSERT", "order_info", after), ("ROWDATA", None, "user_info", after)],
        schemas.CHANGELOG)
    got = routing.route_changes(changes)
    assert rows_of(got.select("topic")) == [("order",), ("order_detail",), ("user_info",),
                                            ("user_info",)]
    assert {r.value for r in got.collect()} == {'{"id":"1","x":"b"}'}


def test_event_fields_may_be_numbers(spark):
    record = spark.createDataFrame(
        [('{"mid":"m","evid":"coupon","pgid":3,"itemid":7,"ts":1704067200000}', T0)],
        schemas.TOPIC_RECORD)
    row = topics.decode_events(record).first()
    assert (row.pgid, row.itemid, row.ts) == ("3", "7", 1704067200000)


def test_a_busy_device_costs_the_sum_of_its_parts(spark):
    """200 accounts and 200 items in one pane: 401 rows, not 40,000."""
    rows = spark.range(200).crossJoin(spark.range(200).withColumnRenamed("id", "item")).select(
        F.lit(None).cast("string").alias("mid"), F.col("id").cast("string").alias("uid"),
        F.lit("coupon").alias("evid"), F.col("item").cast("string").alias("itemid"),
        F.lit(T0).cast("timestamp").alias("event_time"))
    assert alerts.parts(rows).distinct().count() == 401
    profile = alerts.device_profiles(rows, "5 minutes", "5 minutes").first()
    assert (len(profile.uids), len(profile.item_ids)) == (200, 200)
    assert [(e.evid, e.n) for e in profile.event_counts] == [("coupon", 40_000)]


def test_a_hundred_thousand_accounts_on_a_device(spark):
    rows = spark.range(100_000).select(
        F.lit("hot").alias("mid"), F.col("id").cast("string").alias("uid"), F.lit("coupon").alias("evid"),
        F.lit("1").alias("itemid"), F.lit(T0).cast("timestamp").alias("event_time"))
    found = alerts.find_alerts(rows, "5 minutes", "5 minutes")
    assert [r.n for r in found.select(F.size("uids").alias("n")).collect()] == [100_000]


# --- provinces, work folder, metrics -----------------------------------------------------------------

def test_province_bands(spark):
    values = spark.createDataFrame([(v,) for v in (-1, 0, 99, 100, 599, 600, 601)], "v int")
    got = values.select(regions.value_band(F.col("v")).alias("b")).collect()
    assert [r.b for r in got] == [None, 0, 0, 100, 500, 500, 500]
    orders = spark.createDataFrame([("p", 1.5), ("p", 2.0), (None, 1.0)],
                                   "province_id string, total_amount double")
    assert rows_of(regions.sales_by_province(orders)) == sorted(
        [("p", 3.5, 2, 0), (None, 1.0, 1, 0)], key=repr)


class Session:
    """Stands in for a session with the given settings."""

    def __init__(self, **conf):
        self.conf = {k.replace("_", "."): v for k, v in conf.items()}


def test_work_dir_is_shared_on_a_cluster(spark):
    shared = Session(spark_checkpoint_dir="hdfs://name/shared/", spark_master="yarn")
    assert work_dir(shared, "x").startswith("hdfs://name/shared/x-")
    with pytest.raises(ValueError):
        work_dir(Session(spark_master="yarn"), "x")
    assert work_dir(spark, "x").startswith("/tmp/")


def test_counts_are_observed(spark):
    df = sinks.counted(spark.range(5), "rows_in")
    df.collect()
    assert "rows_in" in df._jdf.queryExecution().observedMetrics().toString()


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.sampled_from("ab"), st.sampled_from("1234"),
                          st.sampled_from(["coupon", "coupon", "addCart", "clickItem"]),
                          st.sampled_from("78"), st.integers(0, 900)), min_size=1, max_size=40))
def test_alerts_of_random_events(spark, drawn):
    rows = [(m, u, e, i, at(seconds=s)) for m, u, e, i, s in drawn]
    got = found_alerts(alerts.find_alerts(spark.createDataFrame(rows, EVENT), "5 minutes",
                                          "30 seconds", 2))
    assert got == expected_alerts(rows, 300, 30, 2)
