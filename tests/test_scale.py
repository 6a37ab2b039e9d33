"""What has to hold for large and uneven data, checked on the plans and on written files."""

import pytest
from pyspark.sql import functions as F

from tallyflow import schemas
from tallyflow.operators import alerts, first_start, sales
from tallyflow.plans.api import RetailQueries
from tallyflow.sources import tables
from tallyflow.streaming import sinks


@pytest.fixture
def skewed(spark):
    """Orders and lines where one order has most of the lines; small limits, no broadcast."""
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
                "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
                "spark.sql.shuffle.partitions": "8"}
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    orders = spark.range(500).select(
        F.col("id").cast("string").alias("id"), F.lit("u1").alias("user_id"),
        F.lit("paid").alias("order_status"), F.lit("t").alias("create_time"),
        F.lit("d").alias("create_date"))
    lines = spark.range(0, 30000, 1, 8).select(
        F.col("id").cast("string").alias("id"),
        F.when(F.col("id") % 3 > 0, "7").otherwise((F.col("id") % 500).cast("string"))
        .alias("order_id"),
        F.lit("s").alias("sku_id"), F.lit("n").alias("sku_name"), F.lit("1").alias("order_price"))
    yield orders, lines
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def final_plan(df):
    df.write.format("noop").mode("overwrite").save()
    rows = df.collect()
    return df._jdf.queryExecution().executedPlan().toString(), rows


@pytest.mark.parametrize("join", [sales.join_lines, sales.join_lines_outer])
def test_hot_order_is_split(skewed, join):
    text, rows = final_plan(join(*skewed))
    assert "skew=true" in text
    assert len(rows) == 30000 if join is sales.join_lines else len(rows) >= 30000


def test_hot_user_is_split(spark, skewed):
    orders, lines = skewed
    users = spark.createDataFrame([("u1", "1990-01-01", "F", "1"), ("u2", None, "M", "2")],
                                  "id string, birthday string, gender string, user_level string")
    wide = sales.add_user(sales.join_lines(orders, lines), users, F.lit("2024-01-01").cast("date"))
    text, rows = final_plan(wide)
    assert "skew=true" in text and len(rows) == 30000
    text, rows = final_plan(sales.wide_sales(orders, lines, users,
                                             F.lit("2024-01-01").cast("date")))
    assert "skew=true" in text and len(rows) == 30000


def test_counting_devices_needs_no_sort(spark):
    starts = spark.range(10).select(F.col("id").alias("mid"), F.current_timestamp()
                                    .alias("event_time"))
    text = (first_start.first_start_times(starts)._jdf.queryExecution().executedPlan()
            .toString())
    assert "SortAggregate" not in text and text.count("HashAggregate") == 2


def test_pruning_keeps_all_alerts(spark):
    events = (spark.range(4000).select(
        (F.col("id") % 7).cast("string").alias("mid"),
        F.pmod(F.xxhash64("id"), F.lit(5)).cast("string").alias("uid"),
        F.when(F.pmod(F.hash("id"), F.lit(40)) == 0, "clickItem").otherwise("coupon")
        .alias("evid"), F.lit("1").alias("itemid"),
        F.timestamp_millis(F.col("id") * 7919).alias("event_time")))
    window = ("5 minutes", "1 minute")
    pruned = alerts.find_alerts(events, *window, 4)
    whole = alerts.coupon_alerts(alerts.device_profiles(events, *window), 4)
    names = ["window_end", "mid", "uids", "item_ids"]
    got = sorted(map(tuple, pruned.select(names).collect()))
    assert got and got == sorted(map(tuple, whole.select(names).collect()))


def test_days_are_pruned(spark, tmp_path):
    root = str(tmp_path)
    rows = [(f"m{i}", "u", None, None, None, None, "startup", None, "05", 1, f"2024-01-0{d}")
            for i in range(3) for d in (1, 2, 3)]
    # A file per day, so that what is opened can be told from the names.
    for d in (1, 2, 3):
        own = [r for r in rows if r[-1] == f"2024-01-0{d}"]
        tables.DAU.put(spark.createDataFrame(own, schemas.DAU_TABLE), root)
    of_days = tables.DAU.files(spark, root, ["2024-01-01", "2024-01-02"])
    assert sorted(of_days) == [1, 2]
    spark.conf.set("spark.sql.maxMetadataStringLength", 10000)
    queries = RetailQueries(spark, root)
    hours = queries.realtime_hour("dau", "2024-01-02")
    assert ({f.rsplit("/", 1)[1] for f in hours.inputFiles()}
            == {f.rsplit("/", 1)[1] for files in of_days.values() for f in files})
    assert [tuple(r) for r in hours.collect() if r.today] == [("05", 3, 3)]
    assert queries.realtime_total_json("2024-01-02").first().result == (
        '[{"id":"dau","name":"新增日活","value":3.0},'
        '{"id":"order_amount","name":"新增交易额","value":0.0}]')
    assert queries.realtime_hour_json("dau", "2024-01-03").first().result == (
        '{"yesterday":{"05":3},"today":{"05":3}}')
    assert queries.realtime_hour_json("other", "2024-01-03") is None
    assert queries.realtime_hour("other", "2024-01-03") is None


def test_search_reads_one_day(spark, tmp_path):
    root = str(tmp_path)
    rows = [(f"d{i}", "o", "paid", "t", "u", "s", "M", 20, "1", 1.0, "red ring", f"2024-01-0{d}")
            for i, d in enumerate((1, 1, 2))]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        tables.SALES.put(spark.createDataFrame(rows, schemas.SALE_TABLE), root)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    answer = RetailQueries(spark, root).sale_detail("2024-01-01", "red", 1, 10)
    assert answer["stat"].first().total == 2 and answer["detail"].count() == 2
    # Ranges of days: the files of the other day stay shut.
    every = tables.SALES.files(spark, root)[1]
    opened = answer["stat"].inputFiles()
    assert 0 < len(opened) < len(every)
    assert spark.read.parquet(*opened).where("dt <> '2024-01-01'").count() == 0
    result = RetailQueries(spark, root).sale_detail_json("2024-01-01", "red", 1, 1).first().result
    assert result.startswith('{"total":2,') and result.count('"order_detail_id"') == 1


def test_batches_are_written_in_few_files(spark, tmp_path):
    """Also from a stream, which plans with a fixed number of partitions."""
    source = str(tmp_path / "in")
    spark.range(0, 100, 1, 1).select(F.lit("u").alias("id"), F.col("id").alias("n")).write.parquet(
        source)
    stream = (spark.readStream.schema("id string, n long").parquet(source)
              .groupBy("id", "n").count())
    users = stream.select(F.concat("id", "n").alias("id"), F.lit("a").alias("login_name"),
                          F.lit("1").alias("user_level"), F.lit("2000-01-01").alias("birthday"),
                          F.lit("F").alias("gender"), F.lit(None).cast("timestamp")
                          .alias("arrival"))
    writer = users.writeStream.outputMode("update").foreachBatch(
        sinks.upsert(spark, tables.USERS, str(tmp_path), str(tmp_path / "cp")))
    sinks.start(writer, "few_files", str(tmp_path / "cp"), once=True).awaitTermination()
    files = list((tmp_path / "user_info_dim").glob("parts/*/*.parquet"))
    assert len(files) == 1
    assert tables.USERS.versions(spark, str(tmp_path)).count() == 100


def test_console_and_kafka_writers(spark, tmp_path):
    source = str(tmp_path / "in")
    spark.createDataFrame([("start", "{}", None)],
                          "topic string, value string, timestamp timestamp").write.parquet(source)
    stream = spark.readStream.schema("topic string, value string, timestamp timestamp").parquet(
        source)
    query = sinks.start(sinks.console(stream), "console", str(tmp_path / "cp"), once=True)
    query.awaitTermination()
    assert query.recentProgress[0].numInputRows == 1
    assert sinks.topics_to_kafka(stream, "host:9092") is not None


def test_the_index_opens_the_files_of_its_words(spark, tmp_path):
    from tallyflow.operators import search
    from tallyflow.sources.commits import Log

    root = str(tmp_path)
    names = [f"red thing{k} Widget" if k % 7 else f"Red blue{k}" for k in range(400)]
    rows = [(f"d{k}", "o", "paid", "t", "u", "s", "M", 20, "1", 1.0, names[k], f"2024-01-0{1 + k % 5}") for k in range(400)]
    rows += [("none", "o", "paid", "t", "u", "s", "M", 20, "1", 1.0, None, None)]
    sales_rows = spark.createDataFrame(rows, schemas.SALE_TABLE)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        tables.SALES.put(sales_rows, root)
        tables.POSTINGS.put(search.postings(sales_rows), root)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    queries = RetailQueries(spark, root)
    for day, word in ((None, "red"), (None, "widget RED"), ("2024-01-02", "blue7"), (None, "thing15 widget"),
                      (None, "nothing red"), (None, " ")):
        want = search.find_sales(sales_rows, day, word)
        got = queries.search_index(day, word)
        assert sorted(r.order_detail_id for r in got.collect()) == sorted(r.order_detail_id for r in want.collect())
    state = Log(spark, root).head()
    wanted = [r.b for r in spark.createDataFrame([("blue7",)], "word string").select(tables.bucket("word").alias("b")).collect()]
    assert len(tables.POSTINGS.files(spark, root, wanted, state)[2]) < len(tables.POSTINGS.files(spark, root)[2])
    one_day = queries.search_index(None, "thing15")
    assert len([f for f in one_day.inputFiles() if "/sale_detail/" in f]) < len(tables.SALES.files(spark, root)[1])


def test_ranked_hits(spark):
    from tallyflow.operators import search

    rows = [("1", "red widget", "d"), ("2", "red red widget", "d"), ("3", "red widget with a very long name", "d"),
            ("4", "widget", "d"), ("5", "red widget", "e"), ("6", None, "d")]
    sales_rows = spark.createDataFrame(rows, "order_detail_id string, sku_name string, dt string")
    got = [r.order_detail_id for r in search.ranked(sales_rows, None, "widget red", 10).collect()]
    assert got == ["2", "1", "5", "3"]
    assert [r.order_detail_id for r in search.ranked(sales_rows, "d", "red", 2).collect()] == ["2", "1"]
    assert search.ranked(sales_rows, None, "absent red", 10).count() == 0
    assert search.ranked(sales_rows, None, "", 10).count() == 0


def test_device_sets_are_exact_and_small(spark, tmp_path):
    from tallyflow.operators import device_sets

    rows = spark.range(200_000).select((F.col("id") % 50_000).cast("string").alias("mid"), F.date_format(
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 7).cast("int")), "yyyy-MM-dd").alias("log_date"))
    rows = rows.unionByName(spark.createDataFrame([(None, "2024-01-01")], "mid string, log_date string")).distinct()
    device_sets.numbered(rows.where("mid < '3'")).write.parquet(str(tmp_path / "a"))
    dictionary = spark.read.parquet(str(tmp_path / "a"))
    device_sets.added(dictionary, rows).write.parquet(str(tmp_path / "b"))
    dictionary = spark.read.parquet(str(tmp_path / "b"))
    assert dictionary.count() == 50_000 == dictionary.select("no").distinct().count()
    sets = device_sets.day_sets(rows, dictionary).cache()
    by_day = {}
    for r in rows.where("mid is not null").collect():
        by_day.setdefault(r.log_date, set()).add(r.mid)
    days = sorted(by_day)
    week = {r.day: r.n for r in device_sets.trailing(sets, 3).collect()}
    assert week == {d: len(set().union(*[by_day[x] for x in days[max(0, k - 2):k + 1]])) for k, d in enumerate(days)}
    back = {r.day: r.n for r in device_sets.returning(sets).collect()}
    assert back == {d: len(by_day[d] & by_day.get(days[k - 1] if k else "", set())) for k, d in enumerate(days)}
    # Bits, not rows: a few bytes for each device and day at most.
    state = sets.agg(F.sum(F.octet_length("bits"))).first()[0]
    assert state < 4 * sum(map(len, by_day.values()))
