"""Column expressions on hand-made values."""

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tallyflow.functions import columns as C
from tallyflow.session import configure


def value(spark, column, **given_values):
    """One expression on one row of literals."""
    configure(spark)
    row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in given_values.items()])
    return row.select(column.alias("x")).first().x


@pytest.mark.parametrize("text, day, hour", [
    ("2020-04-01 06:19:27", "2020-04-01", "06"),
    ("2020-04-01 06", "2020-04-01", "06"),
    ("2020-04-01", None, None), ("", None, None), (None, None, None)])
def test_day_and_hour_of_text(spark, text, day, hour):
    c = F.lit(text).cast("string")
    assert value(spark, C.text_day(c)) == day
    assert value(spark, C.text_hour(c)) == hour


@pytest.mark.parametrize("millis, text", [
    (0, "1970-01-01 00"), (1704067199999, "2023-12-31 23"), (1704067200000, "2024-01-01 00")])
def test_day_hour_of_millis(spark, millis, text):
    assert value(spark, C.day_hour_text(F.lit(millis))) == text


@pytest.mark.parametrize("tel, masked", [
    ("13812345678", "1381*******"), ("123", "123*******"), ("", "*******"), (None, None)])
def test_mask(spark, tel, masked):
    assert value(spark, C.mask_phone(F.lit(tel).cast("string"))) == masked


@pytest.mark.parametrize("birthday, as_of, years", [
    ("2000-01-01", "2000-12-31", 1),   # 2000 is a leap year: 365 days have passed
    ("2001-01-01", "2001-12-31", 0), ("2001-01-01", "2002-01-01", 1),
    ("1990-01-01", "2024-01-01", 34), ("2024-06-01", "2024-01-01", 0),
    ("no date", "2024-01-01", None), (None, "2024-01-01", None)])
def test_age(spark, birthday, as_of, years):
    got = value(spark, C.whole_years(F.lit(birthday).cast("string"), F.lit(as_of).cast("date")))
    assert got == years


@pytest.mark.parametrize("mid, millis, key", [
    ("m", 0, "m_0"), ("m", 59999, "m_0"), ("m", 60000, "m_1"), (None, 60000, "null_1")])
def test_minute_key(spark, mid, millis, key):
    assert value(spark, C.minute_key(F.lit(mid).cast("string"), F.lit(millis))) == key


@pytest.mark.parametrize("part, total, share", [
    (1, 3, 33.3), (2, 3, 66.7), (1, 1000, 0.1), (1, 2000, 0.1), (0, 5, 0.0), (5, 5, 100.0),
    (0, 0, 0.0)])
def test_share(spark, part, total, share):
    assert value(spark, C.percent_share(F.lit(part), F.lit(total))) == share


@pytest.mark.parametrize("keyword, hit", [
    ("red ring", True), ("RING", True), ("ring  red", True), ("red blue", False), ("re", False),
    ("", False), ("  ", False), (None, True)])
def test_terms(spark, keyword, hit):
    assert value(spark, C.has_all_terms(F.lit("Red  gold Ring"), keyword)) is hit


@pytest.mark.parametrize("text, keyword, hit", [
    ("小米手机 高速双频 红色", "小米", True), ("小米手机", "大米", False), ("小米手机", "米小", True),
    ("Red-Widget, large", "widget", True), ("Red-Widget, large", "red large", True),
    ("Größe 42", "größe", True), ("A4-Papier", "a4", True), ("A4-Papier", "...", False)])
def test_words_of_product_names(spark, text, keyword, hit):
    assert value(spark, C.has_all_terms(F.lit(text), keyword)) is hit


def test_terms_of_null(spark):
    assert not value(spark, C.has_all_terms(F.lit(None).cast("string"), "red"))


def test_numbers(spark):
    assert value(spark, C.to_double(F.lit("1.5"))) == 1.5
    assert value(spark, C.to_double(F.lit(""))) is None
    assert value(spark, C.to_long(F.lit("x"))) is None
    assert value(spark, C.to_int(F.lit("20"))) == 20
    assert value(spark, C.or_zero(F.lit(None).cast("int"))) == 0


def test_days(spark):
    assert value(spark, C.previous_day(F.lit("2024-03-01"))) == "2024-02-29"
    assert C.day_before("2024-01-01") == "2023-12-31"
    assert value(spark, C.today(F.lit("2024-01-01 05:00:00").cast("timestamp"))) == "2024-01-01"
    assert len(value(spark, C.today())) == 10


def test_route_key(spark):
    assert value(spark, C.route_key(F.lit("INSERT"), F.lit("order_info"))) == "INSERT->order_info"


@pytest.mark.parametrize("text, out", [
    ('{"a":1}', '{"a":1,"ts":5}'), ('{"ts":1,"a":"x"}', '{"ts":5,"a":"x"}'), ("{}", '{"ts":5}'),
    ('{"a":{"b":[1,2.5]},"n":null}', '{"a":{"b":[1,2.5]},"n":null,"ts":5}'),
    ("not json", None), ("", None), ("[1]", None)])
def test_json_with(spark, text, out):
    assert value(spark, C.json_with(F.lit(text), "ts", F.lit(5))) == out


def test_days_filter_is_a_range_on_the_raw_column(spark):
    df = spark.sql("select timestamp_ntz '2024-01-01 23:59:59.999999' as t union all "
                   "select timestamp_ntz '2024-01-02 00:00:00' union all "
                   "select timestamp_ntz '2024-01-02 23:59:59.999999' union all "
                   "select timestamp_ntz '2024-01-03 00:00:00'")
    assert df.filter(C.on_days(df, "t", "2024-01-02", "2024-01-02")).count() == 2


@settings(max_examples=20, deadline=None)
@given(st.integers(0, 10**6), st.integers(1, 10**6))
def test_share_is_rounded_half_up(spark, part, total):
    expected = int(part * 1000.0 / total + 0.5) / 10
    assert value(spark, C.percent_share(F.lit(part), F.lit(total))) == expected


def test_costly_column_is_computed_once(spark):
    df = spark.createDataFrame([('{"a":"1"}',)], "v string")
    parsed = C.with_computed(df, "r", F.from_json("v", "a string")).filter("r.a = '1'")
    plan = parsed._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1 and parsed.count() == 1
