"""Every named query against its comparison SQL, and the shape of its plan."""

import pytest

import __spark_entry__ as entry
from compare import connect, differences
from conftest import SMALL
from tallyflow.plans.oracle import ORACLE as SQL
from tallyflow.plans.registry import QUERIES


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


def test_every_query_has_sql():
    assert set(SQL) == set(QUERIES)
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_as_sql(spark, duck, name):
    assert differences(spark, duck, name, QUERIES[name], SQL[name], SMALL) == []


def test_entry(spark):
    assert entry.entry(spark).count() == 24


def plan(spark, name):
    spark.conf.set("spark.sql.maxMetadataStringLength", 10000)
    return QUERIES[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name, pushed", [
    ("dau_hour", "GreaterThanOrEqual(ts,2024-01-09T00:00)"),
    ("realtime_hour_dau", "GreaterThanOrEqual(ts,2024-01-08T00:00)"),
    ("realtime_hour_amount", "EqualTo(event_type,purchase)"),
    ("order_day_amount", "GreaterThanOrEqual(o_orderdate,1998-10-03T00:00)"),
    ("sale_detail_day", "GreaterThanOrEqual(o_orderdate,1998-10-03T00:00)"),
])
def test_filters_reach_the_scan(spark, name, pushed):
    assert pushed in plan(spark, name)


@pytest.mark.parametrize("name, columns", [
    ("dau_hour", "struct<ts:timestamp_ntz,user_id:bigint>"),
    ("sale_total", "struct<l_orderkey:bigint,l_partkey:bigint,l_linenumber:int>"),
])
def test_scan_reads_only_what_is_needed(spark, name, columns):
    assert f"ReadSchema: {columns}" in plan(spark, name)


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if not n.startswith("stream")))
def test_no_cross_join_and_no_python(spark, name):
    text = plan(spark, name)
    assert "CartesianProduct" not in text and "NestedLoop" not in text
    assert "Python" not in text and "Pandas" not in text
