"""Derived inputs hold every row of the tables that they are made from."""

import datetime

import pytest
from pyspark.sql import functions as F

from forgelight.plans import inputs, registry


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("sf"))
    events = [(i, i % 7, "view", datetime.datetime(2024, 1, 1 + i % 20)) for i in range(300)]
    spark.createDataFrame(events, "event_id long, user_id long, event_type string, ts timestamp").write.parquet(f"{d}/events.parquet")
    lines = [(i, i // 3, i % 11, datetime.date(2024, 1, 1 + i % 20)) for i in range(300)]
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_suppkey long, l_shipdate date").write.parquet(f"{d}/lineitem.parquet")
    return d


@pytest.mark.parametrize("sql", [inputs.ADOPTION, inputs.ENTRIES, inputs.IGNORE_LINES, registry.PATHS], ids=["adoption", "entries", "ignore lines", "paths"])
def test_one_row_for_each_row_of_the_table(spark, folder, sql):
    assert inputs.derive(spark, folder, sql).count() == 300


def test_distinct_inputs_leave_no_event_out(spark, folder):
    events = spark.read.parquet(f"{folder}/events.parquet")
    kinds = events.select("user_id", (F.col("event_id") % 5), (F.col("event_id") % 4)).distinct().count()
    assert inputs.derive(spark, folder, inputs.EVIDENCE).count() == kinds
    kinds = events.select("user_id", F.col("event_id") % 22 == 0, F.col("event_id") % 4).distinct().count()
    assert inputs.derive(spark, folder, registry.FIRST).count() == kinds


@pytest.mark.parametrize(("sql", "keys"), [(registry.GAUGE_ROWS, 1200), (registry.REQUESTS, 2400)], ids=["suppliers", "customers"])
def test_responses_do_not_grow_with_the_table(spark, tmp_path, sql, keys):
    spark.range(1, keys + 1).selectExpr("id as s_suppkey", "id % 25 as s_nationkey").write.parquet(f"{tmp_path}/supplier.parquet")
    spark.range(1, keys + 1).selectExpr("id as c_custkey").write.parquet(f"{tmp_path}/customer.parquet")
    sizes = [r["count"] for r in inputs.derive(spark, str(tmp_path), sql).groupBy("batch").count().collect()]
    assert max(sizes) <= 50 and sum(sizes) == keys
