"""Joins that several collectors read are made once, and the records of large tables are not moved."""

import pytest
from pyspark.sql import functions as F

from tidewatch.catalog import base, collectors


@pytest.fixture
def tables(spark, tmp_path):
    n = F.col("id")
    rows = spark.range(60)
    day = F.lit("1996-03-05").cast("timestamp_ntz")
    made = {
        "lineitem": rows.select(
            n.alias("l_orderkey"), (n % 7).alias("l_partkey"), (n % 5).alias("l_suppkey"), (n % 7 + 1).cast("int").alias("l_linenumber"),
            (n % 9).cast("double").alias("l_quantity"), (n * 1.5).cast("double").alias("l_extendedprice"),
            F.lit("R").alias("l_returnflag"), F.lit("F").alias("l_linestatus"), day.alias("l_shipdate")),
        "part": spark.range(6).select(
            n.alias("p_partkey"), F.concat(F.lit("part "), n.cast("string")).alias("p_name"), F.lit("Brand#1").alias("p_brand"),
            F.lit("PROMO").alias("p_type"), n.cast("int").alias("p_size")),
        "orders": rows.select(
            n.alias("o_orderkey"), (n % 8).alias("o_custkey"), F.lit("F").alias("o_orderstatus"),
            day.alias("o_orderdate"), F.lit("1-URGENT").alias("o_orderpriority")),
        "customer": spark.range(7).select(
            n.alias("c_custkey"), n.cast("string").alias("c_name"), n.cast("int").alias("c_nationkey"), F.lit("AUTO").alias("c_mktsegment")),
        "supplier": spark.range(3).select(n.alias("s_suppkey"), n.cast("int").alias("s_nationkey")),
        "events": rows.select(
            n.alias("event_id"), day.alias("ts"), (n % 4).alias("user_id"), F.lit("click").alias("event_type"),
            n.cast("double").alias("value"), F.lit("{}").alias("props")),
    }
    for name, table in made.items():
        table.coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_joins_are_made_once(spark, tables):
    found, apart = collectors.all_frames(spark, tables, once=True), collectors.all_frames(spark, tables)
    assert "Join" in plan_of(apart["crafts"]) and "Join" in plan_of(apart["groups"])
    for name in ("crafts", "groups"):
        assert "Join" not in plan_of(found[name])
        assert sorted(map(str, found[name].collect())) == sorted(map(str, apart[name].collect()))


def test_records_of_large_tables_are_not_moved(spark, tables, monkeypatch):
    small = base.spread(base.frame(spark, tables, "SELECT event_id AS arrival_seq FROM $events"), 1 << 30)
    assert "RepartitionByExpression" in plan_of(small)
    monkeypatch.setattr(collectors, "LARGE_BYTES", 0)
    for rows in collectors.all_frames(spark, tables).values():
        assert "RepartitionByExpression" not in plan_of(rows)
