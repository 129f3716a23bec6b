"""Shuffles that follow the input: narrow joins, increments of dates of their own, partitions by the size of the files."""

import re

from conftest import SMALL
from fixtures import bronze
from starloom.operators.lookup import frequent_ids
from starloom.plans.lakehouse import Lakehouse
from starloom.sources import order_lines, tables


def test_texts_of_sale_lines_join_after_the_large_tables(spark):
    plan = order_lines.bronze_sales(spark, SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert re.findall(r"Join Inner, \((\w+)#", plan) == ["c_nationkey", "l_suppkey", "l_partkey", "l_orderkey", "o_custkey"]


def test_a_batch_of_dates_of_its_own_joins_no_older_lines(spark, folder, monkeypatch):
    lake = Lakehouse(spark, folder, "silver_growth", "gold_growth", dates_per_part=2)
    lake.load_batch(bronze(spark, {"Date_ID": "DT1"}, {"Date_ID": "DT2"}), "0", "aggregate")
    found = []
    whole = Lakehouse.lines_of
    monkeypatch.setattr(Lakehouse, "lines_of", lambda self, *a: found.append(1) or whole(self, *a))
    lake.load_batch(bronze(spark, {"Date_ID": "DT3", "Revenue": 1}), "1", "aggregate")
    assert not found
    lake.load_batch(bronze(spark, {"Date_ID": "DT1", "Revenue": 5}, {"Date_ID": None, "Revenue": 7}), "2", "aggregate")
    assert found
    sums = {r["Date_ID"]: r["r"] for r in lake.silver().groupBy("Date_ID").agg({"Revenue": "sum"}).withColumnRenamed("sum(Revenue)", "r").collect()}
    keys = {r["date_id"]: r["dim_date_key"] for r in lake.dims["date"].read().collect()}
    fact = {r["dim_date_key"]: r["Revenue"] for r in lake.fact.read().collect()}
    assert fact == {keys.get(d): r for d, r in sums.items()}
    # A line that is gone takes its row along, one that an older batch has too leaves that.
    lake.load_batch(bronze(spark, {"Date_ID": "DT3", "Revenue": 2}), "2", "aggregate")
    fact = {r["dim_date_key"]: r["Revenue"] for r in lake.fact.read().collect()}
    older = {r["Date_ID"]: r["Revenue"] for r in lake.silver("0").collect()}
    assert fact == {keys["DT1"]: older["DT1"], keys["DT2"]: older["DT2"], keys["DT3"]: 3}


def test_only_ids_of_large_groups_are_counted(spark):
    ids = spark.range(4000).selectExpr("if(id % 4 = 0, 'hot', if(id % 4 = 1, null, cast(id as string))) AS i")
    assert [tuple(r) for r in frequent_ids(ids, "i", 16).collect()] == [("hot", 4)]
    assert frequent_ids(ids.where("i <> 'hot'"), "i", 16).count() == 0
    assert frequent_ids(ids.where("false"), "i", 16).count() == 0


def test_partitions_follow_the_files(spark, folder, monkeypatch):
    spark.range(10_000).write.parquet(f"{folder}/rows")
    rows = spark.read.schema("id bigint").parquet(f"{folder}/rows")
    assert tables.partitions_for(rows) == 8
    monkeypatch.setattr(tables, "TASK_BYTES", 1000)
    assert tables.partitions_for(rows) > 40
    tables.write_spread(rows.groupBy("id").count(), f"{folder}/counts")
    assert spark.read.parquet(f"{folder}/counts").count() == 10_000
    assert spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None) is None
