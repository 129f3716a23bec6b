"""Loads whose cost has to follow the input: copies without a sort, few orders, joins of keys before texts, sums of many lines."""

import re

from pyspark.sql import DataFrameWriter, functions as F

from conftest import SMALL
from fixtures import bronze, plan, rows
from starloom import catalogue
from starloom.plans import lakehouse
from starloom.plans.lakehouse import Lakehouse
from starloom.schemas import DIMENSIONS, FACT
from starloom.sources import order_lines


def house(spark, folder, name):
    return Lakehouse(spark, f"{folder}/{name}", f"silver_large_{name}", f"gold_large_{name}", dates_per_part=2)


def test_staged_rows_are_copied_without_a_sort(spark, folder, monkeypatch):
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before, used, insert = spark.conf.get(name), [], DataFrameWriter.insertInto

    def spy(writer, *args, **options):
        used.append(int(spark.conf.get(name)))
        return insert(writer, *args, **options)

    monkeypatch.setattr(DataFrameWriter, "insertInto", spy)
    lake = house(spark, folder, "copy")
    lake.write_silver(bronze(spark, *[{"Date_ID": f"DT{i}"} for i in range(40)]))
    assert used and min(used) > 64 and spark.conf.get(name) == before
    assert lake.silver().count() == 40


def test_lines_of_few_orders_are_found_without_a_shuffle(spark):
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    try:
        spark.conf.set(name, "8000")
        text = plan(order_lines.bronze_batch(spark, SMALL, 0))
    finally:
        spark.conf.set(name, before)
    assert re.search(r"BroadcastHashJoin \[l_orderkey#", text)


def test_keys_of_large_dimensions_join_before_texts(spark):
    dims = {s.name: spark.createDataFrame([], s.schema) for s in DIMENSIONS}
    found = catalogue._with_members(spark.createDataFrame([], FACT), dims)
    joins = re.findall(r"Join LeftOuter, \((\w+)#", found._jdf.queryExecution().analyzed().toString())
    assert joins == ["dim_date_key", "dim_branch_key", "dim_dealer_key", "dim_model_key"]
    want = spark.createDataFrame([], FACT)
    for spec in DIMENSIONS:
        want = want.join(dims[spec.name], spec.key, "left")
    assert found.columns == want.columns


def test_many_lines_are_summed_without_a_search(spark, folder, monkeypatch):
    batches = {
        "0": [{}, {"Date_ID": "DT2", "Revenue": 3}, {"Branch_ID": None, "Revenue": 1}, {"Date_ID": "DT9", "Revenue": 8}],
        "1": [{"Revenue": 7}, {"Branch_ID": None, "Revenue": None}, {"Date_ID": None, "Revenue": 4}, {"Dealer_ID": "d"}],
        "2": [{"Date_ID": None, "Revenue": 5}, {"Date_ID": "DT9", "Dealer_ID": "d", "Units_Sold": 0}],
    }
    again = {"1": [{"Revenue": 40}, {"Date_ID": "DT9"}], "0": [{"Date_ID": "DT2", "Dealer_ID": "e"}]}

    def facts(name):
        lake = house(spark, folder, name)
        for batch, lines in [*batches.items(), *again.items()]:
            lake.load_batch(bronze(spark, *lines), batch, "aggregate")
        fact = lake.fact.read()
        for spec in DIMENSIONS:
            fact = fact.join(lake.dims[spec.name].read().select(spec.key, spec.id), spec.key, "left")
        return rows(fact, *[s.id for s in DIMENSIONS], "Revenue", "Units_Sold", "revenuePerUnit")

    searched = facts("search")
    monkeypatch.setattr(lakehouse, "SEARCHED_LINES", 0)
    monkeypatch.setattr(Lakehouse, "lines_of", None)
    assert facts("sums") == searched
    whole = house(spark, folder, "whole")
    whole.reload(bronze(spark, *batches["2"], *again["1"], *again["0"]), "aggregate")
    assert sum(r[-3] for r in searched) == whole.fact.read().agg(F.sum("Revenue")).first()[0]
    assert len(searched) == whole.fact.read().count()
