"""Sale lines in bronze layout, derived from an order/line-item schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from starloom.functions import padded
from starloom.schemas import BRONZE
from starloom.session import new_folder
from starloom.sources.files import read_parquet

# First order day of batch 1 and of batch 2; batch 0 lies before, batch 2 is open-ended.
BATCH_STARTS = ("1995-01-15", "1995-02-01")

# Columns and types of the given tables. Declaring them saves the
# job that would read file footers before each query.
SCHEMAS = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")


def _day(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def _buyers(spark: SparkSession, folder: str, orders: DataFrame) -> DataFrame:
    """Day and nation of each order."""
    return orders.join(table(spark, folder, "customer"), F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey", "o_orderdate", "c_nationkey"
    )


def _sized(rows: DataFrame) -> DataFrame:
    """``rows`` written down: the planner, which takes a join for as large as a product, then knows their size."""
    path = new_folder(rows.sparkSession, "sized")
    rows.write.parquet(path)
    return read_parquet(rows.sparkSession, path, rows.schema)


def _sale_lines(spark: SparkSession, folder: str, buyers: DataFrame) -> DataFrame:
    """Line items with their order, product, dealer and branch.

    The tables that may need a shuffle come first, while the lines are numbers only; names and types
    join last, as texts would go through every later shuffle.
    """
    return (
        table(spark, folder, "lineitem")
        .join(buyers, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(table(spark, folder, "part"), F.col("l_partkey") == F.col("p_partkey"))
        .join(table(spark, folder, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(table(spark, folder, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    )


def _bronze_columns(dealer_name: Column) -> list[Column]:
    date = F.col("o_orderdate")
    day_digits = F.year(date) * 10000 + F.month(date) * 100 + F.dayofmonth(date)
    return [
        F.concat(F.lit("BR"), padded(F.col("c_nationkey"), 4)).alias("Branch_ID"),
        F.concat(F.lit("DLR"), padded(F.col("l_suppkey"), 6)).alias("Dealer_ID"),
        F.concat(F.col("p_type"), F.lit("-M"), F.col("p_partkey").cast("string")).alias("Model_ID"),
        F.round(F.col("l_extendedprice") * 100).cast("bigint").alias("Revenue"),
        F.col("l_quantity").cast("bigint").alias("Units_Sold"),
        F.concat(F.lit("DT"), day_digits.cast("string")).alias("Date_ID"),
        F.dayofmonth(date).alias("Day"),
        F.month(date).alias("Month"),
        F.year(date).alias("Year"),
        F.col("n_name").alias("BranchName"),
        dealer_name.alias("DealerName"),
        F.col("p_name").alias("Product_Name"),
    ]


def bronze_sales(spark: SparkSession, folder: str) -> DataFrame:
    """Every line item as one bronze sale line."""
    buyers = _buyers(spark, folder, table(spark, folder, "orders"))
    return _sale_lines(spark, folder, buyers).select(_bronze_columns(F.col("s_name")))


def bronze_batch(spark: SparkSession, folder: str, first: int, last: int | None = None) -> DataFrame:
    """The sale lines of batches ``first`` to ``last`` (by default only ``first``).

    The bounds become date filters on the orders scan. Orders up to a day may be few: then the line items need
    no shuffle to meet them. From batch 1 on, some
    dealers carry a name that tells the batch, so that attributes change.
    """
    last = first if last is None else last
    orders = table(spark, folder, "orders")
    date = F.col("o_orderdate")
    if first > 0:
        orders = orders.where(date >= _day(BATCH_STARTS[first - 1]))
    before = F.lit(True)
    if last < len(BATCH_STARTS):
        before = date < _day(BATCH_STARTS[last])
    buyers = _buyers(spark, folder, orders.where(before))
    if last < len(BATCH_STARTS):
        buyers = _sized(buyers).where(before)
    batch = F.when(date < _day(BATCH_STARTS[0]), 0).when(date < _day(BATCH_STARTS[1]), 1).otherwise(2)
    renamed = (batch > 0) & (F.col("l_suppkey") % 7 == 0)
    name = F.when(renamed, F.concat(F.col("s_name"), F.lit(" r"), batch.cast("string"))).otherwise(F.col("s_name"))
    return _sale_lines(spark, folder, buyers).select(_bronze_columns(name))


def coarse_batch(spark: SparkSession, folder: str, batch: int, batches: int) -> DataFrame:
    """Every ``batches``-th line of each order, with product types as models and months as dates.

    Combinations of ids then repeat, within a batch and among batches.
    """
    buyers = _buyers(spark, folder, table(spark, folder, "orders"))
    lines = _sale_lines(spark, folder, buyers).where(F.col("l_linenumber") % batches == batch)
    month = F.concat(F.lit("DT"), F.date_format("o_orderdate", "yyyyMM"))
    changed = {"Model_ID": F.concat(F.col("p_type"), F.lit("-M")), "Date_ID": month, "Day": F.lit(1)}
    columns = _bronze_columns(F.col("s_name"))
    return lines.select([changed[n].alias(n) if n in changed else c for n, c in zip(BRONZE.fieldNames(), columns, strict=True)])
