"""Every operator as a query over the given tables: ``(spark, folder) -> DataFrame``.

Queries that need written tables put them into a new folder of their own.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from starloom.functions import day_number, model_category, revenue_per_unit
from starloom.operators.changes import DELETE, INSERT, UPDATE, cdc_apply, extract_diff, live_rows
from starloom.operators.keys import highest_key
from starloom.operators.members import latest_members
from starloom.operators.upsert import duplicate_keys, upsert_columns
from starloom.plans import marts
from starloom.plans.dimension import look_up_members, members_of
from starloom.plans.fact import build_fact, to_grain
from starloom.plans.lakehouse import Lakehouse
from starloom.plans.silver import to_silver
from starloom.schemas import BRANCH, BRONZE, DATE, DEALER, DIMENSIONS, FACT_KEYS, MODEL, DimSpec
from starloom.session import new_folder
from starloom.sources import order_lines
from starloom.sources.drift import reconcile
from starloom.sources.files import high_water_mark, on_files, read_csv, read_parquet, rows_after
from starloom.sources.tables import spread
from starloom.streaming import close_windows, load_new_files

Query = Callable[[SparkSession, str], DataFrame]

LAST_BATCH = len(order_lines.BATCH_STARTS)
BATCHES = range(LAST_BATCH + 1)

# Events up to this time count as loaded before.
LOADED_UNTIL = "2024-01-15"
# Sales before this year form the target of the partial merge, later ones its source.
MERGE_YEAR = 1998
# Buckets of the fact that is merged without a shuffle of its rows.
FACT_BUCKETS = 8
# Parts into which the lines of the same ids are split.
SPLIT_BATCHES = 3
# Most files that land at once: each becomes a folder in every bucket of silver, and few of them a micro-batch,
# so more of them for larger tables would make more micro-batches that each compute the same grains again.
LANDED_FILES = 12
# Columns that no bronze file may lack.
FACT_IDS = [spec.source_id for spec in DIMENSIONS]
# First and last date id of the report on some dates.
DATE_RANGE = ("DT19980101", "DT19980331")


def _lakehouse(spark: SparkSession, label: str, **settings) -> Lakehouse:
    """An empty lakehouse in a folder, and with schema names, that no other run uses."""
    root = new_folder(spark, label)
    suffix = root.rsplit("-", 1)[1]
    return Lakehouse(spark, root, f"silver_{suffix}", f"gold_{suffix}", **settings)


def _silver(spark: SparkSession, folder: str) -> DataFrame:
    return to_silver(order_lines.bronze_sales(spark, folder))


def _silver_batch(spark: SparkSession, folder: str, first: int, last: int | None = None) -> DataFrame:
    return to_silver(order_lines.bronze_batch(spark, folder, first, last))


# -- sources and silver -------------------------------------------------------


def bronze_sales(spark: SparkSession, folder: str) -> DataFrame:
    path = new_folder(spark, "bronze")
    order_lines.bronze_sales(spark, folder).write.parquet(path)
    return read_parquet(spark, path, BRONZE)


def silver_sales(spark: SparkSession, folder: str) -> DataFrame:
    return _lakehouse(spark, "silver-sales").write_silver(order_lines.bronze_sales(spark, folder))


def model_categories(spark: SparkSession, folder: str) -> DataFrame:
    bronze = order_lines.bronze_sales(spark, folder)
    return bronze.select("Model_ID", model_category(F.col("Model_ID")).alias("Model_Category")).distinct()


def revenue_per_unit_with_zeros(spark: SparkSession, folder: str) -> DataFrame:
    lines = order_lines.table(spark, folder, "lineitem")
    units = F.col("l_quantity").cast("bigint")
    return lines.select(
        "l_orderkey",
        "l_partkey",
        "l_suppkey",
        F.round(F.col("l_extendedprice") * 100).cast("bigint").alias("Revenue"),
        (units - units % 10).alias("Units_Sold"),
    ).withColumn("revenuePerUnit", revenue_per_unit(F.col("Revenue"), F.col("Units_Sold")))


def sql_on_files(spark: SparkSession, folder: str) -> DataFrame:
    lakehouse = _lakehouse(spark, "sql-on-files")
    lakehouse.write_silver(order_lines.bronze_sales(spark, folder))
    return spark.sql(f"SELECT DISTINCT Year, Model_Category FROM {on_files(lakehouse.silver_path)}")


def units_by_year_branch(spark: SparkSession, folder: str) -> DataFrame:
    return marts.units_by_year_branch(_silver(spark, folder))


def csv_incremental(spark: SparkSession, folder: str) -> DataFrame:
    """Bronze as CSV files and back; product names get commas and quotes to be escaped."""
    path = new_folder(spark, "csv")
    product = F.concat("Product_Name", F.lit(', "'), "BranchName", F.lit('"'))
    bronze = order_lines.bronze_sales(spark, folder).withColumn("Product_Name", product)
    bronze.write.option("header", True).option("escape", '"').csv(path)
    return read_csv(spark, path, BRONZE)


def bronze_drift(spark: SparkSession, folder: str) -> DataFrame:
    """Three generations of bronze files: without the product and with small numbers; whole; with a further column, and some refused."""
    path = new_folder(spark, "bronze-drift")
    old, whole, new = (order_lines.bronze_batch(spark, folder, batch) for batch in BATCHES)
    old.drop("Product_Name").withColumn("Units_Sold", F.col("Units_Sold").cast("smallint")).write.parquet(f"{path}/0")
    whole.write.parquet(f"{path}/1")
    discounted = new.withColumn("Discount", F.lit(0.5))
    even = F.col("Units_Sold") % 2 == 0
    discounted.where(even).withColumn("Units_Sold", F.col("Units_Sold").cast("int")).write.parquet(f"{path}/2")
    discounted.where(~even).withColumn("Units_Sold", F.lit("odd")).write.parquet(f"{path}/3")
    return reconcile(spark, path, expected=BRONZE, required=FACT_IDS, recursive=True, most_refused=10_000).read(spark)


# -- dimensions ---------------------------------------------------------------


def dim_initial(spec: DimSpec, spark: SparkSession, folder: str) -> DataFrame:
    lakehouse = _lakehouse(spark, f"{spec.table}-initial")
    lakehouse.refresh_dimension(spec, _silver(spark, folder))
    return lakehouse.dims[spec.name].read()


def dim_lookup(spec: DimSpec, spark: SparkSession, folder: str) -> DataFrame:
    """Members of all later batches against the dimension of batch 0."""
    lakehouse = _lakehouse(spark, f"{spec.table}-lookup")
    lakehouse.refresh_dimension(spec, _silver_batch(spark, folder, 0))
    members = members_of(spec, _silver_batch(spark, folder, 1, LAST_BATCH))
    looked_up = look_up_members(spec, members, lakehouse.dims[spec.name].read())
    return looked_up.select(*spec.columns, F.col(spec.key).isNull().alias("is_new"))


def dim_scd1(spec: DimSpec, spark: SparkSession, folder: str) -> DataFrame:
    """The dimension after three batches."""
    lakehouse = _lakehouse(spark, f"{spec.table}-scd1")
    for batch in BATCHES:
        lakehouse.refresh_dimension(spec, _silver_batch(spark, folder, batch))
    return lakehouse.dims[spec.name].read()


def dim_attr_conflict(spark: SparkSession, folder: str) -> DataFrame:
    """Products as members with the dealer as attribute: many values per id, the last one stays."""
    sold_on = day_number(F.col("Year"), F.col("Month"), F.col("Day"))
    return latest_members(_silver(spark, folder), "Product_Name", ["DealerName"], sold_on)


def surrogate_key_append(spark: SparkSession, folder: str) -> DataFrame:
    """Which keys each batch appended to each dimension."""
    lakehouse = _lakehouse(spark, "key-append")
    reports = []
    for batch in BATCHES:
        before = {}
        for name, dim in lakehouse.dimensions().items():
            # The refresh replaces the files of the table.
            path = new_folder(spark, "before")
            dim.write.parquet(path)
            before[name] = read_parquet(spark, path, dim.schema)
        lakehouse.refresh_dimensions(lakehouse.write_silver(order_lines.bronze_batch(spark, folder, batch), str(batch)))
        after = lakehouse.dimensions()
        lines = []
        for spec in DIMENSIONS:
            highest = highest_key(before[spec.name], spec.key)
            appended = F.when(F.col(spec.key) > highest, F.col(spec.key))
            lines.append(
                after[spec.name].agg(
                    F.lit(spec.name).alias("dim"),
                    F.lit(batch).alias("batch"),
                    F.max(highest).alias("max_before"),
                    F.min(appended).alias("min_new"),
                    F.max(appended).alias("max_new"),
                    F.count(appended).alias("n_new"),
                )
            )
        report, path = reduce(DataFrame.unionByName, lines), new_folder(spark, "report")
        report.write.parquet(path)
        reports.append(read_parquet(spark, path, report.schema))
    return reduce(DataFrame.unionByName, reports)


# -- fact ---------------------------------------------------------------------


def _with_members(rows: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """Fact rows with the columns of ``dims``. Those that may need a shuffle join first, while the rows are numbers only."""
    columns = rows.columns
    for spec in DIMENSIONS:
        columns = [spec.key, *[c for c in columns if c != spec.key], *[c for c in dims[spec.name].columns if c != spec.key]]
    for spec in (MODEL, DEALER, BRANCH, DATE):
        rows = rows.join(dims[spec.name], spec.key, "left")
    return rows.select(columns)


def fact_sales(spark: SparkSession, folder: str) -> DataFrame:
    lakehouse = _lakehouse(spark, "fact-sales")
    silver = lakehouse.write_silver(order_lines.bronze_sales(spark, folder))
    lakehouse.refresh_dimensions(silver)
    return build_fact(silver, lakehouse.dimensions())


def fact_late_members(spark: SparkSession, folder: str) -> DataFrame:
    """All lines against the dimensions of batch 0: members that come later leave NULL keys."""
    lakehouse = _lakehouse(spark, "fact-late")
    lakehouse.refresh_dimensions(lakehouse.write_silver(order_lines.bronze_batch(spark, folder, 0), "0"))
    silver = lakehouse.write_silver(order_lines.bronze_sales(spark, folder))
    return build_fact(silver, lakehouse.dimensions())


def fact_inferred_members(spark: SparkSession, folder: str) -> DataFrame:
    """All lines over the dimensions of batch 0: later members get keys with the fact, and their attributes afterwards."""
    lakehouse = _lakehouse(spark, "fact-inferred")
    lakehouse.refresh_dimensions(lakehouse.write_silver(order_lines.bronze_batch(spark, folder, 0), "0"))
    silver = lakehouse.write_silver(order_lines.bronze_sales(spark, folder))
    lakehouse.load_fact(silver, on_duplicate="keep", infer=True)
    lakehouse.refresh_dimensions(silver)
    return _with_members(lakehouse.fact.read(), lakehouse.dimensions())


def fact_grain(spark: SparkSession, folder: str) -> DataFrame:
    return to_grain(fact_sales(spark, folder))


def fact_merge(spark: SparkSession, folder: str, **settings) -> DataFrame:
    """Batches 0 and 1 as the fact; batch 1 corrected by one unit a line, and batch 2, merged into it."""
    lakehouse = _lakehouse(spark, "fact-merge", **settings)
    batches = [
        lakehouse.write_silver(order_lines.bronze_batch(spark, folder, batch), str(batch)) for batch in BATCHES
    ]
    lakehouse.refresh_dimensions(lakehouse.silver())
    lakehouse.load_fact(batches[0].unionByName(batches[1]), on_duplicate="aggregate")
    corrected = batches[1].withColumn("Units_Sold", F.col("Units_Sold") + 1)
    lakehouse.load_fact(corrected.unionByName(batches[2]), on_duplicate="aggregate")
    return lakehouse.fact.read()


def merge_partial_columns(spark: SparkSession, folder: str) -> DataFrame:
    """Sales per dealer and model: later years set the revenue of known pairs and add the other pairs whole."""
    silver = _silver(spark, folder)

    def totals(rows: DataFrame) -> DataFrame:
        return rows.groupBy("Dealer_ID", "Model_ID").agg(
            F.sum("Revenue").alias("Revenue"), F.sum("Units_Sold").alias("Units_Sold")
        )

    target, source = totals(silver.where(F.col("Year") < MERGE_YEAR)), totals(silver.where(F.col("Year") >= MERGE_YEAR))
    return upsert_columns(target, source, ["Dealer_ID", "Model_ID"], update=["Revenue"])


def merge_multi_match_check(spark: SparkSession, folder: str) -> DataFrame:
    return duplicate_keys(order_lines.table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])


# -- reports, increments, whole runs ------------------------------------------


def rollup_groups() -> dict[str, tuple[DimSpec, Column]]:
    """Year and model category; the date ids of the order lines hold the year in digits 3 to 6."""
    return {
        "Year": (DATE, F.substring(F.col(DATE.id), 3, 4).cast("int")),
        "Model_Category": (MODEL, F.col("model_category")),
    }


def star_rollup(spark: SparkSession, folder: str) -> DataFrame:
    """Load everything, then sum over the star schema."""
    lakehouse = _lakehouse(spark, "star-rollup")
    lakehouse.reload(order_lines.bronze_sales(spark, folder), on_duplicate="keep")
    dims = lakehouse.dimensions()
    return marts.star_rollup(lakehouse.fact.read(), {spec: dims[spec.name] for spec in DIMENSIONS}, rollup_groups())


def rollup_maintained(spark: SparkSession, folder: str) -> DataFrame:
    """Three batches and one of them again; the roll-up reads sums by date and model that were kept up to date with the fact."""
    lakehouse = _lakehouse(spark, "rollup-maintained", totals={"sales_by_date_model": [DATE.key, MODEL.key]})
    for batch in (*BATCHES, 1):
        lakehouse.load_batch(order_lines.bronze_batch(spark, folder, batch), str(batch), on_duplicate="aggregate")
    dims = lakehouse.dimensions()
    totals = lakehouse.totals["sales_by_date_model"].read()
    return marts.star_rollup(totals, {spec: dims[spec.name] for spec in DIMENSIONS}, rollup_groups())


def incremental_hwm(spark: SparkSession, folder: str) -> DataFrame:
    events = order_lines.table(spark, folder, "events")
    loaded = events.where(F.col("ts") <= F.lit(LOADED_UNTIL).cast("timestamp_ntz"))
    return rows_after(events, "ts", high_water_mark(loaded, "ts"))


def cdc_changes(spark: SparkSession, folder: str) -> DataFrame:
    """The last event of each user, where an error deletes the user; the later events come first, and once more at the end."""
    events = order_lines.table(spark, folder, "events")
    kind = F.when(F.col("event_type") == "error", DELETE).when(F.col("event_type") == "signup", INSERT).otherwise(UPDATE)
    log = events.select("user_id", "event_type", "value", "event_id", kind.alias("op"))
    late = F.col("ts") <= F.lit(LOADED_UNTIL).cast("timestamp_ntz")
    state = log.where("false")
    for batch in (log.where(~late), log.where(late), log.where(~late)):
        path = new_folder(spark, "cdc-state")
        cdc_apply(state, batch, ["user_id"], "event_id", "op").write.parquet(path)
        state = read_parquet(spark, path, log.schema)
    return live_rows(state, "op")


def extract_changes(spark: SparkSession, folder: str) -> DataFrame:
    """From the orders that are not pending to those that are not finished, urgent ones at a higher price."""
    orders = order_lines.table(spark, folder, "orders").drop("o_orderdate")
    price = F.when(F.col("o_orderpriority") == "1-URGENT", F.col("o_totalprice") * 2).otherwise(F.col("o_totalprice"))
    after = orders.where("o_orderstatus <> 'F'").withColumn("o_totalprice", price)
    return extract_diff(orders.where("o_orderstatus <> 'P'"), after, ["o_orderkey"])


def _by_natural_ids(lakehouse: Lakehouse) -> DataFrame:
    """The fact from the catalog, with natural ids in place of keys."""
    rows = lakehouse.spark.table(f"{lakehouse.gold_schema}.fact_sales")
    rows = _with_members(rows, {spec.name: lakehouse.dims[spec.name].read().select(spec.key, spec.id) for spec in DIMENSIONS})
    return rows.select(*[spec.id for spec in DIMENSIONS], "Revenue", "Units_Sold")


def fact_split_batches(spark: SparkSession, folder: str) -> DataFrame:
    """Lines of the same ids in three batches: the fact sums all of them."""
    lakehouse = _lakehouse(spark, "split")
    for batch in range(SPLIT_BATCHES):
        bronze = order_lines.coarse_batch(spark, folder, batch, SPLIT_BATCHES)
        lakehouse.load_batch(bronze, str(batch), on_duplicate="aggregate")
    return _by_natural_ids(lakehouse)


def csv_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The same lines land as CSV files, and a stream takes a few files at a time."""
    lakehouse = _lakehouse(spark, "csv-stream")
    landing = f"{lakehouse.root}/landing"
    for batch in range(SPLIT_BATCHES):
        bronze = order_lines.coarse_batch(spark, folder, batch, SPLIT_BATCHES)
        bronze.coalesce(LANDED_FILES).write.option("header", True).option("escape", '"').csv(f"{landing}/{batch}")
    load_new_files(lakehouse, landing, f"{lakehouse.root}/checkpoint", "aggregate", files_per_batch=8, file_format="csv")
    return _by_natural_ids(lakehouse)


def csv_quarantine(spark: SparkSession, folder: str) -> DataFrame:
    """Lines of 50 units land, in compressed files, with a word for the number: they go into quarantine, all others are loaded."""
    lakehouse = _lakehouse(spark, "csv-quarantine")
    landing, refused = f"{lakehouse.root}/landing", f"{lakehouse.root}/refused"
    units = F.when(F.col("Units_Sold") == 50, "many").otherwise(F.col("Units_Sold").cast("string"))
    bronze = order_lines.bronze_sales(spark, folder).withColumn("Units_Sold", units)
    with spread(bronze):
        bronze.coalesce(LANDED_FILES).write.option("header", True).option("escape", '"').option("compression", "gzip").csv(landing)
    load_new_files(
        lakehouse, landing, f"{lakehouse.root}/checkpoint", "keep", file_format="csv", quarantine=refused, most_refused=0.1
    )
    kept_aside = spark.read.parquet(refused).groupBy("reason").agg(F.count(F.lit(1)).alias("lines"))
    return kept_aside.unionByName(lakehouse.silver().agg(F.lit("loaded").alias("reason"), F.count(F.lit(1)).alias("lines")))


def fact_by_date_range(spark: SparkSession, folder: str) -> DataFrame:
    """Sums per date over some months, from the partitions of the catalog's fact table that hold them."""
    lakehouse = _lakehouse(spark, "date-range")
    lakehouse.reload(order_lines.bronze_sales(spark, folder), on_duplicate="keep")
    fact = spark.table(f"{lakehouse.gold_schema}.fact_sales")
    return marts.fact_by_date_range(
        fact, lakehouse.dims[DATE.name].read(), *DATE_RANGE, lakehouse.fact_part, lakehouse.fact_part_of
    )


def rollup_late_members(spark: SparkSession, folder: str) -> DataFrame:
    """The roll-up of all lines over the dimensions of batch 0: later members are one group of NULLs."""
    lakehouse = _lakehouse(spark, "rollup-late")
    lakehouse.refresh_dimensions(lakehouse.write_silver(order_lines.bronze_batch(spark, folder, 0), "0"))
    lakehouse.load_fact(lakehouse.write_silver(order_lines.bronze_sales(spark, folder)), on_duplicate="keep")
    dims = lakehouse.dimensions()
    return marts.star_rollup(lakehouse.fact.read(), {spec: dims[spec.name] for spec in DIMENSIONS}, rollup_groups())


def incremental_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Three batches arrive as files one after the other; each run takes the new ones."""
    lakehouse = _lakehouse(spark, "stream")
    landing, checkpoint = f"{lakehouse.root}/landing", f"{lakehouse.root}/checkpoint"
    for batch in BATCHES:
        order_lines.bronze_batch(spark, folder, batch).coalesce(LANDED_FILES).write.parquet(f"{landing}/{batch}")
        load_new_files(lakehouse, landing, checkpoint, on_duplicate="aggregate")
    return lakehouse.dims["dealer"].read()


def event_windows(spark: SparkSession, folder: str) -> DataFrame:
    """Events per type and six hours, of windows that are closed an hour after their end; the events land in two runs."""
    events = order_lines.table(spark, folder, "events").select("event_id", "ts", "event_type", "value")
    root = new_folder(spark, "event-windows")
    first = F.col("ts") <= F.lit(LOADED_UNTIL).cast("timestamp_ntz")
    for run, part in enumerate((events.where(first), events.where(~first))):
        part.write.parquet(f"{root}/landing/{run}")
        close_windows(
            spark, f"{root}/landing", events.schema, "ts", "6 hours", "1 hour", ["event_type"],
            {"events": F.count(F.lit(1)), "first_id": F.min("event_id"), "last_id": F.max("event_id")}, f"{root}/closed", f"{root}/checkpoint",
        )
    return spark.read.parquet(f"{root}/closed").drop("batch")


def lakehouse_chain(spark: SparkSession, folder: str) -> DataFrame:
    """Three batches through all layers, then one line for each gold table, read from the catalog."""
    lakehouse = _lakehouse(spark, "chain")
    for batch in BATCHES:
        lakehouse.load_batch(order_lines.bronze_batch(spark, folder, batch), str(batch), on_duplicate="aggregate")

    def line(table: str, key: str, revenue: Column) -> DataFrame:
        return spark.table(f"{lakehouse.gold_schema}.{table}").agg(
            F.lit(table).alias("table_name"),
            F.count(F.lit(1)).alias("row_count"),
            F.min(key).alias("key_min"),
            F.max(key).alias("key_max"),
            F.sum(revenue).alias("revenue"),
        )

    lines = [line(spec.table, spec.key, F.lit(None).cast("bigint")) for spec in DIMENSIONS]
    lines.append(line("fact_sales", FACT_KEYS[-1], F.col("Revenue")))
    return reduce(DataFrame.unionByName, lines)


QUERIES: dict[str, Query] = {
    "bronze_sales": bronze_sales,
    "silver_sales": silver_sales,
    "model_category": model_categories,
    "revenue_per_unit": revenue_per_unit_with_zeros,
    "sql_on_files": sql_on_files,
    "units_by_year_branch": units_by_year_branch,
    "csv_incremental": csv_incremental,
    "bronze_drift": bronze_drift,
    **{f"{spec.table}_initial": partial(dim_initial, spec) for spec in DIMENSIONS},
    **{f"{spec.table}_lookup": partial(dim_lookup, spec) for spec in DIMENSIONS},
    **{f"{spec.table}_scd1": partial(dim_scd1, spec) for spec in DIMENSIONS},
    "dim_attr_conflict": dim_attr_conflict,
    "surrogate_key_append": surrogate_key_append,
    "fact_sales": fact_sales,
    "fact_late_members": fact_late_members,
    "fact_inferred_members": fact_inferred_members,
    "fact_grain": fact_grain,
    "fact_merge": fact_merge,
    "fact_merge_bucketed": partial(fact_merge, fact_buckets=FACT_BUCKETS),
    "merge_partial_columns": merge_partial_columns,
    "merge_multi_match_check": merge_multi_match_check,
    "star_rollup": star_rollup,
    "rollup_maintained": rollup_maintained,
    "incremental_hwm": incremental_hwm,
    "cdc_apply": cdc_changes,
    "extract_diff": extract_changes,
    "incremental_stream": incremental_stream,
    "fact_split_batches": fact_split_batches,
    "csv_stream": csv_stream,
    "csv_quarantine": csv_quarantine,
    "fact_by_date_range": fact_by_date_range,
    "event_windows": event_windows,
    "rollup_late_members": rollup_late_members,
    "lakehouse_chain": lakehouse_chain,
}
