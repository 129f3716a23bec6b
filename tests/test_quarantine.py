"""What a load with a quarantine writes: no copy of all rows, compressed files, narrow shuffles."""

import glob
import re

import pytest
from pyspark.sql import DataFrameWriter, functions as F

from conftest import SMALL
from fixtures import bronze, rows
from starloom import catalogue
from starloom.plans.lakehouse import Lakehouse
from starloom.schemas import BRONZE, SILVER
from starloom.sources import tables
from starloom.streaming import files, load_new_files

LINE = 'BR1,DLR1,Alp-M1,7,{},DT1,28,5,2020,North,"One, Two",Alpha'


def house(spark, folder, name):
    return Lakehouse(spark, f"{folder}/{name}", f"silver_aside_{name}", f"gold_aside_{name}", dates_per_part=2)


def land(path, *units):
    path.mkdir(exist_ok=True)
    (path / f"{len(list(path.iterdir()))}.csv").write_text("\n".join([",".join(BRONZE.fieldNames()), *map(LINE.format, units)]) + "\n")


def test_only_refused_rows_are_copied(spark, folder, tmp_path, monkeypatch):
    monkeypatch.setattr(files, "new_folder", lambda *a: f"{folder}/copy")
    monkeypatch.setattr(files, "drop_folder", lambda *a: None)
    land(tmp_path / "landing", 1, "many", 3, 4, 5)
    lake = house(spark, folder, "only")
    got = load_new_files(lake, f"{folder}/landing", f"{folder}/c", "keep", file_format="csv", quarantine=f"{folder}/bad", most_refused=0.2)
    assert got == [4] and rows(lake.silver(), "Units_Sold") == [(1,), (3,), (4,), (5,)]
    assert spark.read.parquet(f"{folder}/copy").count() == 1
    assert rows(spark.read.parquet(f"{folder}/bad"), "raw_line", "reason") == [(LINE.format("many"), "Units_Sold: many")]


def test_files_that_change_between_the_reads_are_refused(spark, folder, tmp_path, monkeypatch):
    land(tmp_path / "landing", 1, "many")
    lake, whole = house(spark, folder, "changed"), Lakehouse.load_files

    def changed(self, good, *args):
        with open(f"{folder}/landing/0.csv", "a") as file:
            file.write(LINE.format(9) + "\n" + LINE.format("none") + "\n")
        return whole(self, good, *args)

    monkeypatch.setattr(Lakehouse, "load_files", changed)
    with pytest.raises(Exception, match="files have changed"):
        load_new_files(lake, f"{folder}/landing", f"{folder}/c", "keep", file_format="csv", quarantine=f"{folder}/bad", most_refused=0.5)
    assert not lake.lines.exists() and not lake.fact.exists()


def test_another_number_of_rows_leaves_the_tables(spark, folder):
    lake = house(spark, folder, "number")
    landed = bronze(spark, {}, {"Revenue": 5}).withColumn("file_path", F.lit("a"))
    with pytest.raises(ValueError, match="2 rows instead of 3"):
        lake.load_files(landed, "keep", 3)
    assert not lake.lines.exists() and not lake.fact.exists()
    lake.load_files(landed, "keep", 2)
    assert lake.silver().count() == 2


def test_rows_move_as_bronze(spark, folder, monkeypatch):
    plans, staged = [], tables.CatalogTable.staged

    def spy(table, df, *args, **options):
        if table.schema == SILVER:
            plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return staged(table, df, *args, **options)

    monkeypatch.setattr(tables.CatalogTable, "staged", spy)
    lake = house(spark, folder, "moved")
    lake.write_silver(bronze(spark, {}, {"Units_Sold": 0}))
    lake.load_files(bronze(spark, {"Date_ID": None}, {"Model_ID": "x"}).withColumn("file_path", F.lit("a")), "keep")
    assert len(plans) == 2
    for text in plans:
        derived, _, moved = text.partition("RebalancePartitions")
        assert moved and re.search("revenuePerUnit", derived) and not re.search("revenuePerUnit|Model_Category", moved)
    assert rows(lake.silver(), "Model_Category", "revenuePerUnit") == [("Alpha", None), ("Alpha", 50.0), ("Alpha", 50.0), ("x", 50.0)]


def test_landed_files_are_compressed_and_written_in_many_partitions(spark, monkeypatch):
    roots, asked, build, csv = [], [], catalogue._lakehouse, DataFrameWriter.csv

    def spied(*args, **options):
        roots.append(build(*args, **options))
        return roots[-1]

    def spy(writer, *args, **options):
        asked.append(int(spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", "0")))
        return csv(writer, *args, **options)

    monkeypatch.setattr(catalogue, "_lakehouse", spied)
    monkeypatch.setattr(DataFrameWriter, "csv", spy)
    monkeypatch.setattr(tables, "TASK_BYTES", 5000)
    found = dict(rows(catalogue.csv_quarantine(spark, SMALL)))
    landed = glob.glob(f"{roots[0].root}/landing/part-*")
    assert landed and all(name.endswith(".csv.gz") for name in landed)
    assert asked[0] > 8
    lines = spark.read.parquet(f"{SMALL}/lineitem.parquet").groupBy((F.col("l_quantity") == 50).alias("many")).count()
    assert found == {"Units_Sold: many" if many else "loaded": n for many, n in rows(lines)}


def test_copies_are_packed_densely(spark, folder):
    tables.write_spread(spark.range(10), f"{folder}/copy")
    assert glob.glob(f"{folder}/copy/*.zstd.parquet") and not glob.glob(f"{folder}/copy/*.snappy.parquet")
