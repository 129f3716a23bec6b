"""A fact in buckets by its keys, which merges leave where it is."""

import os
import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from fixtures import bronze, plan, rows
from starloom.operators.upsert import DuplicateKeys
from starloom.plans.lakehouse import Lakehouse
from starloom.schemas import FACT, FACT_KEYS
from starloom.sources.tables import CatalogTable, range_bucket

BUCKETS = 4


def house(spark, folder, label, **settings):
    name = re.sub(r"\W", "_", f"{folder}{label}".strip("/"))
    return Lakehouse(spark, f"{folder}/{label}", f"silver_{name}", f"gold_{name}", dates_per_part=8, **settings)


@pytest.fixture
def lake(spark, folder):
    return house(spark, folder, "lake", fact_buckets=BUCKETS)


@pytest.fixture
def by_shuffle(spark):
    """Joins by shuffle, in the plan that is first made."""
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def lines(spark, first, last, revenue, **more):
    changes = [{"Date_ID": f"DT{d:03}", "Model_ID": f"Alpha-M{d % 7}", "Dealer_ID": f"D{d % 5}", "Revenue": revenue, **more} for d in range(first, last)]
    return bronze(spark, *changes)


def parents(text):
    """The operators above each scan of the physical plan, nearest last."""
    found, above = [], []
    for line in text.split("== Physical Plan ==")[1].splitlines():
        if not line.strip():
            continue
        depth = len(line) - len(line.lstrip(" :+-"))
        above = [(d, n) for d, n in above if d < depth] + [(depth, line.strip(" :+-"))]
        if "Scan parquet" in line:
            found.append([n for _, n in above])
    return found


def test_merge_shuffles_the_increment_alone(spark, lake, folder, by_shuffle):
    lake.load_batch(lines(spark, 0, 40, 1), "0")
    lines_of = lake.fact.read().limit(5)
    lines_of.write.parquet(f"{folder}/new")
    new = spark.read.schema(FACT).parquet(f"{folder}/new")
    merged = lake.fact.merged(new, new, F.col(lake.fact_part).isin(0, 1, 2))
    scans = parents(plan(merged))
    target = [s for s in scans if lake.fact.name in s[-1]]
    others = [s for s in scans if lake.fact.name not in s[-1]]
    assert len(target) == 1 and len(others) == 2
    assert any("SortMergeJoin" in step and "LeftAnti" in step for step in target[0])
    assert not any("Exchange" in step for step in target[0])
    assert all(any("Exchange hashpartitioning" in step for step in s) for s in others)
    assert "Bucketed: true" in target[0][-1] or f"SelectedBucketsCount: {BUCKETS} out of {BUCKETS}" in target[0][-1]


def test_files_lie_in_their_buckets(spark, lake):
    lake.load_batch(lines(spark, 0, 40, 1), "0")
    lake.load_batch(lines(spark, 30, 60, 2), "1", on_duplicate="aggregate")
    assert lake.fact.read().count() == 60
    stored = spark.table(lake.fact.name).select(*FACT_KEYS, F.col("_metadata.file_name").alias("file"))
    number = F.pmod(F.hash(*FACT_KEYS), F.lit(BUCKETS))
    told = F.regexp_extract("file", r"_(\d{5})\.", 1).cast("int")
    assert stored.where(number != told).count() == 0
    per_part = {}
    for place, _, names in os.walk(lake.fact.path):
        for n in names:
            if n.endswith(".parquet"):
                key = (place, re.search(r"_(\d{5})\.", n)[1])
                per_part[key] = per_part.get(key, 0) + 1
    assert max(per_part.values()) <= 2


def test_equals_the_fact_without_buckets(spark, folder, lake):
    plain = house(spark, folder, "plain")
    loads = [lines(spark, 0, 40, 1), lines(spark, 30, 55, 2), lines(spark, 30, 50, 3)]
    for place in (plain, lake):
        for name, load in zip("011", loads):
            place.load_batch(load, name, on_duplicate="aggregate")
    assert rows(plain.fact.read()) == rows(lake.fact.read())


def test_lines_that_stay_apart_and_repeats_are_refused(spark, lake):
    with pytest.raises(ValueError, match="one row for each"):
        lake.load_batch(lines(spark, 0, 2, 1), "0", on_duplicate="keep")
    with pytest.raises(DuplicateKeys):
        lake.load_batch(lines(spark, 0, 2, 1).unionByName(lines(spark, 0, 2, 1)), "0")


def test_null_keys_are_found_again_and_read_as_null(spark, lake, by_shuffle):
    nameless = bronze(spark, {"Branch_ID": None, "Date_ID": None, "Revenue": 5}, {"Revenue": 6})
    lake.load_batch(nameless, "0")
    for _ in "ab":
        lake.load_batch(bronze(spark, {"Branch_ID": None, "Date_ID": None, "Revenue": 7}), "1", on_duplicate="aggregate")
    assert rows(lake.fact.read(), "Revenue", "dim_branch_key", "dim_date_key") == [(6, 1, 1), (12, None, None)]
    assert rows(spark.table(lake.fact.name), "Revenue", "dim_branch_key") == [(6, 1), (12, 0)]


def test_keys_below_one_are_refused(spark, folder):
    table = CatalogTable(spark, f"b_{abs(hash(folder))}.t", f"{folder}/t", FACT, {"p": (IntegerType(), range_bucket("dim_date_key", 2))}, None, (FACT_KEYS, 2))
    row = spark.createDataFrame([(1, 1, 1.0, 1, 0, 1, 1)], FACT)
    with pytest.raises(Exception, match="dim_dealer_key must not be 0"):
        table.replace(row)


def test_number_of_buckets_cannot_change_silently(spark, folder, lake):
    lake.load_batch(lines(spark, 0, 3, 1), "0")
    with pytest.raises(ValueError, match="buckets"):
        house(spark, folder, "lake", fact_buckets=BUCKETS * 2).fact.read()


def test_an_overwrite_that_was_cut_off_is_done_later(spark, folder, lake, monkeypatch):
    lake.load_batch(lines(spark, 0, 20, 1), "0")
    before = lake.fact.read().count()
    new = lines(spark, 18, 24, 5)
    cut = CatalogTable._overwrite

    def fail(table, whole):
        if table is lake.fact:
            raise OSError("lost")
        cut(table, whole)

    monkeypatch.setattr(CatalogTable, "_overwrite", fail)
    with pytest.raises(OSError):
        lake.load_batch(new, "1", on_duplicate="aggregate")
    monkeypatch.setattr(CatalogTable, "_overwrite", cut)
    again = house(spark, folder, "lake", fact_buckets=BUCKETS)
    again.load_batch(new, "1", on_duplicate="aggregate")
    assert again.fact.read().count() == before + 4
    assert again.fact.read().agg(F.sum("Revenue")).first()[0] == 20 + 6 * 5


def test_totals_follow_a_fact_in_buckets(spark, folder):
    lake = house(spark, folder, "totals", fact_buckets=BUCKETS, totals={"sales_by_date": ["dim_date_key"]})
    lake.load_batch(lines(spark, 0, 20, 1), "0")
    lake.load_batch(lines(spark, 10, 30, 2), "1", on_duplicate="aggregate")
    want = lake.fact.read().groupBy("dim_date_key").agg(F.sum("Revenue").alias("Revenue"))
    assert rows(lake.totals["sales_by_date"].read(), "dim_date_key", "Revenue") == rows(want)
