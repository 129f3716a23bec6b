import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from fixtures import bronze, plan, rows
from starloom.functions import model_category, padded
from starloom.plans.marts import units_by_year_branch
from starloom.plans.silver import to_silver
from starloom.schemas import BRONZE, SILVER, conform


def test_category_is_the_text_before_the_first_dash(spark):
    ids = ["Alpha-M10", "NODASH13", "", None, "A-B-C", "-x"]
    found = {r["Model_ID"]: r["Model_Category"] for r in to_silver(bronze(spark, *[{"Model_ID": i} for i in ids])).collect()}
    assert found == {"Alpha-M10": "Alpha", "NODASH13": "NODASH13", "": "", None: None, "A-B-C": "A", "-x": ""}


def test_category_equals_first_element_of_a_split(spark):
    ids = spark.createDataFrame([(x,) for x in ["a-b", "--", "é-ü", "a", "-", "", None]], "id string")
    assert ids.where(~model_category(F.col("id")).eqNullSafe(F.split("id", "-")[0])).count() == 0


def test_no_units_gives_null_under_ansi(spark):
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"
    lines = bronze(spark, {"Revenue": 5, "Units_Sold": 0}, {"Units_Sold": None}, {"Revenue": 5, "Units_Sold": 2})
    silver = to_silver(lines)
    assert rows(silver, "revenuePerUnit") == [(None,), (None,), (2.5,)]
    assert silver.schema["revenuePerUnit"].dataType == DoubleType()


def test_layout_and_no_shuffle(spark):
    silver = to_silver(bronze(spark, {}))
    assert silver.columns == SILVER.fieldNames()
    assert [f.dataType for f in silver.schema] == [f.dataType for f in SILVER]
    assert "Exchange" not in plan(silver)


def test_conform_matches_names_without_case_and_reports_missing_ones(spark):
    odd = bronze(spark, {}).withColumnRenamed("Branch_ID", "BRANCH_id")
    assert conform(odd, BRONZE).columns == BRONZE.fieldNames()
    with pytest.raises(ValueError, match="Units_Sold"):
        conform(odd.drop("Units_Sold"), BRONZE)


def test_report_breaks_ties_by_name(spark):
    lines = bronze(spark, {"BranchName": "b"}, {"BranchName": "a"}, {"Year": 2019, "BranchName": "z", "Units_Sold": 1})
    found = [tuple(r) for r in units_by_year_branch(to_silver(lines)).collect()]
    assert found == [(2019, "z", 1), (2020, "a", 2), (2020, "b", 2)]


def test_padding_keeps_long_numbers(spark):
    numbers = spark.createDataFrame([(7,), (123456789,)], "n bigint")
    assert rows(numbers.select(padded(F.col("n"), 4).alias("t"))) == [("0007",), ("123456789",)]
