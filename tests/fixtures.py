"""Tiny sale lines for the edge cases."""

from starloom.schemas import BRONZE

# One complete sale line.
DEFAULTS = {
    "Branch_ID": "BR0001",
    "Dealer_ID": "DLR000001",
    "Model_ID": "Alpha-M1",
    "Revenue": 100,
    "Units_Sold": 2,
    "Date_ID": "DT1",
    "Day": 1,
    "Month": 1,
    "Year": 2020,
    "BranchName": "North",
    "DealerName": "Dealer One",
    "Product_Name": "Alpha",
}


def bronze(spark, *changes):
    """One sale line per argument, each the default line with some columns changed."""
    rows = [tuple({**DEFAULTS, **change}[c] for c in BRONZE.fieldNames()) for change in changes]
    return spark.createDataFrame(rows, BRONZE)


def rows(df, *columns):
    """Rows as a sorted list of tuples; NULL sorts first."""
    found = [tuple(r) for r in df.select(*(columns or df.columns)).collect()]
    return sorted(found, key=lambda r: [(v is not None, v) for v in r])


def plan(df):
    """The optimized and physical plan as text."""
    return df._jdf.queryExecution().toString()
