"""Bronze to silver: two derived columns, fixed column order."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from starloom.functions import model_category, revenue_per_unit
from starloom.schemas import BRONZE, SILVER, conform


def to_silver(bronze: DataFrame, *kept: str) -> DataFrame:
    """Narrow transformations only, so bronze goes to silver without a shuffle; columns named in ``kept`` come along."""
    return (
        conform(bronze, BRONZE, *kept)
        .withColumns(
            {
                "Model_Category": model_category(F.col("Model_ID")),
                "revenuePerUnit": revenue_per_unit(F.col("Revenue"), F.col("Units_Sold")),
            }
        )
        .select(*SILVER.fieldNames(), *kept)
    )
