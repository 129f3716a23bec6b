"""Column layouts of every layer, and the description of each dimension."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructField, StructType


def _struct(*columns) -> StructType:
    return StructType([StructField(name, dtype()) for name, dtype in columns])


# Column names, order and types of the layers.
BRONZE = _struct(
    ("Branch_ID", StringType),
    ("Dealer_ID", StringType),
    ("Model_ID", StringType),
    ("Revenue", LongType),
    ("Units_Sold", LongType),
    ("Date_ID", StringType),
    ("Day", IntegerType),
    ("Month", IntegerType),
    ("Year", IntegerType),
    ("BranchName", StringType),
    ("DealerName", StringType),
    ("Product_Name", StringType),
)

SILVER = _struct(
    ("Branch_ID", StringType),
    ("Dealer_ID", StringType),
    ("Model_ID", StringType),
    ("Model_Category", StringType),
    ("Revenue", LongType),
    ("Units_Sold", LongType),
    ("revenuePerUnit", DoubleType),
    ("Date_ID", StringType),
    ("Day", IntegerType),
    ("Month", IntegerType),
    ("Year", IntegerType),
    ("BranchName", StringType),
    ("DealerName", StringType),
    ("Product_Name", StringType),
)

FACT = _struct(
    ("Revenue", LongType),
    ("Units_Sold", LongType),
    ("revenuePerUnit", DoubleType),
    ("dim_branch_key", LongType),
    ("dim_dealer_key", LongType),
    ("dim_model_key", LongType),
    ("dim_date_key", LongType),
)


@dataclass(frozen=True)
class DimSpec:
    """One dimension: its natural id, its attributes and where silver keeps them.

    ``attrs`` pairs each dimension column with the silver column it comes from.
    """

    name: str
    source_id: str
    attrs: tuple[tuple[str, str], ...] = ()

    @property
    def table(self) -> str:
        return f"dim_{self.name}"

    @property
    def id(self) -> str:
        return f"{self.name}_id"

    @property
    def key(self) -> str:
        return f"dim_{self.name}_key"

    @property
    def attr_names(self) -> list[str]:
        return [name for name, _ in self.attrs]

    @property
    def columns(self) -> list[str]:
        return [self.id, *self.attr_names, self.key]

    @property
    def schema(self) -> StructType:
        return _struct(*[(c, StringType) for c in (self.id, *self.attr_names)], (self.key, LongType))


BRANCH = DimSpec("branch", "Branch_ID", (("BranchName", "BranchName"),))
DEALER = DimSpec("dealer", "Dealer_ID", (("DealerName", "DealerName"),))
MODEL = DimSpec("model", "Model_ID", (("model_category", "Model_Category"),))
DATE = DimSpec("date", "Date_ID")

DIMENSIONS = (BRANCH, DEALER, MODEL, DATE)
FACT_KEYS = [spec.key for spec in DIMENSIONS]


def conform(df: DataFrame, schema: StructType, *kept: str) -> DataFrame:
    """Select ``schema``'s columns in order and with its types, then those of ``kept`` as they are.

    Names match without regard to case. A missing column fails here, before any
    job runs; a value that does not fit its type fails the job (ANSI cast).
    """
    present = {c.lower() for c in df.columns}
    missing = [f.name for f in schema if f.name.lower() not in present]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in schema] + list(kept))


def no_rows(spark: SparkSession, schema: StructType) -> DataFrame:
    """An empty relation that the optimizer knows to be empty, so that joins to it fold away."""
    nothing = spark.range(1).where(F.lit(False))
    return nothing.select([F.lit(None).cast(f.dataType).alias(f.name) for f in schema])


def same(left: str, right: str) -> Column:
    """Equality that also holds between two NULLs."""
    return F.col(left).eqNullSafe(F.col(right))
