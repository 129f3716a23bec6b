"""The sales fact: surrogate keys in place of natural ids."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from starloom.functions import revenue_per_unit
from starloom.operators.lookup import BROADCAST_BYTES, BROADCAST_ROWS, Lookup, Size, star_lookup
from starloom.schemas import DIMENSIONS, FACT, FACT_KEYS


def build_fact(
    silver: DataFrame,
    dims: Mapping[str, DataFrame],
    max_rows: int = BROADCAST_ROWS,
    max_bytes: int = BROADCAST_BYTES,
    sizes: list[Size] | None = None,
    kept: Sequence[str] = (),
) -> DataFrame:
    """Silver left-joined to the dimensions; a row with an unknown member keeps a NULL key.

    Without ``sizes`` the dimensions are measured and checked for repeated ids first. Columns named in ``kept`` come along.
    """
    measures = ["Revenue", "Units_Sold", "revenuePerUnit"]
    facts = silver.select(*measures, *kept, *[spec.source_id for spec in DIMENSIONS])
    return star_lookup(facts, key_lookups(dims), max_rows, max_bytes, sizes).select(*FACT.fieldNames(), *kept)


def key_lookups(dims: Mapping[str, DataFrame]) -> list[Lookup]:
    """From natural ids to surrogate keys, for every dimension."""
    return [Lookup(dims[spec.name], spec.id, spec.source_id, (spec.key,)) for spec in DIMENSIONS]


def to_grain(fact: DataFrame, *conditions: str) -> DataFrame:
    """One row per combination of the four keys; sums are combined before the shuffle.

    Each of ``conditions`` names a boolean column that has to be true in one row, at least, of the combination.
    """
    sums = [F.sum(c).alias(c) for c in ("Revenue", "Units_Sold")]
    totals = fact.groupBy(*FACT_KEYS).agg(*sums, *[F.bool_or(c).alias(c) for c in conditions])
    for condition in conditions:
        totals = totals.where(condition)
    ratio = revenue_per_unit(F.col("Revenue"), F.col("Units_Sold"))
    return totals.withColumn("revenuePerUnit", ratio).select(FACT.fieldNames())
