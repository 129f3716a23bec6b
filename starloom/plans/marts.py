"""Reports over silver and over the star schema."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from starloom.operators.lookup import BROADCAST_BYTES, BROADCAST_ROWS, Lookup, measure
from starloom.schemas import DATE, DimSpec


def units_by_year_branch(silver: DataFrame) -> DataFrame:
    """Units sold per year and branch, the best branch of a year first."""
    return (
        silver.groupBy("Year", "BranchName")
        .agg(F.sum("units_sold").alias("total_units_sold"))
        .orderBy(F.asc("Year"), F.desc("total_units_sold"), F.asc("BranchName"))
    )


def star_rollup(
    fact: DataFrame,
    dims: Mapping[DimSpec, DataFrame],
    group: Mapping[str, tuple[DimSpec, Column]],
    sums: Sequence[str] = ("Revenue", "Units_Sold"),
    max_rows: int = BROADCAST_ROWS,
    max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Sums per group of dimension attributes; facts without the member form a group of NULLs, so the sums add up to the fact.

    ``group`` names each output column and gives its dimension and expression.
    A small dimension is joined by broadcast ahead of the only aggregation. For a
    large one the facts are first summed per key, so that the join sees a key
    once per group however many facts it has.
    """
    used = list(dict.fromkeys(spec for spec, _ in group.values()))
    named = {
        spec: dims[spec].select(spec.key, *[expr.alias(name) for name, (owner, expr) in group.items() if owner == spec])
        for spec in used
    }
    lookups = {
        spec: Lookup(table, spec.key, spec.key, tuple(c for c in table.columns if c != spec.key))
        for spec, table in named.items()
    }
    sizes = dict(zip(used, measure(list(lookups.values()))))
    small = [spec for spec in used if sizes[spec].fits(max_rows, max_bytes)]
    large = [spec for spec in used if spec not in small]

    def totals(df: DataFrame, keys: list[str]) -> DataFrame:
        return df.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in sums])

    rows = fact.select(*[spec.key for spec in used], *sums)
    for spec in small:
        rows = rows.join(F.broadcast(named[spec]), spec.key, "left").drop(spec.key)
    for spec in large:
        rows = totals(rows, [c for c in rows.columns if c not in sums]).join(named[spec], spec.key, "left").drop(spec.key)
    return totals(rows, list(group)).select(*group, *sums)


def key_totals(fact: DataFrame, keys: Sequence[str], *kept: str) -> DataFrame:
    """Sums and numbers of facts per combination of some keys; what ``star_rollup`` gives over them is what it gives over the fact."""
    sums = [F.sum(c).alias(c) for c in ("Revenue", "Units_Sold")]
    return fact.groupBy(*keys, *kept).agg(*sums, F.count(F.lit(1)).alias("lines"))


def fact_by_date_range(
    fact: DataFrame, dates: DataFrame, first: str, last: str, part_name: str, part_of: Column, sums: Sequence[str] = ("Revenue", "Units_Sold")
) -> DataFrame:
    """Sums per date id from ``first`` to ``last``, over the fact's partitions that hold those dates only.

    ``fact`` is the catalog table with its partition column. Date keys grow with
    arrival, not by the calendar, so the dates' keys say which partitions to read;
    there are at most as many as days in the range.
    """
    wanted = dates.where(F.col(DATE.id).between(first, last)).select(DATE.id, DATE.key)
    parts = [r[0] for r in wanted.select(part_of.alias("part")).distinct().collect()]
    rows = fact.where(F.col(part_name).isin(parts) if parts else F.lit(False)).join(wanted, DATE.key)
    return rows.groupBy(DATE.id).agg(*[F.sum(c).alias(c) for c in sums])
