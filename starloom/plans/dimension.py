"""Type-1 slowly changing dimensions, the same steps for each of them."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from starloom.functions import day_number
from starloom.operators.keys import highest_key, number_new, stage_in_key_order
from starloom.operators.members import latest_members
from starloom.schemas import DimSpec, no_rows, same


def members_of(spec: DimSpec, silver: DataFrame) -> DataFrame:
    """The members a silver batch mentions, with their latest attributes."""
    rows = silver.select(
        F.col(spec.source_id).alias(spec.id),
        *[F.col(source).alias(name) for name, source in spec.attrs],
        day_number(F.col("Year"), F.col("Month"), F.col("Day")).alias("sold_on"),
    )
    return latest_members(rows, spec.id, spec.attr_names, F.col("sold_on"))


def look_up_members(spec: DimSpec, members: DataFrame, existing: DataFrame) -> DataFrame:
    """Members with the batch's attributes and the existing key, NULL for new ones.

    ``changed`` tells whether the dimension has to take the row over. One left
    join answers for both kinds, so the members are computed once.
    """
    differs = F.lit(False)
    for name in spec.attr_names:
        differs = differs | ~same(f"member.{name}", f"existing.{name}")
    key = F.col(f"existing.{spec.key}")
    return (
        members.alias("member")
        .join(existing.alias("existing"), F.col(f"member.{spec.id}") == F.col(f"existing.{spec.id}"), "left")
        .select(
            *[F.col(f"member.{c}").alias(c) for c in (spec.id, *spec.attr_names)],
            key.alias(spec.key),
            (key.isNull() | differs).alias("changed"),
        )
    )


def stage_members(spec: DimSpec, silver: DataFrame, existing: DataFrame, path: str) -> DataFrame:
    """Write the batch's members, looked up and in key order, to ``path``.

    This is the only pass over silver; everything after it reads the small table.
    """
    looked_up = look_up_members(spec, members_of(spec, silver), existing)
    return stage_in_key_order(looked_up, spec.id, spec.key, path)


def stage_unknown(spec: DimSpec, silver: DataFrame, existing: DataFrame, path: str) -> DataFrame:
    """Write placeholders, without attributes, for the ids of ``silver`` that are no members yet, in key order."""
    ids = silver.select(F.col(spec.source_id).alias(spec.id)).where(F.col(spec.id).isNotNull()).distinct()
    unknown = ids.join(existing.select(spec.id), spec.id, "left_anti")
    fields = {f.name: F.lit(None).cast(f.dataType) for f in spec.schema if f.name != spec.id}
    return stage_in_key_order(unknown.withColumns(fields), spec.id, spec.key, path)


def apply_members(spec: DimSpec, staged: DataFrame, existing: DataFrame) -> DataFrame:
    """The dimension after the batch: attributes overwritten, keys kept, new members appended."""
    numbered = number_new(staged, spec.key, highest_key(existing, spec.key))
    untouched = existing.join(staged.select(spec.id), spec.id, "left_anti")
    return untouched.select(spec.columns).unionByName(numbered.select(spec.columns))


def build_dimension(spec: DimSpec, silver: DataFrame, path: str, existing: DataFrame | None = None) -> DataFrame:
    """Build a dimension from silver, or refresh ``existing`` with it; the first run is like any other."""
    if existing is None:
        existing = no_rows(silver.sparkSession, spec.schema)
    return apply_members(spec, stage_members(spec, silver, existing, path), existing)
