"""MERGE as joins: matched rows are updated, new ones inserted, all others kept."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, functions as F

from starloom.schemas import same


class DuplicateKeys(ValueError):
    """The source of an upsert holds several rows for one key."""


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).where(F.col("copies") > 1)


def require_unique(df: DataFrame, keys: Sequence[str]) -> None:
    """Raise, naming a few keys, if a key occurs more than once."""
    sample = duplicate_keys(df, keys).limit(5).collect()
    if sample:
        shown = "; ".join(", ".join(f"{k}={row[k]}" for k in keys) for row in sample)
        raise DuplicateKeys(f"several source rows for one key, e.g. {shown}")


def _resolved(df: DataFrame, names: Sequence[str], side: str) -> list[str]:
    """The columns of ``df`` that ``names`` mean, whatever their case; an unknown name raises."""
    known = {c.lower(): c for c in df.columns}
    missing = [n for n in names if n.lower() not in known]
    if missing:
        raise ValueError(f"no such column in the {side}: {', '.join(missing)}")
    return [known[n.lower()] for n in names]


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    unique: bool = False,
    touched: DataFrame | None = None,
) -> DataFrame:
    """Replace the target rows that the source has a row for, and add the rest of the source.

    NULL keys equal each other, so applying a source twice changes nothing.
    Repeated source keys raise, which costs a pass over the source's keys;
    ``unique`` is for callers that have checked, or want all rows of a key. ``touched``
    names the keys to replace if they are more than those of the source: keys
    without a source row go. A small source is broadcast by the planner and the
    target is then not shuffled.
    """
    keys = _resolved(target, keys, "target")
    _resolved(source, target.columns, "source")
    if not unique:
        require_unique(source, keys)
    replaced = (source if touched is None else touched).select(*keys)
    match = reduce(and_, [same(f"target.{k}", f"replaced.{k}") for k in keys])
    kept = target.alias("target").join(replaced.alias("replaced"), match, "left_anti")
    return kept.unionByName(source.select(*target.columns))


def upsert_columns(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    update: Sequence[str],
    insert: Sequence[str] | None = None,
    unique: bool = False,
) -> DataFrame:
    """Upsert that sets only ``update`` in matched rows and only ``insert`` in new ones.

    Other columns keep the target's value, or are NULL in a new row. A NULL in
    the source does overwrite: presence of the row decides, not of the value.
    Keys are never changed. Names match without regard to case. A key or a column
    to update has to be on both sides and a column to insert in the target, else
    this raises; a column to insert that the source lacks is NULL. Repeated source
    keys raise unless the caller has checked (``unique``), so that no key is
    hot in the full join.
    """
    keys = _resolved(target, keys, "target")
    _resolved(source, [*keys, *update], "source")
    update = _resolved(target, update, "target")
    insert = target.columns if insert is None else _resolved(target, insert, "target")
    if not unique:
        require_unique(source, keys)
    theirs = {c.lower() for c in source.columns}
    old = target.withColumn("in_target", F.lit(True)).alias("target")
    new = source.withColumn("in_source", F.lit(True)).alias("source")
    match = reduce(and_, [same(f"target.{k}", f"source.{k}") for k in keys])
    is_old, is_new = F.col("in_target").isNotNull(), F.col("in_source").isNotNull()

    def merged(column: str):
        given = F.col(f"source.{column}") if column.lower() in theirs else F.lit(None)
        when_new = given if column in keys or column in insert else F.lit(None)
        when_both = given if column in update and column not in keys else F.col(f"target.{column}")
        value = F.when(is_old & is_new, when_both).when(is_old, F.col(f"target.{column}")).otherwise(when_new)
        return value.cast(target.schema[column].dataType).alias(column)

    return old.join(new, match, "full").select([merged(c) for c in target.columns])
