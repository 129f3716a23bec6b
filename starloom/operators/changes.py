"""Change data: logs of inserts, updates and deletes, and the changes between two extracts."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F

from starloom.operators.upsert import require_unique
from starloom.schemas import same

INSERT, UPDATE, DELETE = "I", "U", "D"


def _match(left: str, right: str, keys: Sequence[str]) -> Column:
    return reduce(and_, [same(f"{left}.{k}", f"{right}.{k}") for k in keys])


def last_changes(log: DataFrame, keys: Sequence[str], sequence: str, op: str) -> DataFrame:
    """The change of each key with the highest ``sequence``, in whatever order the log is.

    Combined inside each task before the shuffle, so a key with a third of the log arrives
    as one row a task. Of changes with an equal sequence a delete counts most, then the greatest
    values, so that the result does not depend on the layout. A change without sequence raises.
    """
    values = [c for c in log.columns if c not in (*keys, sequence, op)]
    number = F.when(F.col(sequence).isNotNull(), F.col(sequence)).otherwise(F.raise_error(F.lit(f"a change without {sequence}")))
    order = F.struct(number.alias("sequence"), (F.col(op) == DELETE).alias("deletes"), *values, F.col(op).alias("op"))
    last = log.groupBy(*keys).agg(F.max(order).alias("last"))
    return last.select(*keys, *(F.col(f"last.{v}").alias(v) for v in values), F.col("last.sequence").alias(sequence), F.col("last.op").alias(op)).select(
        log.columns
    )


def cdc_apply(state: DataFrame, log: DataFrame, keys: Sequence[str], sequence: str, op: str) -> DataFrame:
    """``state`` after the changes of ``log``; both have the same columns, and ``state`` one row for each key.

    Deleted keys stay in the state with the sequence of their deletion, so a change that comes late
    or again alters nothing. Only the rows of changed keys are compared: a small log is
    broadcast by the planner, and the state is then not shuffled. ``live_rows`` leaves the deleted keys out.
    """
    if sorted(state.columns) != sorted(log.columns):
        raise ValueError(f"the state has the columns {state.columns}, the log {log.columns}")
    changes = last_changes(log.select(state.columns), keys, sequence, op)
    old, new = state.alias("old"), changes.alias("new")
    untouched = old.join(new.select(*keys).alias("new"), _match("old", "new", keys), "left_anti")
    # A change counts only if it is later than what the state has.
    before = F.col(f"old.{sequence}")
    joined = new.join(old, _match("new", "old", keys), "left")
    later = before.isNull() | (F.col(f"new.{sequence}") > before)
    merged = joined.select(*(F.when(later, F.col(f"new.{c}")).otherwise(F.col(f"old.{c}")).alias(c) for c in state.columns))
    return untouched.select(state.columns).unionByName(merged)


def live_rows(state: DataFrame, op: str) -> DataFrame:
    """The rows that are not deleted, without the column of the operation."""
    return state.where(~F.col(op).eqNullSafe(F.lit(DELETE))).drop(op)


def row_digest(columns: Sequence[str]) -> Column:
    """128 bits of all values, nulls and empty strings kept apart."""
    return F.md5(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}).cast("binary"))


def extract_diff(before: DataFrame, after: DataFrame, keys: Sequence[str], op: str = "op") -> DataFrame:
    """What turns the extract ``before`` into ``after``: rows of ``after`` that are new or differ, and deleted rows as they were.

    The extracts meet as keys and digests of the other columns; whole rows are taken
    only for keys that differ. NULL keys equal each other; a key that repeats in an extract raises.
    """
    if before.columns != after.columns:
        raise ValueError(f"the extracts have the columns {before.columns} and {after.columns}")
    if op in after.columns:
        raise ValueError(f"the extracts have a column {op}")
    for extract in (before, after):
        require_unique(extract, keys)
    values = [c for c in after.columns if c not in keys]
    digest = lambda extract: extract.select(*keys, row_digest(values).alias("digest"))
    old, new = digest(before).alias("old"), digest(after).alias("new")
    kind = F.when(F.col("old.digest").isNull(), INSERT).when(F.col("new.digest").isNull(), DELETE).otherwise(UPDATE)
    own = [F.when(F.col("new.digest").isNull(), F.col(f"old.{k}")).otherwise(F.col(f"new.{k}")).alias(k) for k in keys]
    differs = ~F.col("old.digest").eqNullSafe(F.col("new.digest"))
    changed = old.join(new, _match("old", "new", keys), "full").where(differs).select(*own, kind.alias(op))

    def rows(extract: DataFrame, which: Column) -> DataFrame:
        found = extract.alias("rows").join(changed.where(which).alias("changed"), _match("rows", "changed", keys))
        return found.select(*(F.col(f"rows.{c}").alias(c) for c in extract.columns), F.col(f"changed.{op}").alias(op))

    return rows(after, F.col(op) != DELETE).unionByName(rows(before, F.col(op) == DELETE))
