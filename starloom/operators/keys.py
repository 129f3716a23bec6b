"""Dense surrogate keys that do not depend on the layout of the data.

New members get ``highest + 1 .. highest + n`` in the order of their natural
ids. A window over all of them would sort in one task. Here a range shuffle
puts ascending id ranges into ascending partitions, each is sorted by itself,
and a row's key is the number of new rows in earlier partitions plus its
position. Members are distinct, so no range can be hot.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from starloom.sources.files import read_parquet

RANGE, POSITION = "key_range", "key_position"

# monotonically_increasing_id() holds the row's position in its lower 33 bits.
_POSITION_BITS = (1 << 33) - 1


def stage_in_key_order(members: DataFrame, id_col: str, key_col: str, path: str) -> DataFrame:
    """Write ``members`` to ``path`` with range number and position; return the written table.

    Rows whose ``key_col`` is NULL are new and come first in each range. Range
    bounds are sampled when the job runs, hence the numbers are written down
    once and never computed again, also not after an executor is lost.
    """
    order = [F.col(key_col).isNotNull(), F.col(id_col)]
    staged = (
        members.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumns(
            {
                RANGE: F.spark_partition_id(),
                POSITION: F.monotonically_increasing_id().bitwiseAND(F.lit(_POSITION_BITS)),
            }
        )
    )
    staged.write.parquet(path)
    added = [StructField(RANGE, IntegerType()), StructField(POSITION, LongType())]
    return read_parquet(members.sparkSession, path, StructType([*members.schema.fields, *added]))


def number_new(staged: DataFrame, key_col: str, highest: Column) -> DataFrame:
    """Give the staged rows without key the keys that follow ``highest``."""
    new_rows = staged.where(F.col(key_col).isNull()).groupBy(RANGE).agg(F.count(F.lit(1)).alias("rows"))
    # One row per shuffle partition, so one task for the running sum and a broadcast are bounded.
    before = Window.orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    starts = new_rows.select(RANGE, F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("rows_before"))
    next_key = highest + F.col("rows_before") + F.col(POSITION) + 1
    return (
        staged.join(F.broadcast(starts), RANGE, "left")
        .withColumn(key_col, F.coalesce(F.col(key_col), next_key))
        .drop(RANGE, POSITION, "rows_before")
    )


def highest_key(table: DataFrame, key_col: str) -> Column:
    """Greatest key as a scalar subquery; 0 for an empty table."""
    return table.agg(F.coalesce(F.max(key_col), F.lit(0).cast("bigint")).alias("highest")).scalar()
