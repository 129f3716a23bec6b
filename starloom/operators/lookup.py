"""Left joins of a large table to dimensions, in the order and manner their sizes allow."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import LongType, StringType, StructType

from starloom.sources.tables import partitions_for

# Limits up to which a dimension's id and key columns are broadcast.
BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 64 << 20

# Groups for each partition in which the rows of frequent ids are looked for.
_GROUPS = 16

_ROW, _SALT, _COPIES = "row_number_in_scan", "salt", "copies"


@dataclass(frozen=True)
class Lookup:
    """Fetch ``columns`` of ``table`` where its ``table_id`` equals the facts' ``fact_id``."""

    table: DataFrame
    table_id: str
    fact_id: str
    columns: tuple[str, ...]

    @property
    def narrow(self) -> DataFrame:
        """Id and wanted columns; the id is renamed, as the facts may use the same name."""
        return self.table.select(F.col(self.table_id).alias("looked_up_id"), *self.columns)


@dataclass(frozen=True)
class Size:
    rows: int
    bytes: int

    def fits(self, max_rows: int, max_bytes: int) -> bool:
        return self.rows <= max_rows and self.bytes <= max_bytes


def measure(lookups: list[Lookup]) -> list[Size]:
    """Rows and bytes of each lookup in one job; fails if an id occurs twice.

    A repeated id would multiply facts. The id is what varies in length; every
    other column is counted as text too, so that long attributes are noticed.
    """

    def rows(number: int, lookup: Lookup) -> DataFrame:
        narrow = lookup.narrow
        texts = [F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) + 8 for c in narrow.columns]
        return narrow.select(
            F.lit(number).alias("number"),
            F.col("looked_up_id").cast("string").alias("id"),
            sum(texts, F.lit(0)).cast("bigint").alias("width"),
        )

    together = reduce(DataFrame.unionByName, [rows(i, x) for i, x in enumerate(lookups)])
    by_id = together.groupBy("number", "id").agg(F.count(F.lit(1)).alias("n"), F.sum("width").alias("b"))
    found = (
        by_id.groupBy("number")
        .agg(F.sum("n"), F.sum("b"), F.max(F.when(F.col("n") > 1, F.coalesce("id", F.lit("NULL")))))
        .collect()
    )
    sizes = [Size(0, 0)] * len(lookups)
    for number, count, width, repeated in found:
        if repeated is not None:
            raise ValueError(f"{lookups[number].table_id} is not unique, e.g. {repeated!r}")
        sizes[number] = Size(count, width)
    return sizes


def frequent_ids(facts: DataFrame, column: str, partitions: int) -> DataFrame:
    """Ids that fill more than an even share of one partition, with the number of copies they need.

    Rows are first counted by a hash of the id, in so few groups that next to nothing is shuffled: an id
    above the share lies in a group above it. Only the ids of such groups are counted themselves.
    Fewer than ``partitions`` groups, or ids, can exceed an even share, and the copies add up to less than
    twice that, so what is collected here and broadcast later is bounded by the setting.
    """
    group = F.pmod(F.xxhash64(column), F.lit(_GROUPS * partitions))
    group = F.when(F.col(column).isNotNull(), group)
    counts = facts.groupBy(group.alias("id_group")).count().collect()
    share = sum(r["count"] for r in counts) / partitions
    large = [r["id_group"] for r in counts if r["id_group"] is not None and r["count"] > share]
    rows = []
    if large:
        ids = facts.where(group.isin(large)).groupBy(column).count().where(F.col("count") > share)
        rows = ids.select(F.col(column).cast("string"), F.ceil(F.col("count") / share).cast("bigint")).collect()
    schema = StructType().add("frequent_id", StringType()).add(_COPIES, LongType())
    frequent = facts.sparkSession.createDataFrame(rows, schema)
    return frequent.withColumn("frequent_id", F.col("frequent_id").cast(facts.schema[column].dataType))


def _salted_join(facts: DataFrame, lookup: Lookup, frequent: DataFrame, partitions: int) -> DataFrame:
    """Shuffle join in which a frequent id's rows go to several partitions, each with a copy of its member.

    Rows without id match nothing, but would all meet in one partition; they are spread too.
    """
    spread = F.xxhash64(_ROW)
    salt = (
        F.when(F.col(lookup.fact_id).isNull(), F.pmod(spread, F.lit(partitions).cast("bigint")))
        .when(F.col(_COPIES).isNotNull(), F.pmod(spread, F.col(_COPIES)))
        .otherwise(F.lit(0).cast("bigint"))
    )
    left = facts.join(F.broadcast(frequent), F.col(lookup.fact_id) == F.col("frequent_id"), "left")
    left = left.withColumn(_SALT, salt).drop("frequent_id", _COPIES)
    right = lookup.narrow.join(F.broadcast(frequent), F.col("looked_up_id") == F.col("frequent_id"), "left").select(
        "looked_up_id",
        *lookup.columns,
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.coalesce(F.col(_COPIES), F.lit(1)) - 1)).alias("member_salt"),
    )
    match = (F.col(lookup.fact_id) == F.col("looked_up_id")) & (F.col(_SALT) == F.col("member_salt"))
    if partitions > int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        left, right = left.repartition(partitions, lookup.fact_id, _SALT), right.repartition(partitions, "looked_up_id", "member_salt")
    return left.join(right, match, "left").drop("looked_up_id", _SALT, "member_salt")


def star_lookup(
    facts: DataFrame,
    lookups: list[Lookup],
    max_rows: int = BROADCAST_ROWS,
    max_bytes: int = BROADCAST_BYTES,
    sizes: list[Size] | None = None,
) -> DataFrame:
    """Left join to every lookup; each fact row appears exactly once in the result.

    Small tables come first: their joins need no shuffle, and each replaces an
    id text by what it stands for, which narrows the rows before the shuffles
    that the large tables need. Fact ids are dropped once used. ``facts`` should
    be a scan of written files: rows of frequent ids are spread by their place in
    the scan, which is the same again when a lost task is repeated. ``sizes`` is
    for callers that know them, and that no id occurs twice.
    """
    sizes = measure(lookups) if sizes is None else sizes
    small = [x for x, size in zip(lookups, sizes) if size.fits(max_rows, max_bytes)]
    large = [x for x, size in zip(lookups, sizes) if not size.fits(max_rows, max_bytes)]

    joined = facts.withColumn(_ROW, F.monotonically_increasing_id()) if large else facts
    for lookup in small:
        match = F.col(lookup.fact_id) == F.col("looked_up_id")
        joined = joined.join(F.broadcast(lookup.narrow), match, "left").drop("looked_up_id", lookup.fact_id)
    for lookup in large:
        partitions = partitions_for(facts)
        frequent = frequent_ids(facts, lookup.fact_id, partitions)
        joined = _salted_join(joined, lookup, frequent, partitions).drop(lookup.fact_id)
    return joined.drop(_ROW)
