"""Mixing sources to target weights by hash-threshold histograms.

Every row has a hash of its id. Whole repeats of a source take all its rows; of
what is left of its target, rows below a hash threshold are taken once more. The
threshold comes from a histogram of sizes by source and hash bucket: only the
bucket that holds the boundary is refined, by the next bits of the hash, until no
boundary bucket has two rows of different hash. Rows are then filtered, never sorted,
and thresholds nest: a larger budget takes all that a smaller one takes.

All work is DataFrame operations; the driver sees single numbers only. Sources
may be as many as there are; they are one row each and their order is found by a
range shuffle. A null text has size 0, a null source is a source of its own,
behind all others. Rows with equal ``doc_id`` and text share a hash; if a budget ends among
them, as many as it holds are taken, by numbers that they get where they are counted, and written
down. A null ``doc_id`` is hashed as an empty one. An empty table gives no rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from starloom.llm.tables import free_name, staged, words
from starloom.operators.keys import highest_key, number_new, stage_in_key_order
from starloom.session import new_folder

HASH_BITS, LEVEL_BITS = 60, 10


def size_in_words(text: Column) -> Column:
    """Number of words; 0 for a null text."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    return F.size(words(text)).cast("long")


def row_hash(doc_id: Column, text: Column) -> Column:
    """The first 60 bits of a digest of id and text."""
    parts = F.concat_ws(":", F.coalesce(doc_id.cast("string"), F.lit("")), F.md5(F.coalesce(text.cast("string"), F.lit("")).cast("binary")))
    return F.conv(F.substring(F.md5(parts.cast("binary")), 1, HASH_BITS // 4), 16, 10).cast("long")


def _above(limit: Column, others: int, share: int) -> Column:
    """Whether a weight's part of ``share`` among ``others`` is above ``limit``, in numbers that cannot overflow."""
    wide = lambda x: x.cast("decimal(19,0)")
    return wide(limit) * wide(F.lit(others)) < wide(F.col("weight")) * wide(F.lit(share))


def source_targets(sizes: DataFrame, weights: tuple[int, ...], most: int) -> DataFrame:
    """``source, source_size, target`` from one row ``source, source_size`` for each source.

    Sources in order get the ``weights`` by turns and share the sum of all sizes. A
    target stops at ``most`` times its source's size; the excess is shared again by
    weight among the others, until none is above. Each round is one pass over the
    sources, and needs no more rounds than there are sources that stop.
    """
    spark = sizes.sparkSession
    # In the order of code points, which is that of Spark's strings, null last.
    ordered = sizes.select(
        F.struct(F.col("source").isNull().alias("last"), "source").alias("place"), "source_size", F.lit(None).cast("long").alias("rank")
    )
    placed = stage_in_key_order(ordered, "place", "rank", new_folder(spark, "sources"))
    ranked = number_new(placed, "rank", highest_key(placed, "rank"))
    weight = reduce(
        lambda otherwise, i: F.when(F.pmod(F.col("rank") - 1, F.lit(len(weights))) == i, weights[i]).otherwise(otherwise),
        range(1, len(weights)),
        F.lit(weights[0]),
    )
    ranked = staged(ranked.select(F.col("place.source").alias("source"), "source_size", weight.cast("long").alias("weight")), "weights")
    limit = F.col("source_size") * most
    share, others, stopped = 0, 1, -1
    while True:
        # A source stops if its share of what others leave is above its limit; shares only grow.
        stops = _above(limit, others, share)
        row = ranked.agg(
            F.sum("source_size").alias("all"),
            F.coalesce(F.sum(F.when(stops, limit)), F.lit(0)).alias("limits"),
            F.coalesce(F.sum(F.when(~stops, F.col("weight"))), F.lit(0)).alias("others"),
            F.count_if(stops).alias("stopped"),
        ).first()
        if row["stopped"] == stopped:
            break
        stopped = row["stopped"]
        share, others = (row["all"] or 0) - row["limits"], row["others"]
        if not others:
            break
    stops = _above(limit, others, share)
    target = F.when(stops, limit.cast("double")).otherwise(
        (F.col("weight") * share).cast("double") / F.lit(max(others, 1)).cast("double")
    )
    return ranked.select("source", "source_size", target.alias("target"))


def thresholds(rows: DataFrame, budgets: DataFrame) -> DataFrame:
    """``source, below, also``: rows whose hash is less than ``below``, and ``also`` of those with that hash, come near the source's ``budget``.

    ``rows`` has ``source, hash, size``, ``budgets`` has ``source, budget``. Of the
    two sums next to the budget the nearer one is chosen, the smaller of equals.
    """
    spark = rows.sparkSession
    # The bucket in which the budget ends, as the hash where it begins, and the sum of sizes before it.
    open_ = budgets.select("source", "budget", F.lit(0).cast("long").alias("begin"), F.lit(0).cast("long").alias("before"))
    open_, inside = staged(open_, "budgets"), rows
    done = []
    for width in range(HASH_BITS - LEVEL_BITS, -1, -LEVEL_BITS):
        same = F.col("b.source").eqNullSafe(F.col("r.source"))
        in_bucket = F.shiftright(F.col("r.hash"), width + LEVEL_BITS) == F.shiftright(F.col("b.begin"), width + LEVEL_BITS)
        bounds = open_.select("source", "begin", "before", "budget")
        inside = inside.alias("r").join(bounds.select("source", "begin").alias("b"), same & in_bucket, "left_semi")
        # One row for each source and bucket that has rows: at most 2^LEVEL_BITS for a source.
        histogram = inside.groupBy("source", F.shiftright("hash", width).alias("bucket")).agg(
            F.sum("size").alias("size"), F.count(F.lit(1)).alias("n"), F.min("hash").alias("least"), F.max("hash").alias("greatest")
        )
        h = histogram.alias("h").join(bounds.alias("b"), F.col("h.source").eqNullSafe(F.col("b.source")))
        key = F.struct(F.col("h.source").isNull().alias("none"), F.col("h.source").alias("source"))
        h = h.select(key.alias("key"), "bucket", "h.size", "n", "least", "greatest", "b.before", "b.budget")
        running = "sum(size) over (partition by key order by bucket rows unbounded preceding)"
        h = h.withColumn("upto", F.col("before") + F.expr(running)).withColumn("from", F.col("upto") - F.col("size"))
        # The first bucket whose sum goes beyond the budget; without one all rows fit.
        beyond = h.where(F.col("upto") > F.col("budget"))
        first = beyond.groupBy("key").agg(F.min_by(F.struct("bucket", "from", "upto", "n", "least", "greatest", "budget"), "bucket").alias("f"))
        boundary = staged(
            first.select(F.col("key.source").alias("source"), "f.*").withColumn("single", F.col("least") == F.col("greatest")), "boundaries"
        )
        # One hash is left in the bucket, of rows alike: as many as come nearest.
        each, rest = (F.col("upto") - F.col("from")) / F.col("n"), F.col("budget") - F.col("from")
        some = F.ceil(rest / each - 0.5)
        all_ = some >= F.col("n")
        below = F.when(all_, F.col("least") + 1).otherwise(F.col("least"))
        also = F.when(all_, 0).otherwise(F.greatest(some, F.lit(0)))
        done.append(boundary.where("single").select("source", below.alias("below"), also.cast("long").alias("also")))
        open_ = boundary.where("not single").select(
            "source", "budget", F.shiftleft("bucket", width).alias("begin"), F.col("from").alias("before")
        )
        if open_.isEmpty():
            break
    return reduce(DataFrame.unionByName, done)


def mix_plan(rows: DataFrame, weights: tuple[int, ...], most: int) -> DataFrame:
    """``source, source_size, target, repeats, below, also`` of each source of ``rows``, which has ``source, size, hash``.

    A row is taken ``repeats`` times, and once more if its hash is less than ``below``, or is
    that and the row one of the first ``also``.
    """
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = source_targets(sizes, weights, most)
    repeats = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    targets = staged(targets.withColumn("repeats", repeats), "targets")
    budget = F.col("target") - (F.col("repeats") * F.col("source_size")).cast("double")
    budgets = targets.select("source", budget.alias("budget")).where("budget > 0")
    below = thresholds(rows.select("source", "hash", "size"), budgets)
    plan = targets.alias("t").join(below.alias("b"), F.col("t.source").eqNullSafe(F.col("b.source")), "left")
    none = F.lit(0).cast("long")
    return staged(plan.select("t.*", F.coalesce("b.below", none).alias("below"), F.coalesce("b.also", none).alias("also")), "plan")


def _times(rows: DataFrame, hash_: str, repeats: str, below: str, also: str, group: str, times: str) -> DataFrame:
    """``rows`` with the column ``times``; alike rows of which some are taken get numbers within ``group``."""
    col = lambda c: F.col(f"`{c}`")
    once_more = lambda more: (col(repeats) + F.when(more, 1).otherwise(0)).cast("long")
    split = (col(also) > 0) & (col(hash_) == col(below))
    whole = rows.withColumn(times, once_more(col(hash_) < col(below)))
    alike = rows.where(split)
    if alike.isEmpty():
        return whole
    part, place, number, before = (free_name(rows, n) for n in ("part", "place", "number", "before"))
    # Where a row is among its task's, once and for all.
    alike = staged(alike.withColumns({part: F.spark_partition_id(), place: F.monotonically_increasing_id()}), "alike")
    counts = alike.groupBy(group, part).agg(F.count(F.lit(1)).alias(number))
    # One row for each task and group that has such rows.
    upto = Window.partitionBy(group).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(group, part, F.coalesce(F.sum(number).over(upto), F.lit(0)).alias(before))
    a, c = alike.alias("a"), counts.alias("c")
    same = F.col(f"a.{group}").eqNullSafe(F.col(f"c.{group}")) & (F.col(f"a.{part}") == F.col(f"c.{part}"))
    own = Window.partitionBy(f"a.{group}", f"a.{part}").orderBy(f"a.{place}")
    numbered = a.join(c, same).select("a.*", (F.col(f"c.{before}") + F.row_number().over(own)).alias(number))
    numbered = numbered.withColumn(times, once_more(col(number) <= col(also))).select(whole.columns)
    return whole.where(~F.coalesce(split, F.lit(False))).unionByName(numbered)


def _sizes(docs: DataFrame) -> DataFrame:
    return staged(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            F.col("source").cast("string").alias("source"),
            size_in_words(F.col("text")).alias("size"),
            row_hash(F.col("doc_id"), F.col("text")).alias("hash"),
        ),
        "sizes",
    )


def mixed(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), most: int = 3) -> DataFrame:
    """``doc_id, size, source_size, target, taken`` of every row of ``docs``.

    ``taken`` is the number of words that the mix takes of a row, repeats counted.
    """
    rows = _sizes(docs)
    plan = mix_plan(rows, weights, most)
    found = rows.alias("r").join(plan.alias("p"), F.col("r.source").eqNullSafe(F.col("p.source")))
    found = found.select("doc_id", "size", "hash", "r.source", "source_size", "target", "repeats", "below", "also")
    found = _times(found, "hash", "repeats", "below", "also", "source", "times")
    return found.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("times")).alias("taken"))


def mix_documents(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), most: int = 3) -> DataFrame:
    """Each row of ``docs`` as often as the mix takes it, from none to ``most`` times, with all its columns."""
    plan = mix_plan(_sizes(docs), weights, most)
    source, hash_, repeats, below, also, times, copy = (
        free_name(docs, f"mix_{n}") for n in ("source", "hash", "repeats", "below", "also", "times", "copy")
    )
    plan = plan.select(*(F.col(c).alias(n) for c, n in (("source", source), ("repeats", repeats), ("below", below), ("also", also))))
    given = docs.join(plan, docs["source"].cast("string").eqNullSafe(F.col(source)))
    given = given.withColumn(hash_, row_hash(docs["doc_id"], docs["text"]))
    given = _times(given, hash_, repeats, below, also, source, times)
    # No sequence runs down from 1 to 0, hence the filter.
    copies = F.filter(F.sequence(F.lit(1), F.lit(most).cast("long")), lambda i: i <= F.col(times))
    return given.withColumn(copy, F.explode(copies)).select(*(F.col(f"`{c}`") for c in docs.columns))
