"""Members, keys, lookups and upserts on small made-up rows."""

import random

import pytest
from pyspark.sql import Window, functions as F

from fixtures import plan, rows
from starloom.operators.keys import highest_key, number_new, stage_in_key_order
from starloom.operators.lookup import Lookup, Size, frequent_ids, measure, star_lookup
from starloom.operators.members import latest_members
from starloom.operators.upsert import DuplicateKeys, duplicate_keys, require_unique, upsert, upsert_columns


# -- members ------------------------------------------------------------------


def test_one_member_per_id_with_the_latest_attributes(spark):
    sales = spark.createDataFrame(
        [("a", "old", "x", 1), ("a", "new", "y", 2), ("a", "NEW", "z", 2), ("b", "only", None, None), (None, "n", "n", 9)],
        "id string, name string, town string, day int",
    )
    found = latest_members(sales, "id", ["name", "town"], F.col("day"))
    assert rows(found) == [("a", "new", "y"), ("b", "only", None)]


def test_undated_rows_are_oldest(spark):
    sales = spark.createDataFrame([("a", "z", None), ("a", "b", 1)], "id string, name string, day int")
    assert rows(latest_members(sales, "id", ["name"], F.col("day"))) == [("a", "b")]


def test_first_aggregation_over_the_lines_hashes_and_combines(spark):
    sales = spark.createDataFrame([("a", "z", 1)], "id string, name string, day int")
    text = plan(latest_members(sales, "id", ["name"], F.col("day"))).split("== Physical Plan ==")[1]
    lines = [line for line in text.splitlines() if "Aggregate(" in line]
    # Read from the scan upwards: partial and final hash aggregation over pairs come first.
    assert "HashAggregate" in lines[-1] and "partial_max" in lines[-1]
    assert "HashAggregate" in lines[-2]


# -- keys ---------------------------------------------------------------------


def numbered(members, path, highest=0):
    staged = stage_in_key_order(members, "id", "k", path)
    return number_new(staged, "k", F.lit(highest).cast("bigint"))


@pytest.mark.parametrize("partitions", [1, 7])
def test_keys_equal_a_global_row_number(spark, folder, partitions):
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ids = spark.range(20000).select(F.sha2(F.col("id").cast("string"), 256).alias("id"))
        members = ids.withColumn("k", F.lit(None).cast("bigint"))
        found = numbered(members, f"{folder}/staged")
        wanted = ids.withColumn("k", F.row_number().over(Window.orderBy("id")).cast("bigint"))
        assert found.exceptAll(wanted.select(found.columns)).isEmpty()
        assert found.count() == 20000
        assert spark.read.parquet(f"{folder}/staged").select("key_range").distinct().count() == partitions
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_known_members_keep_their_keys_and_new_ones_follow(spark, folder):
    members = spark.createDataFrame(
        [("d", None), ("a", 3), ("c", None), ("b", 1), ("aa", None)], "id string, k bigint"
    )
    found = numbered(members.repartition(5), f"{folder}/staged", highest=3)
    assert rows(found, "id", "k") == [("a", 3), ("aa", 4), ("b", 1), ("c", 5), ("d", 6)]


def test_nothing_new(spark, folder):
    members = spark.createDataFrame([("a", 1)], "id string, k bigint")
    assert rows(numbered(members, f"{folder}/one", 1), "id", "k") == [("a", 1)]
    assert rows(numbered(members.where("false"), f"{folder}/none", 1)) == []


def test_keys_stay_when_the_result_is_computed_again(spark, folder):
    members = spark.range(1000).select(F.col("id").cast("string"), F.lit(None).cast("bigint").alias("k"))
    found = numbered(members.repartition(6), f"{folder}/staged")
    assert rows(found, "id", "k") == rows(found, "id", "k")


def test_staging_leaves_the_members_as_they_are(spark, folder):
    members = spark.createDataFrame([("a", None)], "id string, k bigint")
    for n in range(2):
        assert rows(numbered(members, f"{folder}/{n}"), "id", "k") == [("a", 1)]
    assert members.columns == members.schema.fieldNames()


def test_highest_key_of_an_empty_table_is_zero(spark):
    empty = spark.createDataFrame([], "k bigint")
    assert spark.range(1).select(highest_key(empty, "k")).first()[0] == 0
    assert spark.range(1).select(highest_key(spark.range(5).toDF("k"), "k")).first()[0] == 4


# -- lookups ------------------------------------------------------------------


@pytest.fixture(scope="module")
def star(spark, tmp_path_factory):
    """Facts of which a third share one id, a third have none and the rest spread out; all lines of a kind are equal."""
    path = str(tmp_path_factory.mktemp("facts") / "facts")
    n = F.col("id")
    spark.range(3000).select(
        F.when(n % 3 == 0, F.lit("hot")).when(n % 3 == 1, F.lit(None)).otherwise((n % 400).cast("string")).alias("x_id"),
        F.when(n % 5 == 0, F.lit("hot")).otherwise((n % 7).cast("string")).alias("y_id"),
        F.lit(1).cast("bigint").alias("amount"),
    ).write.parquet(path)
    facts = spark.read.parquet(path)
    x = spark.createDataFrame([("hot", 1000)] + [(str(i), i) for i in range(0, 400, 2)], "id string, x_key bigint")
    y = spark.createDataFrame([("hot", 2000)] + [(str(i), i) for i in range(5)], "id string, y_key bigint")
    return facts, [Lookup(x, "id", "x_id", ("x_key",)), Lookup(y, "id", "y_id", ("y_key",))]


def expected(star):
    facts, (x, y) = star
    xs = {r[0]: r[1] for r in x.table.collect()}
    ys = {r[0]: r[1] for r in y.table.collect()}
    found = [(r["amount"], xs.get(r["x_id"]), ys.get(r["y_id"])) for r in facts.collect()]
    return sorted(found, key=lambda r: [(v is not None, v) for v in r])


def test_small_tables_are_broadcast_without_a_shuffle(spark, star):
    facts, lookups = star
    found = star_lookup(facts, lookups)
    assert rows(found, "amount", "x_key", "y_key") == expected(star)
    text = plan(found)
    assert text.count("BroadcastHashJoin") == 2 and "hashpartitioning" not in text


@pytest.mark.parametrize("limits", [(0, 1 << 30), (50, 1 << 30), (10**6, 10)])
def test_large_tables_give_the_same_rows(spark, star, limits):
    facts, lookups = star
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = star_lookup(facts, lookups, *limits)
        assert rows(found, "amount", "x_key", "y_key") == expected(star)
        assert "salt" in plan(found)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_frequent_and_missing_ids_are_spread(spark, star):
    facts, lookups = star
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        found = star_lookup(facts, lookups[:1], 0)
        sizes = [r[0] for r in found.groupBy(F.spark_partition_id()).count().select("count").collect()]
        # Unspread, one partition would hold at least a third of the 3,000 rows.
        assert sum(sizes) == 3000 and max(sizes) < 600
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_frequent_ids_and_their_copies_are_bounded(spark, star):
    facts, _ = star
    found = {r["frequent_id"]: r["copies"] for r in frequent_ids(facts, "x_id", 64).collect()}
    assert found == {"hot": 22}
    even = spark.range(640).select((F.col("id") % 32).cast("string").alias("i"))
    copies = [r["copies"] for r in frequent_ids(even, "i", 64).collect()]
    assert len(copies) < 64 and sum(copies) < 128


def test_repeated_id_is_refused(spark):
    table = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "id string, k bigint")
    with pytest.raises(ValueError, match="'a'"):
        measure([Lookup(table, "id", "f", ("k",))])


def test_measure(spark):
    table = spark.createDataFrame([("abc", 10)], "id string, k bigint")
    none = Lookup(table.where("false"), "id", "f", ("k",))
    assert measure([none, Lookup(table, "id", "f", ("k",))]) == [Size(0, 0), Size(1, 3 + 8 + 2 + 8)]


# -- upserts ------------------------------------------------------------------


def test_upsert_against_a_dictionary(spark):
    rng = random.Random(7)

    def table(n):
        keys = {(rng.choice([None, 1, 2, 3]), rng.choice([None, "a", "b"])) for _ in range(n)}
        return {k: rng.randrange(100) for k in keys}

    schema = "a int, b string, v int"
    for _ in range(5):
        old, new = table(6), table(6)
        target = spark.createDataFrame([(*k, v) for k, v in old.items()], schema)
        source = spark.createDataFrame([(v, *k) for k, v in new.items()], "v int, a int, b string")
        once = upsert(target, source, ["a", "b"])
        assert {(r["a"], r["b"]): r["v"] for r in once.collect()} == {**old, **new}
        assert once.count() == len({**old, **new})
        assert rows(upsert(once, source, ["a", "b"])) == rows(once)


def test_null_keys_match(spark):
    target = spark.createDataFrame([(None, "n"), (1, "x")], "k int, v string")
    source = spark.createDataFrame([(None, "N")], "k int, v string")
    found = upsert(target, source, ["k"])
    assert rows(found) == [(None, "N"), (1, "x")]
    assert "NestedLoop" not in plan(found)


def test_partial_columns(spark):
    target = spark.createDataFrame([(1, "a", 10, "t"), (2, "b", 20, "t")], "k int, name string, v int, note string")
    source = spark.createDataFrame([(2, "B", None, "s"), (3, "C", 30, "s")], "k int, name string, v int, note string")
    found = upsert_columns(target, source, ["k"], update=["v"], insert=["name", "v"])
    # A NULL in the source overwrites; a column that is not inserted is NULL in a new row.
    assert rows(found) == [(1, "a", 10, "t"), (2, "b", None, "t"), (3, "C", 30, None)]
    assert found.schema == target.schema


def test_partial_columns_never_change_keys_and_need_not_be_in_the_source(spark):
    target = spark.createDataFrame([(1, "a", 10)], "k int, name string, v bigint")
    source = spark.createDataFrame([(1, 11), (4, 44)], "k int, v int")
    found = upsert_columns(target, source, ["k"], update=["k", "v"])
    assert rows(found) == [(1, "a", 11), (4, None, 44)]


def test_merges_mind_names_and_repeats(spark):
    target = spark.createDataFrame([(1, 10, "a")], "k int, v int, note string")
    source = spark.createDataFrame([(1, 11)], "K int, V int")
    assert rows(upsert_columns(target, source, ["k"], update=["v"])) == [(1, 11, "a")]
    assert rows(upsert(target.drop("note"), source, ["K"])) == [(1, 11)]
    for update, insert in ((["vv"], None), (["note"], None), (["v"], ["w"])):
        with pytest.raises(ValueError, match="no such column"):
            upsert_columns(target, source, ["k"], update=update, insert=insert)
    with pytest.raises(ValueError, match="no such column"):
        upsert_columns(target, source.drop("V"), ["k"], update=["v"])
    with pytest.raises(ValueError, match="no such column"):
        upsert(target, source, ["k"])
    for merge in (lambda s: upsert(target.drop("note"), s, ["k"]), lambda s: upsert_columns(target, s, ["k"], ["v"])):
        with pytest.raises(DuplicateKeys):
            merge(source.union(source))


def test_touched_keys_without_a_source_row_go(spark):
    target = spark.createDataFrame([(1, 10), (2, 20), (None, 30)], "k int, v int")
    touched = spark.createDataFrame([(1,), (None,)], "k int")
    assert rows(upsert(target, target.where("k = 1"), ["k"], touched=touched)) == [(1, 10), (2, 20)]


def test_duplicate_source_keys_are_named(spark):
    source = spark.createDataFrame([(1, None), (1, None), (2, "x")], "a int, b string")
    assert rows(duplicate_keys(source, ["a", "b"])) == [(1, None, 2)]
    with pytest.raises(DuplicateKeys, match="a=1, b=None"):
        require_unique(source, ["a", "b"])
    require_unique(source.where("a = 2"), ["a", "b"])
