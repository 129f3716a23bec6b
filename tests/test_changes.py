"""Change logs and differences of extracts against plain Python."""

import itertools
import random

import pytest

from fixtures import plan, rows
from starloom.operators.changes import cdc_apply, extract_diff, last_changes, live_rows
from starloom.operators.upsert import DuplicateKeys

LOG = "k string, v long, seq long, op string"


def log(spark, *changes):
    return spark.createDataFrame(list(changes), LOG)


def by_hand(changes):
    """Live rows after the changes, applied one by one in the order of their sequence."""
    state = {}
    for k, v, _, op in sorted(changes, key=lambda c: (c[2], c[3] == "D")):
        if op == "D":
            state.pop(k, None)
        else:
            state[k] = v
    return sorted(state.items(), key=str)


CHANGES = [
    ("a", 1, 1, "I"), ("b", 2, 2, "I"), ("a", 3, 3, "U"), ("b", None, 4, "D"), (None, 5, 5, "I"), ("c", 6, 6, "I"), ("c", None, 7, "D"), ("c", 8, 8, "I"),
    (None, 9, 9, "U"), ("d", None, 10, "D"), ("e", None, 11, "U"),
]


@pytest.mark.parametrize("seed", range(4))
def test_any_order_and_repeats_give_the_same_state(spark, seed):
    rng = random.Random(seed)
    changes = CHANGES + rng.choices(CHANGES, k=6)
    rng.shuffle(changes)
    cut = rng.randrange(1, len(changes))
    state = log(spark)
    for batch in (changes[:cut], changes[cut:], changes[:3]):
        state = cdc_apply(state, log(spark, *batch), ["k"], "seq", "op")
    assert sorted(map(tuple, live_rows(state, "op").select("k", "v").collect()), key=str) == by_hand(CHANGES)
    assert state.count() == len({c[0] for c in CHANGES})


def test_a_late_change_does_not_bring_back_a_deleted_row(spark):
    state = cdc_apply(log(spark), log(spark, ("a", None, 5, "D")), ["k"], "seq", "op")
    state = cdc_apply(state, log(spark, ("a", 1, 4, "U")), ["k"], "seq", "op")
    assert rows(live_rows(state, "op")) == [] and rows(state) == [("a", None, 5, "D")]
    state = cdc_apply(state, log(spark, ("a", 2, 6, "I")), ["k"], "seq", "op")
    assert rows(live_rows(state, "op")) == [("a", 2, 6)]


def test_equal_sequences_do_not_depend_on_the_order(spark):
    ties = [("a", 1, 1, "U"), ("a", 2, 1, "U"), ("b", 1, 1, "U"), ("b", None, 1, "D")]
    for order in itertools.permutations(ties):
        assert rows(last_changes(log(spark, *order).repartition(3), ["k"], "seq", "op")) == [("a", 2, 1, "U"), ("b", None, 1, "D")]


def test_columns_and_sequences_are_checked(spark):
    with pytest.raises(ValueError, match="columns"):
        cdc_apply(log(spark), log(spark).drop("v"), ["k"], "seq", "op")
    with pytest.raises(Exception, match="a change without seq"):
        last_changes(log(spark, ("a", 1, None, "U")), ["k"], "seq", "op").collect()


def test_a_small_log_leaves_a_large_state_unshuffled(spark):
    state = spark.range(200_000).selectExpr("cast(id as string) as k", "id as v", "0L as seq", "'I' as op")
    found = cdc_apply(state, log(spark, ("7", 0, 1, "U"), ("9", 0, 1, "D")), ["k"], "seq", "op")
    assert live_rows(found, "op").count() == 199_999
    assert "CartesianProduct" not in plan(found) and "BroadcastNestedLoopJoin" not in plan(found)


def extract(spark, *lines):
    return spark.createDataFrame(list(lines), "id long, part string, name string, price double")


def test_differences_of_two_extracts(spark):
    before = extract(spark, (1, "a", "x", 1.0), (1, "b", None, 2.0), (2, None, "z", None), (3, "c", "gone", 1.0), (None, "n", "same", 1.0))
    after = extract(spark, (1, "a", "x", 1.0), (1, "b", "", 2.0), (2, None, "z", 0.0), (4, "d", None, None), (None, "n", "same", 1.0))
    assert rows(extract_diff(before, after, ["id", "part"])) == [
        (1, "b", "", 2.0, "U"), (2, None, "z", 0.0, "U"), (3, "c", "gone", 1.0, "D"), (4, "d", None, None, "I"),
    ]
    assert rows(extract_diff(before, before, ["id", "part"])) == []
    assert [r[-1] for r in rows(extract_diff(extract(spark), after, ["id", "part"]))] == ["I"] * 5
    assert [r[-1] for r in rows(extract_diff(before, extract(spark), ["id", "part"]))] == ["D"] * 5


def test_a_difference_applied_gives_the_later_extract(spark):
    rng = random.Random(5)
    draw = lambda: [(i, "p", rng.choice(["x", None]), float(rng.randrange(2))) for i in rng.sample(range(40), 25)]
    one, two = draw(), draw()
    state = extract(spark, *one).selectExpr("*", "1L as seq", "'I' as op")
    changes = extract_diff(extract(spark, *one), extract(spark, *two), ["id", "part"]).selectExpr("id", "part", "name", "price", "2L as seq", "op")
    assert rows(live_rows(cdc_apply(state, changes, ["id", "part"], "seq", "op"), "op").drop("seq")) == rows(extract(spark, *two))


def test_extracts_are_checked(spark):
    one = extract(spark, (1, "a", "x", 1.0))
    with pytest.raises(DuplicateKeys):
        extract_diff(one.union(one), one, ["id", "part"])
    with pytest.raises(ValueError, match="columns"):
        extract_diff(one, one.drop("price"), ["id"])
    with pytest.raises(ValueError, match="a column op"):
        extract_diff(one.withColumnRenamed("name", "op"), one.withColumnRenamed("name", "op"), ["id"])
