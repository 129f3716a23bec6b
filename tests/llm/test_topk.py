import math

import numpy as np
import pytest
from cases import SMALL, bag
from compare import assert_same, connect

from starloom.llm.oracle import ORACLE
from starloom.llm.queries import QUERIES, ship
from starloom.llm.topk import top_k

QUERY = "vec_id % 100 = 0"


def table(spark, rows):
    ship(spark)
    exact = [(i, e and [x if x is None else float(x) for x in e], 1, "x") for i, e in rows]
    return spark.createDataFrame(exact, "vec_id long, embedding array<float>, label int, score string")


def expected(rows, k):
    kept = [
        (i, [math.floor(1024 * float(np.float32(x))) for x in e])
        for i, e in rows
        if i is not None and e is not None and all(x is not None and math.isfinite(x) for x in e)
    ]
    out = []
    for i, q in kept:
        if i % 100 == 0:
            found = sorted((-sum(a * b for a, b in zip(q, c)), j) for j, c in kept if j != i)[:k]
            out += [(i, rank + 1, j, -s) for rank, (s, j) in enumerate(found)]
    return sorted(out)


def made_rows():
    rng = np.random.default_rng(8)
    rows = [(i, rng.normal(0, 1, 6).tolist()) for i in range(450)]
    rows += [(1000 + i, [0.5, 0.25, -0.125, 1.0, 0.0, 2.0]) for i in range(230)]  # ties, queries among them
    rows += [(2000, None), (2001, [1.0, None, 0, 0, 0, 0]), (2100, [float("nan")] * 6), (2101, [float("inf")] * 6)]
    return rows + [(None, [9.0] * 6), (2200, [1.0, 2.0]), (2201, [3.0] * 9), (2300, []), (5, [5.0] * 6), (5, [5.0] * 6)]


@pytest.mark.parametrize("k, block_bytes", [(10, 16 << 20), (1, 200), (3000, 16 << 20)])
def test_against_all_pairs(spark, k, block_bytes):
    rows = made_rows()
    found = top_k(table(spark, rows), QUERY, k, block_bytes)
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(tuple(r) for r in found.collect()) == expected(rows, k)


def test_ranges_that_do_not_divide_evenly(spark):
    rng = np.random.default_rng(3)
    rows = [(i, (rng.normal(0, 1, 8) * 10.0 ** rng.integers(-2, 3)).tolist()) for i in range(2500)]
    found = top_k(table(spark, rows), QUERY)
    assert sorted(tuple(r) for r in found.collect()) == expected(rows, 10)


def test_products_beyond_floating_point(spark):
    rows = [(0, [2.0**20, 1.0]), (1, [2.0**20, 1.0]), (2, [2.0**20, 1.0009765625]), (3, [-(2.0**20), 1.0])]
    assert sorted(tuple(r) for r in top_k(table(spark, rows), QUERY, 2).collect()) == expected(rows, 2)


def test_whole_table(spark):
    con = connect(SMALL)
    assert assert_same(QUERIES["op9_top_k"](spark, SMALL), con, ORACLE["op9_top_k"]) > 0


def test_small_tables(spark):
    assert top_k(table(spark, []), QUERY).count() == 0
    assert top_k(table(spark, [(1, [1.0]), (2, [1.0])]), QUERY).count() == 0
    assert top_k(table(spark, [(100, [1.0])]), QUERY).count() == 0
    assert bag(top_k(table(spark, [(100, [1.0]), (7, [-1.0])]), QUERY)) == [(100, 1, 7, -(1024**2))]


def test_a_third_of_the_rows_alike_and_many_queries(spark, monkeypatch):
    from starloom.llm import topk

    monkeypatch.setattr(topk, "SCORES_AT_ONCE", 40)
    monkeypatch.setattr(topk, "QUERIES_AT_ONCE", 7)
    rng = np.random.default_rng(12)
    rows = [(i * 10, rng.integers(-3, 4, 3).tolist()) for i in range(200)] + [(2001 + i, [1.0, 1.0, 1.0]) for i in range(100)]
    docs = table(spark, [rows[i] for i in rng.permutation(len(rows))]).repartition(3)
    assert sorted(tuple(r) for r in top_k(docs, QUERY, 4).collect()) == expected(rows, 4)
    # No task passes on more than k ties for a query.
    vectors = topk.valid_vectors(docs)
    same = np.full((5, 3), 1024.0)
    scorer = topk.Scorer(np.arange(5) * -1 - 1, same)
    out = vectors.mapInArrow(topk._survivors(scorer, np.full(5, 3 * 1024**2), 4), "q long, query_id long, vec_id long, score long")
    assert out.where(f"score = {3 * 1024**2}").groupBy("q").count().agg({"count": "max"}).first()[0] <= 4 * 3
