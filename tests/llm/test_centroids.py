import hashlib

import numpy as np
import pytest
from cases import SMALL
from compare import assert_same, connect

from starloom.llm.centroids import assign, centroid_clusters, clusters_with_inertia
from starloom.llm.oracle import ORACLE
from starloom.llm.queries import QUERIES, ship


def table(spark, rows):
    ship(spark)
    return spark.createDataFrame(
        [(i, e, 3, "x") for i, e in rows], "vec_id long, embedding array<double>, cluster int, distance string"
    )


def expected(rows, k, rounds, width, scale):
    """Every distance by Python's whole numbers."""
    kept = [
        (i, [int(np.floor(scale * x)) for x in e])
        for i, e in rows
        if e is not None and len(e) == width and all(x is not None and np.isfinite(x) for x in e)
    ]
    digest = lambda i: (i is None, hashlib.sha256(f"1:{i}".encode()).hexdigest() if i is not None else "")
    centroids = [e for _, e in sorted(kept, key=lambda r: (digest(r[0]), r[1]))[:k]]
    for turn in range(rounds + 1):
        near = [min((sum((a - b) ** 2 for a, b in zip(e, c)), j) for j, c in enumerate(centroids)) for _, e in kept]
        if turn < rounds:
            for j in range(len(centroids)):
                own = [e for (_, e), (_, c) in zip(kept, near) if c == j]
                if own:
                    centroids[j] = [sum(column) // len(own) for column in zip(*own)]
    total = sum(d for d, _ in near)
    by_cluster = {j: sum(d for d, c in near if c == j) for j in range(len(centroids))}
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(((i, j, d, by_cluster[j], total, sha[j]) for (i, _), (d, j) in zip(kept, near)), key=str)


def bag(found):
    return sorted((tuple(r) for r in found.collect()), key=str)


def made_rows():
    rng = np.random.default_rng(5)
    rows = [(i, (rng.normal(0, 0.3, 4) + rng.integers(0, 5)).tolist()) for i in range(400)]
    rows += [(1000 + i % 3, [0.5, -0.25, 1.0, 2.0]) for i in range(200)]  # a third alike, ids that repeat
    rows += [(5000, None), (5001, [1.0]), (5002, [1.0, None, 0.0, 0.0]), (5003, [float("nan")] * 4), (5004, [float("-inf")] * 4)]
    return rows + [(5005, []), (5006, [1.0] * 5), (None, [0.1] * 4), (None, [9.0] * 4), (5007, [-1e-9] * 4)]


@pytest.mark.parametrize("k, rounds", [(16, 3), (5, 8), (1, 2), (3, 0)])
def test_against_every_distance(spark, k, rounds):
    rows = made_rows()
    found = centroid_clusters(table(spark, rows).repartition(5), k, rounds, width=4)
    assert bag(clusters_with_inertia(found)) == expected(rows, k, rounds, 4, 64)


def test_bounds_spare_distances(spark):
    rng = np.random.default_rng(6)
    rows = [(i, (rng.normal(0, 0.2, 8) + 6 * (i % 6)).tolist()) for i in range(1200)]
    found = centroid_clusters(table(spark, rows), 12, 6, width=8)
    assert found.computed[0] == 12 * 1200 and sum(found.computed[4:]) < 0.4 * 3 * 12 * 1200


def test_a_bound_uses_the_total_displacement():
    # The centroids go out and come back: after that no bound is loosened at all, although each has drifted far.
    out, back = [[0, 0], [100, 0]], [[40, 0], [60, 0]]
    x = np.array([[30, 0], [90, 0]])
    known, _, _ = assign(x, np.array([out]), None)
    known, distance, computed = assign(x, np.array([out, back, out]), known)
    assert computed == 0 and distance.tolist() == [-1, -1] and known.cluster.tolist() == [0, 1]


def test_ties_go_to_the_smaller_number(spark):
    rows = [(i, [float(x), 0.0]) for i, x in enumerate([0, 2, 1, 1, 1, -1, 3])]
    for k in (2, 3, 7):
        found = centroid_clusters(table(spark, rows), k, 3, width=2)
        assert bag(clusters_with_inertia(found)) == expected(rows, k, 3, 2, 64)


def test_small_tables(spark):
    assert bag(clusters_with_inertia(centroid_clusters(table(spark, [])))) == []
    assert bag(clusters_with_inertia(centroid_clusters(table(spark, [(1, None), (2, [1.0])])))) == []
    one = [(7, [0.5] * 64)]
    assert bag(clusters_with_inertia(centroid_clusters(table(spark, one)))) == expected(one, 16, 3, 64, 64)


def test_too_large_components_are_refused(spark):
    with pytest.raises(Exception, match="a component is beyond"):
        centroid_clusters(table(spark, [(1, [1e30, 0.0])]), width=2)


def test_whole_table(spark):
    con = connect(SMALL)
    assert assert_same(QUERIES["op12_centroids"](spark, SMALL), con, ORACLE["op12_centroids"]) > 0
