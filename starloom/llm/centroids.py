"""Centroid clustering (Lloyd's rounds) that skips distances by ns-bounds.

For each vector an upper bound of the distance to its own centroid and a lower bound
of the distance to every centroid are kept, each with the round in which it was
computed exactly. All rounds' centroids are retained, so a bound is loosened by the
norm of its centroid's *total* displacement since that round, which by the triangle
inequality is never more than the sum of the drifts between rounds. If a vector's lower
bounds all exceed its upper bound, it stays where it is without any distance. If not, its
own distance is computed, then the distances to the centroids whose bounds still
fail, and the vector goes to the nearest of those by whole numbers, ties to the smaller
number. Bounds are floating-point and leave room for rounding; they decide only what is
not computed, so that the clusters are those of computing everything.

Vectors and bounds are one table that each round reads and writes anew without a
shuffle. A task adds up its vectors by cluster and leaves one row for each cluster in the
same table, so that a round takes a single pass; what reaches the driver is one number
for each cluster and component. The history has ``rounds + 1`` times ``k`` vectors.

Components are floor(scale * x). A vector that is null, has another number of components,
or a component that is null or not finite, takes no part. Rows that repeat count each by
itself. The first centroids are the vectors with the smallest SHA-256 digest of
``seed:vec_id``; of equal ids the smaller vector comes first, and rows without id come
last, but take part. Fewer vectors than ``k`` give fewer centroids, none no rows. An
empty cluster's centroid stays. Components beyond 2^27 either way raise an error, since
squared distances would leave 64 bits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from starloom.llm.tables import drop_folder, list_parts
from starloom.session import new_folder
from starloom.sources.files import read_parquet

GREATEST = 1 << 27
SLACK = 1e-12  # room for rounding in bounds
_STATE = (
    "vec_id long, components array<int>, cluster int, upper double, upper_round int, "
    "lower array<double>, lower_round array<int>, distance long, computed int, sums array<long>"
)


@dataclass
class Clusters:
    """``members`` has ``vec_id, cluster, distance`` (squared); ``centroids`` those they were last assigned to."""

    members: DataFrame
    centroids: np.ndarray
    computed: list[int]  # distances computed in each pass; without bounds it is k for each vector


def whole_vectors(table: DataFrame, width: int, scale: int) -> DataFrame:
    """``vec_id, components`` of the vectors that take part."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = table.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    rows = rows.where(F.col("embedding").isNotNull() & (F.size("embedding") == width) & finite)

    def whole(x):
        scaled = F.floor(F.lit(float(scale)) * x)
        too_large = F.raise_error(F.lit(f"a component is beyond {GREATEST} either way"))
        return F.when(F.abs(x) <= GREATEST // scale, scaled).otherwise(too_large).cast("int")

    return rows.select("vec_id", F.transform("embedding", whole).alias("components"))


def first_centroids(vectors: DataFrame, k: int, seed: int) -> np.ndarray:
    """The ``k`` vectors whose digests come first, in the order of the digests."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")).cast("binary"), 256)
    found = vectors.orderBy(F.asc_nulls_last(digest), "components").limit(k).select("components").collect()
    return np.array([r["components"] for r in found], np.int64)


@dataclass
class Bounds:
    """What is known of a batch of vectors; a row for each."""

    cluster: np.ndarray
    upper: np.ndarray
    upper_round: np.ndarray
    lower: np.ndarray
    lower_round: np.ndarray


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    difference = a - b
    return (difference * difference).sum(-1)


def displacements(history: np.ndarray) -> np.ndarray:
    """How far each centroid is now, at most, from where it was in each round."""
    return np.sqrt(squared(history[-1][None], history).astype(float)) * (1 + SLACK)


def assign(x: np.ndarray, history: np.ndarray, known: Bounds | None) -> tuple[Bounds, np.ndarray, int]:
    """Bounds after the round whose centroids are last in ``history``, exact distances where computed (else -1), and how many were."""
    now, centroids = len(history) - 1, history[-1]
    n, k = len(x), len(centroids)
    if known is None:
        exact = np.stack([squared(x, c) for c in centroids], 1)
        cluster = exact.argmin(1)
        roots, at = np.sqrt(exact.astype(float)), np.arange(n)
        rounds = np.full((n, k), now, np.int32)
        return Bounds(cluster, roots[at, cluster] * (1 + SLACK), rounds[:, 0].copy(), roots * (1 - SLACK), rounds), exact[at, cluster], n * k

    moved = displacements(history)
    lower = known.lower - moved[known.lower_round, np.arange(k)]
    upper = known.upper + moved[known.upper_round, known.cluster]
    lower[np.arange(n), known.cluster] = np.inf  # its own centroid is no rival
    distance = np.full(n, -1, np.int64)
    rows = np.flatnonzero((lower <= upper[:, None]).any(1))
    own = squared(x[rows], centroids[known.cluster[rows]])
    computed = len(rows)
    distance[rows] = own
    tight = np.sqrt(own.astype(float))
    known.upper[rows], known.upper_round[rows] = tight * (1 + SLACK), now
    # Pairs of a vector and a centroid whose bound fails against the exact distance too.
    which, rival = np.nonzero(lower[rows] <= (tight * (1 + SLACK))[:, None])
    if not len(which):
        return known, distance, computed
    exact = squared(x[rows[which]], centroids[rival])
    computed += len(exact)
    known.lower[rows[which], rival] = np.sqrt(exact.astype(float)) * (1 - SLACK)
    known.lower_round[rows[which], rival] = now
    # The nearest of each vector's own centroid and its rivals, ties to the smaller number.
    everyone = np.concatenate([np.arange(len(rows)), which])
    number = np.concatenate([known.cluster[rows], rival])
    value = np.concatenate([own, exact])
    order = np.lexsort((number, value, everyone))
    best = order[np.unique(everyone[order], return_index=True)[1]]
    changed = number[best] != known.cluster[rows]
    moving, target = rows[changed], best[changed]
    old = known.cluster[moving]
    known.lower[moving, old] = tight[changed] * (1 - SLACK)
    known.lower_round[moving, old] = now
    known.cluster[moving] = number[target]
    known.upper[moving] = np.sqrt(value[target].astype(float)) * (1 + SLACK)
    distance[moving] = value[target]
    return known, distance, computed


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return list_parts(column)[0].reshape(-1, width)


def _lists(matrix: np.ndarray, kind: pa.DataType) -> pa.Array:
    n, width = matrix.shape
    offsets = pa.array(np.arange(n + 1, dtype=np.int32) * width)
    return pa.ListArray.from_arrays(offsets, pa.array(matrix.ravel(), kind))


def _round(history: np.ndarray, last: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """One pass over the state; after the vectors of a task come its sums, a row for each cluster with vectors."""
    k, width = history.shape[1:]
    kinds = {
        "vec_id": pa.int64(), "components": pa.list_(pa.int32()), "cluster": pa.int32(), "upper": pa.float64(),
        "upper_round": pa.int32(), "lower": pa.list_(pa.float64()), "lower_round": pa.list_(pa.int32()),
        "distance": pa.int64(), "computed": pa.int32(), "sums": pa.list_(pa.int64()),
    }

    def rows(n: int, **columns: pa.Array) -> pa.RecordBatch:
        made = [columns[c].cast(t) if c in columns else pa.nulls(n, t) for c, t in kinds.items()]
        return pa.RecordBatch.from_arrays(made, list(kinds))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((k, width + 2), np.int64)  # components, vectors, distances computed
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column("components"), width).astype(np.int64)
            known = None
            if "lower" in batch.schema.names:
                column = lambda name: np.array(batch.column(name))
                wide = lambda name: _matrix(batch.column(name), k).copy()
                known = Bounds(column("cluster"), column("upper"), column("upper_round"), wide("lower"), wide("lower_round"))
            bounds, distance, computed = assign(x, history, known)
            if last:
                unknown = distance < 0
                distance[unknown] = squared(x[unknown], history[-1][bounds.cluster[unknown]])
            own = bounds.cluster
            for c in np.unique(own):
                sums[c, :width] += x[own == c].sum(0)
            sums[:, width] += np.bincount(own, minlength=k)
            sums[own[0], width + 1] += computed
            # The last pass leaves out what no further round needs.
            state = {} if last else {
                "components": batch.column("components"), "upper": pa.array(bounds.upper), "upper_round": pa.array(bounds.upper_round),
                "lower": _lists(bounds.lower, pa.float64()), "lower_round": _lists(bounds.lower_round, pa.int32()),
            }
            yield rows(len(x), vec_id=batch.column("vec_id"), cluster=pa.array(own), distance=pa.array(distance), **state)
        full = np.flatnonzero(sums[:, width])
        if len(full):
            yield rows(len(full), cluster=pa.array(full), sums=_lists(sums[full], pa.int64()))

    return run


def _totals(state: DataFrame, k: int, size: int) -> list[list[int]]:
    """The tasks' sums added up, as whole numbers of any size; ``k * size`` numbers reach the driver."""
    parts = state.where("sums is not null").select("cluster", F.posexplode("sums").alias("place", "part"))
    totals = [[0] * size for _ in range(k)]
    for r in parts.groupBy("cluster", "place").agg(F.sum(F.col("part").cast("decimal(38,0)")).alias("total")).collect():
        totals[r["cluster"]][r["place"]] = int(r["total"])
    return totals


def centroid_clusters(table: DataFrame, k: int = 16, rounds: int = 3, width: int = 64, scale: int = 64, seed: int = 1) -> Clusters:
    """Assign every vector of ``table``, ``rounds`` times move the centroids to floor(mean), assign once more."""
    spark = table.sparkSession
    vectors = whole_vectors(table, width, scale)
    first = first_centroids(vectors, k, seed)
    if not len(first):
        return Clusters(spark.createDataFrame([], "vec_id long, cluster int, distance long"), first.reshape(0, width), [])
    history, state, computed, path = [first], vectors, [], None
    for number in range(rounds + 1):
        last = number == rounds
        old, path = path, new_folder(spark, f"centroids-{number}")
        state.mapInArrow(_round(np.stack(history), last), _STATE).write.parquet(path)
        if old:
            drop_folder(spark, old)
        written = read_parquet(spark, path, _STATE)
        totals = _totals(written, len(first), width + 2)
        computed.append(sum(t[width + 1] for t in totals))
        if not last:
            history.append(
                np.array([[s // t[width] for s in t[:width]] if t[width] else c.tolist() for t, c in zip(totals, history[-1])], np.int64)
            )
        state = written.where("sums is null")
    return Clusters(state.select("vec_id", "cluster", "distance"), history[-1], computed)


def clusters_with_inertia(found: Clusters) -> DataFrame:
    """The members, each with the sums of distances over its cluster and over all, and the digest of its centroid."""
    spark = found.members.sparkSession
    # One row for each cluster.
    sums = found.members.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")).collect()
    everything = sum(int(r["total"]) for r in sums)
    text = {r["cluster"]: ",".join(map(str, found.centroids[r["cluster"]].tolist())) for r in sums}
    facts = [(r["cluster"], int(r["total"]), everything, hashlib.sha256(text[r["cluster"]].encode()).hexdigest()) for r in sums]
    facts = spark.createDataFrame(facts, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.members.join(F.broadcast(facts), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
