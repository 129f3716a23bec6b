"""Exact search for the k highest inner products by distributed histogram selection.

Every candidate is scored against every query of a block, and each task reports
only how many scores fall into which of ``BUCKETS`` ranges of each query. The range
that holds a query's k-th highest score is divided again, until it is one integer
wide. Then candidates at or above that score are passed on, ties beyond k left out
by ``vec_id`` already in the tasks, and ranked. Queries go in blocks of bounded
bytes, one after the other; candidates are never shuffled nor gathered.

Components are floor(1024 * x). A vector that is null, or holds a null or a value
that is not finite, takes no part, nor does a row without ``vec_id``. Vectors of
different length are compared as if zeros followed the shorter one. A query is
not compared with rows of its own ``vec_id``; query rows that repeat are answered
once each. Sums are 64-bit integers. An empty table, or one without queries,
gives no rows; a query without candidates has none.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from starloom.llm.tables import list_parts, staged

BUCKETS = 64
BLOCK_BYTES = 16 << 20
SCORES_AT_ONCE = 1 << 22
QUERIES_AT_ONCE = 1 << 14  # so many histograms, or ``k`` ids of ties for each, does a task hold
TIES_AT_ONCE = 1 << 22
OWN = np.iinfo(np.int64).min


def valid_vectors(table: DataFrame) -> DataFrame:
    """``vec_id, embedding`` of the rows that take part."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = table.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    return rows.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & finite)


def as_matrix(column: pa.Array, width: int) -> np.ndarray:
    """Whole-number components of a list column, each row cut or filled up with zeros to ``width``."""
    flat, starts = list_parts(column)
    scaled = np.floor(1024 * flat)
    sizes = np.diff(starts)
    if (sizes == width).all():
        return scaled.reshape(-1, width)
    out = np.zeros((len(sizes), width))
    for i, (a, n) in enumerate(zip(starts, np.minimum(sizes, width))):
        out[i, :n] = scaled[a : a + n]
    return out


def inner_products(candidates: np.ndarray, queries: np.ndarray) -> np.ndarray:
    """Exact products as 64-bit integers, by floating point where no sum can leave its whole numbers."""
    bound = np.abs(candidates).max(initial=0) * np.abs(queries).max(initial=0) * max(1, queries.shape[1])
    if bound < 2**53:
        return (candidates @ queries.T).astype(np.int64)
    return candidates.astype(np.int64) @ queries.astype(np.int64).T


class Scorer:
    """Scores of record batches against one block of queries."""

    def __init__(self, ids: np.ndarray, queries: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.queries = ids[order], queries[order]

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Candidate ids and their scores, a row for each query; a query's own rows have the score ``OWN``."""
        rows = max(1, SCORES_AT_ONCE // len(self.ids))
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                part = batch.slice(at, rows)
                ids = np.asarray(part.column("vec_id"))
                scores = inner_products(self.queries, as_matrix(part.column("embedding"), self.queries.shape[1]))
                left, right = np.searchsorted(self.ids, ids, "left"), np.searchsorted(self.ids, ids, "right")
                for c in np.flatnonzero(right > left):
                    scores[left[c] : right[c], c] = OWN
                yield ids, scores


def _extremes(scorer: Scorer) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(len(scorer.ids), np.int64)
        low, high = np.full(len(n), np.iinfo(np.int64).max), np.full(len(n), OWN)
        for _, scores in scorer(batches):
            own = scores == OWN
            n += (~own).sum(1)
            high = np.maximum(high, scores.max(1))
            low = np.minimum(low, np.where(own, np.iinfo(np.int64).max, scores).min(1))
        q = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (q, n[q], low[q], high[q])], ["q", "n", "low", "high"])

    return run


def _histogram(scorer: Scorer, low: np.ndarray, high: np.ndarray, width: np.ndarray) -> Callable:
    """Numbers of scores from ``low`` to ``high`` in each bucket; higher ones are counted already."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(low) * BUCKETS, np.int64)
        first = np.arange(len(low))[:, None] * BUCKETS
        for _, scores in scorer(batches):
            inside = (scores >= low[:, None]) & (scores <= high[:, None])
            bucket = (np.where(inside, scores, low[:, None]) - low[:, None]) // width[:, None]
            total += np.bincount((bucket + first)[inside], minlength=len(total))
        full = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(full // BUCKETS), pa.array(full % BUCKETS), pa.array(total[full])], ["q", "bucket", "n"]
        )

    return run


def _survivors(scorer: Scorer, kth: np.ndarray, k: int) -> Callable:
    """Candidates above each query's k-th score, and of a task's ties with it the k smallest ids."""

    def rows(q: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(q), pa.array(scorer.ids[q]), pa.array(ids), pa.array(scores)], ["q", "query_id", "vec_id", "score"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = np.iinfo(np.int64).max
        ties, found = np.full((len(kth), k), none), np.zeros(len(kth), np.int64)
        for ids, scores in scorer(batches):
            order = np.argsort(ids, kind="stable")
            ids, scores = ids[order], scores[:, order]
            q, c = np.nonzero(scores > kth[:, None])
            if len(q):
                yield rows(q, ids[c], scores[q, c])
            tied = (scores == kth[:, None]) & (scores != OWN)
            rank = np.cumsum(tied, 1)
            q, c = np.nonzero(tied & (rank <= k))
            if len(q):
                own = np.unique(q)
                new = np.full((len(own), k), none)
                new[np.searchsorted(own, q), rank[q, c] - 1] = ids[c]
                ties[own] = np.sort(np.concatenate([ties[own], new], 1), 1)[:, :k]
                found[own] = np.minimum(k, found[own] + rank[own, -1])
        q, place = np.nonzero(np.arange(k) < found[:, None])
        yield rows(q, ties[q, place], kth[q])

    return run


def kth_scores(vectors: DataFrame, scorer: Scorer, k: int) -> np.ndarray:
    """Each query's k-th highest score, or its lowest one if there are no more than k."""
    found = vectors.mapInArrow(_extremes(scorer), "q long, n long, low long, high long").groupBy("q")
    # One row for each query of a block, here and below.
    found = found.agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high")).collect()
    size = len(scorer.ids)
    low, high, above = np.zeros(size, np.int64), np.zeros(size, np.int64), np.zeros(size, np.int64)
    for r in found:
        low[r["q"]], high[r["q"]] = r["low"], r["low"] if r["n"] <= k else r["high"]
    while (open_ := high > low).any():
        # Ranges as Python integers, since their width may not fit 64 bits.
        width = np.array([(int(h) - int(a)) // BUCKETS + 1 for a, h in zip(low, high)], np.int64)
        counts = vectors.mapInArrow(_histogram(scorer, low, high, width), "q long, bucket long, n long")
        counts = counts.groupBy("q", "bucket").agg(F.sum("n").alias("n"))
        needed = [(int(q), int(k - above[q])) for q in np.flatnonzero(open_)]
        needed = vectors.sparkSession.createDataFrame(needed, "q long, needed long")
        # At most BUCKETS rows for each query.
        from_top = F.sum("n").over(Window.partitionBy("q").orderBy(F.desc("bucket")))
        enough = counts.withColumn("from_top", from_top).join(needed, "q").where("from_top >= needed")
        highest = enough.groupBy("q").agg(F.max(F.struct("bucket", (F.col("from_top") - F.col("n")).alias("before"))).alias("b"))
        for r in highest.select("q", "b.bucket", "b.before").collect():
            q = r["q"]
            above[q] += r["before"]
            low[q] += r["bucket"] * width[q]
            high[q] = min(high[q], low[q] + width[q] - 1)
    return low


def best_of_block(vectors: DataFrame, ids: np.ndarray, queries: np.ndarray, k: int) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the k best candidates of each query of one block."""
    scorer = Scorer(ids, queries)
    kth = kth_scores(vectors, scorer, k)
    found = vectors.mapInArrow(_survivors(scorer, kth, k), "q long, query_id long, vec_id long, score long")
    # A query has fewer than k rows above its k-th score, and at most k ties from each task.
    order = Window.partitionBy("q").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def top_k(table: DataFrame, is_query: Column | str, k: int = 10, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The k highest scores of each query row of ``table`` against all its rows, ties to the smaller ``vec_id``."""
    spark = table.sparkSession
    vectors = valid_vectors(table)
    chosen = staged(vectors.where(is_query), "queries")
    about = chosen.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("embedding")).alias("width")).first()
    n, width = about["n"], about["width"] or 0
    most = max(1, min(QUERIES_AT_ONCE, TIES_AT_ONCE // max(1, k)))
    blocks = max(-(-n * max(1, width) * 8 // block_bytes), -(-n // most)) if n else 0
    results = []
    for number in range(blocks):
        own = chosen.where(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == number).toArrow().combine_chunks()
        if not own.num_rows:
            continue
        ids, lists = np.asarray(own.column("vec_id")), own.column("embedding").combine_chunks()
        lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
        best = best_of_block(vectors, ids, as_matrix(lists, width), k)
        # One block's results are written before the next begins; a single block needs no copy.
        results.append(staged(best, "best") if blocks > 1 else best)
    if not results:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    return reduce(DataFrame.unionByName, results)
