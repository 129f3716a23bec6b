"""SimHash near-duplicates by a binary trie that is joined with itself.

Each text has one 64-bit fingerprint. Distinct fingerprints alone are compared:
walking pairs of trie nodes of one depth together, every step down adds one to a
pair's differing bits where the two children differ, and a pair beyond the error
budget is pruned with all below it.

The trie is dealt out by the pigeonhole rule: two fingerprints that differ in at
most k bits agree in one of k + 1 blocks of bits, so each one goes to k + 1
groups, of those that share a block. A group above ``GROUP_ROWS`` fingerprints
is dealt out once more in the same way by its other bits, until it fits; a group
whose free bits are too few to exceed the bound ends that. No pair is lost and
none is cut off. A task reports a spanning forest of its links, never all pairs.

A text without words has fingerprint zero and is linked like any other; so is a
null text. Rows with equal ``doc_id`` are rows of their own, a null ``doc_id`` is
no candidate for the smallest one. An empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from starloom.llm.tables import documents, free_name, shuffle_partitions, slices, staged

BITS = 64
SEED = 42
GROUP_ROWS = 1 << 14
CHUNK_ROWS = 1 << 17
FRONTIER = 1 << 20

_LOWER = bytes(range(256)).lower()


def fingerprint_counts(hashes: list[int], starts: np.ndarray) -> np.ndarray:
    """Fingerprints of runs of hashes: a bit is set if it is in over half of a run. ``starts`` has an end entry."""
    out = np.zeros(len(starts) - 1, np.uint64)
    sizes = np.diff(starts)
    full = np.flatnonzero(sizes)
    if len(full):
        bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts = np.add.reduceat(bits, starts[full], axis=0, dtype=np.int32)
        out[full] = np.packbits(2 * counts > sizes[full, None], axis=1, bitorder="little").view("<u8").ravel()
    return out


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """``doc_id`` and the fingerprint of each text as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh64_intdigest
        for part in slices(batches, "text", 1 << 20):
            hashes, counts = [], []
            for text in part.column("text").to_pylist():
                # bytes.split() parts at the six ASCII spaces and no others.
                words = text.encode().translate(_LOWER).split()
                joined = b" ".join(words)
                if len(words) <= shingle:
                    own = [digest(joined, SEED)] if words else []
                else:
                    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
                    begins = [0, *ends[:-shingle].tolist()]
                    own = [digest(joined[a:b], SEED) for a, b in zip(begins, (ends[shingle - 1 :] - 1).tolist())]
                hashes += own
                counts.append(len(own))
            found = fingerprint_counts(hashes, np.concatenate([[0], np.cumsum(counts)]).astype(np.int64))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(found.view(np.int64))], ["doc_id", "fingerprint"]
            )

    return documents(docs).mapInArrow(run, "doc_id long, fingerprint long")


def trie_pairs(prints: np.ndarray, starts: np.ndarray, budget: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of places of fingerprints at most ``budget`` bits apart, within groups.

    ``prints`` ascend within each group and are distinct there; ``starts`` has an
    end entry. A trie node is a run of places that share their upper bits, so its
    children are the run's zeros and ones at the next bit. At most ``FRONTIER``
    node pairs are walked at a time; the rest waits, one heap for each depth.
    """
    zeros = np.zeros((BITS, len(prints) + 1), np.int32)
    for bit in range(BITS):
        np.cumsum((prints >> np.uint64(bit)) & np.uint64(1) == 0, out=zeros[bit, 1:])
    a0, a1 = starts[:-1].astype(np.int64), starts[1:].astype(np.int64)
    roots = a1 - a0 > 1
    stack = [(BITS - 1, (a0[roots], a1[roots], a0[roots], a1[roots], np.zeros(int(roots.sum()), np.int64)))]
    while stack:
        bit, (a0, a1, b0, b1, differ) = stack.pop()
        if not len(a0):
            continue
        if len(a0) > FRONTIER:
            half = len(a0) // 2
            stack.append((bit, tuple(x[half:] for x in (a0, a1, b0, b1, differ))))
            a0, a1, b0, b1, differ = (x[:half] for x in (a0, a1, b0, b1, differ))
        # Two nodes of one fingerprint each: their other bits are compared at once.
        single = (a1 - a0 == 1) & (b1 - b0 == 1)
        if single.any():
            i, j = a0[single], b0[single]
            below = np.uint64((1 << (bit + 1)) - 1)
            near = differ[single] + np.bitwise_count((prints[i] ^ prints[j]) & below) <= budget
            if near.any():
                yield i[near], j[near]
            a0, a1, b0, b1, differ = (x[~single] for x in (a0, a1, b0, b1, differ))
        if bit < 0 or not len(a0):
            continue
        am = a0 + zeros[bit, a1] - zeros[bit, a0]
        bm = b0 + zeros[bit, b1] - zeros[bit, b0]
        same = a0 == b0
        children = (
            (a0, am, b0, bm, differ, None),
            (am, a1, bm, b1, differ, None),
            (a0, am, bm, b1, differ + 1, None),
            (am, a1, b0, bm, differ + 1, ~same),
        )
        kept = []
        for c0, c1, e0, e1, d, only in children:
            keep = (c1 > c0) & (e1 > e0) & (d <= budget) & ((c0 != e0) | (c1 - c0 > 1))
            keep = keep if only is None else keep & only
            kept.append(tuple(x[keep] for x in (c0, c1, e0, e1, d)))
        stack.append((bit - 1, tuple(np.concatenate(x) for x in zip(*kept))))


def connect(parent: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Join the trees of ``i`` and ``j`` in ``parent``; a root is the smallest place of its tree."""

    def root(x: np.ndarray) -> np.ndarray:
        while True:
            up = parent[x]
            if (up == x).all():
                return x
            x = up

    while len(i):
        i, j = root(i), root(j)
        apart = i != j
        i, j = i[apart], j[apart]
        np.minimum.at(parent, np.maximum(i, j), np.minimum(i, j))


def _forest(budget: int):
    """Rows sorted by group in; for each fingerprint with a link, the first one of its tree in that group out."""

    def edges(mask: np.ndarray, value: np.ndarray, prints: np.ndarray) -> pa.RecordBatch:
        group = np.cumsum(np.concatenate([[0], (np.diff(mask) != 0) | (np.diff(value) != 0)]))
        order = np.lexsort((prints, group))
        group, prints = group[order], prints[order]
        # A fingerprint can come to a group of small groups by two ways.
        new = np.concatenate([[True], (np.diff(group) != 0) | (np.diff(prints) != 0)])
        group, prints = group[new], prints[new]
        starts = np.concatenate([[0], np.flatnonzero(np.diff(group)) + 1, [len(prints)]])
        parent = np.arange(len(prints))
        for i, j in trie_pairs(prints, starts, budget):
            connect(parent, i, j)
        while not (parent[parent] == parent).all():
            parent = parent[parent]
        linked = np.flatnonzero(parent != np.arange(len(prints)))
        both = prints[linked].view(np.int64), prints[parent[linked]].view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(both[0]), pa.array(both[1])], ["u", "v"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        size = 0
        for batch in batches:
            held.append(tuple(np.asarray(batch.column(n)) for n in ("mask", "value", "fingerprint")))
            size += batch.num_rows
            if size < CHUNK_ROWS:
                continue
            mask, value, prints = (np.concatenate(x) for x in zip(*held))
            # The last group may go on in the next batch.
            last = np.flatnonzero((mask != mask[-1]) | (value != value[-1]))
            cut = int(last[-1]) + 1 if len(last) else 0
            if cut:
                yield edges(mask[:cut], value[:cut], prints[:cut].view(np.uint64))
            held, size = [(mask[cut:], value[cut:], prints[cut:])], len(mask) - cut
        if size:
            mask, value, prints = (np.concatenate(x) for x in zip(*held))
            yield edges(mask, value, prints.view(np.uint64))

    return run


def _blocks(free: list[int], parts: int) -> list[int]:
    """Masks of ``parts`` blocks that share out the ``free`` bits."""
    return [sum(1 << b for b in block.tolist()) for block in np.array_split(np.array(free), parts)]


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def near_edges(distinct: DataFrame, budget: int) -> DataFrame:
    """Edges ``u, v`` that connect any two of the distinct fingerprints at most ``budget`` bits apart."""
    spark = distinct.sparkSession
    masks = {0: _blocks(list(range(BITS)), budget + 1)}
    rows, fitting = distinct.select("fingerprint", F.lit(0).cast("long").alias("mask")), []
    while True:
        # Each mask so far is refined by blocks of the bits that it leaves free: a few hundred rows at most.
        finer = [(_signed(m), _signed(m | b)) for m, blocks in masks.items() for b in blocks]
        finer = spark.createDataFrame(finer, "mask long, finer long")
        rows = rows.join(F.broadcast(finer), "mask").select("fingerprint", F.col("finer").alias("mask"))
        rows = rows.withColumn("value", F.col("fingerprint").bitwiseAND(F.col("mask")))
        masks = {
            m | b: _blocks([x for x in range(BITS) if not (m | b) >> x & 1], budget + 1)
            for m, blocks in masks.items()
            for b in blocks
        }
        wide = {m for m in masks if BITS - m.bit_count() > GROUP_ROWS.bit_length() - 1}
        if not wide:
            break
        sizes = rows.groupBy("mask", "value").agg(F.count(F.lit(1)).alias("n"))
        # One row for GROUP_ROWS rows at most.
        large = staged(sizes.where(F.col("n") > GROUP_ROWS).select("mask", "value"), "large-groups")
        if large.isEmpty():
            break
        fitting.append(rows.join(large, ["mask", "value"], "left_anti"))
        rows = staged(rows.join(large, ["mask", "value"], "left_semi"), "large-group-rows").select("fingerprint", "mask")
    fitting.append(rows.select("fingerprint", "mask", "value"))
    dealt = reduce(DataFrame.unionByName, (f.select("mask", "value", "fingerprint") for f in fitting))
    dealt = dealt.repartition(shuffle_partitions(spark), "mask", "value").sortWithinPartitions("mask", "value")
    return dealt.mapInArrow(_forest(budget), "u long, v long")


def components(edges: DataFrame) -> DataFrame:
    """``node, root``: for every node but the smallest of its component, that smallest one.

    Large-star and small-star steps by turns; each step is a grouped minimum and
    a join, and each round is written, so that a lost executor costs one round.
    """
    stars = edges.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    stars = staged(stars, "links")
    mark = None
    while True:
        sums = stars.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if tuple(sums) == mark or not sums[0]:
            return stars.select(F.col("u").alias("node"), F.col("v").alias("root"))
        mark = tuple(sums)
        both = stars.select("u", "v").union(stars.select("v", "u")).toDF("n", "m")
        low = both.groupBy("n").agg(F.min("m").alias("low"))
        large = both.join(low, "n").where("m > n").select(F.col("m").alias("u"), F.least("low", "n").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("low"))
        small = large.join(low, "u").where("v != low").select(F.col("v").alias("u"), F.col("low").alias("v"))
        stars = staged(small.union(low).distinct(), "links")


def near_classes(docs: DataFrame, shingle: int = 3, budget: int = 2) -> DataFrame:
    """``doc_id, fingerprint`` as a long and ``component_id``, the smallest ``doc_id`` that links reach."""
    return _rooted_classes(docs, shingle, budget).select("doc_id", "fingerprint", "component_id")


def _rooted_classes(docs: DataFrame, shingle: int, budget: int) -> DataFrame:
    """``near_classes`` with ``root``, the smallest fingerprint of a class; unlike ``component_id`` no two classes share it."""
    prints = staged(fingerprints(docs, shingle), "fingerprints")
    # One row per fingerprint, so that a third of all rows with one text is one row here.
    distinct = staged(prints.groupBy("fingerprint").agg(F.min("doc_id").alias("first")), "distinct-fingerprints")
    stars = components(near_edges(distinct, budget))
    rooted = distinct.join(stars.withColumnRenamed("node", "fingerprint"), "fingerprint", "left")
    rooted = rooted.withColumn("root", F.coalesce("root", "fingerprint"))
    classes = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    of = rooted.join(classes, "root").select("fingerprint", "component_id", "root")
    return prints.join(of, "fingerprint").select("doc_id", "fingerprint", "component_id", "root")


def drop_near_copies(docs: DataFrame, shingle: int = 3, budget: int = 2) -> DataFrame:
    """One document of each class, that of the smallest ``doc_id``, with all its columns.

    Of rows of a class that repeat this ``doc_id`` the one with the smallest hash of
    its content stays; the same id may stay for several classes. A class without any
    ``doc_id`` keeps one row, by that hash too.
    """
    classes = staged(_rooted_classes(docs, shingle, budget), "classes")
    here = free_name(docs, "keep_id")
    is_first = F.col("doc_id") == F.col("component_id")
    ids = classes.where("doc_id is not null").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"), F.max(is_first).alias("first"))
    ids = ids.where("first").select(F.col("doc_id").alias(here), "n")
    match = docs["doc_id"].cast("long") == F.col(here)
    kept = docs.join(ids.where("n = 1"), match, "left_semi")
    several = staged(ids.where("n > 1").select(here), "repeated-ids")
    heads = classes.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select("doc_id", "fingerprint", "root").distinct()
    if not several.isEmpty():
        own = heads.join(several, heads["doc_id"] == several[here], "left_semi")
        kept = kept.unionByName(_one_per_root(docs.join(several, match, "left_semi"), own, shingle))
    nameless = heads.where("doc_id is null")
    if not nameless.isEmpty():
        # Only rows without an id are in such classes; equal texts have equal fingerprints.
        kept = kept.unionByName(_one_per_root(docs.where(F.col("doc_id").isNull()), nameless, shingle))
    return kept


def _one_per_root(rows: DataFrame, heads: DataFrame, shingle: int) -> DataFrame:
    """Of ``rows`` one for each root of ``heads``, the first by content among those with a head's id and fingerprint."""
    row = free_name(rows, "row_number")
    named = staged(rows.withColumn(row, F.monotonically_increasing_id()), "rows-to-choose-from")
    # Maps have no hash; rows that differ in those alone are alike.
    hashed = [F.col(f"`{f.name}`") for f in rows.schema.fields if not re.search("map<|variant", f.dataType.simpleString())]
    rank = F.struct(F.xxhash64(*hashed).alias("content"), F.col(row).alias("number"))
    ranked = named.select(F.col(row).alias("number"), F.col("doc_id").cast("long").alias("id"), rank.alias("rank"))
    prints = fingerprints(named.select(F.col(row).alias("doc_id"), "text"), shingle).withColumnRenamed("doc_id", "number")
    # One row per id and fingerprint before classes are looked up.
    ranked = ranked.join(prints, "number").groupBy("id", "fingerprint").agg(F.min("rank").alias("rank"))
    same = F.col("id").eqNullSafe(heads["doc_id"]) & (ranked["fingerprint"] == heads["fingerprint"])
    first = ranked.join(heads, same).groupBy("root").agg(F.min("rank").alias("rank"))
    return named.join(first.select(F.col("rank.number").alias(row)), row, "left_semi").drop(row)
