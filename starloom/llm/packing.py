"""Best-two-fit packing of token pieces into sequences of bounded length.

Pieces of equal length are alike, so bins are planned on the number of pieces
of each length, a table of at most ``limit`` entries whatever the corpus holds.
A bin is filled greedily, the largest piece that fits first; then its smallest
piece is replaced by the two unpacked pieces that fit the expanded gap more
tightly. The bin is repeated as often as the numbers allow, and the next one
planned. Pieces are then ranked within their length by a range shuffle and
looked up in the plan; no task or driver ever holds more than its share.

A document of up to ``limit`` tokens is one piece. A longer one is cut into
pieces of ``limit`` tokens, of which the first has what is left over. A null
text is empty and holds the end id alone. Rows with equal or null ``doc_id``
are documents of their own. An empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from starloom.llm.tables import documents, shuffle_partitions, slices, staged
from starloom.llm.token_ids import encoder

# Text that is encoded at a time: its pieces are Python strings, some ten times as large, in every worker of an executor.
SLICE_BYTES = 2 << 20

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def fill_bin(left: np.ndarray, limit: int) -> list[int]:
    """Lengths of one bin out of ``left[n]`` pieces of length n: greedy, then one piece replaced by two."""
    left = left.copy()
    gap, items = limit, []
    while gap:
        fits = np.flatnonzero(left[: gap + 1])
        if not len(fits):
            break
        size = int(fits[-1])
        times = min(int(left[size]), gap // size)
        items += [size] * times
        left[size] -= times
        gap -= size * times
    if not gap or not items:
        return items
    smallest = items[-1]
    room = gap + smallest
    # The pair whose sum comes closest to the room, and above the piece that it replaces.
    first = np.flatnonzero(left[: room + 1])
    if not len(first):
        return items
    # For each first length the largest second one that still fits.
    below = np.searchsorted(first, room - first, "right") - 1
    second = np.where(below >= 0, first[below], 0)
    same = (second == first) & (left[second] < 2)
    lower = np.where(below >= 1, first[np.maximum(below - 1, 0)], 0)
    second = np.where(same, lower, second)
    total = np.where(second > 0, first + second, 0)
    best = int(np.argmax(total))
    if total[best] > smallest:
        items[-1:] = sorted((int(first[best]), int(second[best])), reverse=True)
    return items


def plan_bins(counts: np.ndarray, limit: int) -> list[tuple[list[int], int]]:
    """Bins as (lengths, how many alike) for ``counts[n]`` pieces of length n."""
    left, bins = counts.astype(np.int64), []
    while left.any():
        items = fill_bin(left, limit)
        sizes, needs = np.unique(items, return_counts=True)
        times = int((left[sizes] // needs).min())
        left[sizes] -= needs * times
        bins.append((items, times))
    return bins


def plan_places(bins: list[tuple[list[int], int]], limit: int) -> dict[int, tuple[np.ndarray, ...]]:
    """For each length the runs of ranks that go to bins alike: first rank, pieces in a bin, first bin, offset."""
    places: dict[int, list[tuple[int, int, int, int]]] = {}
    used = [0] * (limit + 1)
    first_bin = 0
    for items, times in bins:
        offset = 0
        sizes, needs = np.unique(items, return_counts=True)
        for size, need in zip(sizes.tolist(), needs.tolist(), strict=True):
            places.setdefault(size, []).append((used[size], need, first_bin, offset))
            used[size] += need * times
            offset += size * need
        first_bin += times
    return {size: tuple(np.array(c, np.int64) for c in zip(*runs, strict=True)) for size, runs in places.items()}


def _pieces(tokenizer_path: str, limit: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pieces of rows of ``doc_id, text``."""
    own = encoder(tokenizer_path)
    for part in slices(batches, "text", SLICE_BYTES):
        ids, lengths = own.encode(part.column("text"))
        raw = ids.astype("<u4").tobytes()
        doc_row, piece, start, length, crc = [], [], [], [], []
        begin = 0
        for row, n in enumerate(lengths.tolist()):
            cuts = [0, *range(n % limit or limit, n + 1, limit)]
            for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
                doc_row.append(row)
                piece.append(k)
                start.append(a)
                length.append(b - a)
                crc.append(zlib.crc32(raw[4 * (begin + a) : 4 * (begin + b)]))
            begin += n
        yield pa.RecordBatch.from_arrays(
            [
                part.column("doc_id").take(pa.array(doc_row, pa.int64())),
                pa.array(piece, pa.int32()),
                pa.array(start, pa.int64()),
                pa.array(length, pa.int64()),
                pa.array(crc, pa.int64()),
            ],
            ["doc_id", "piece", "start", "length", "ids_crc32"],
        )


def token_pieces(docs: DataFrame, tokenizer_path: str, limit: int) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` of every document's pieces."""
    return documents(docs).mapInArrow(partial(_pieces, tokenizer_path, limit), PIECES)


def pack_pieces(pieces: DataFrame, limit: int) -> DataFrame:
    """``pieces``, which has a column ``length`` of 1 to ``limit``, with ``sequence_id`` and ``offset``.

    The ranks of equal lengths are their places after a range shuffle, written
    down once. A length with a third of all pieces spreads over many ranges,
    since ranges are cut by all of a piece's columns that identify it.
    """
    spark = pieces.sparkSession
    order = ["length", "doc_id", "piece", "ids_crc32"]
    # Row numbers in a task are the lower 33 bits of this id.
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    ranked = staged(
        pieces.repartitionByRange(shuffle_partitions(spark), *order)
        .sortWithinPartitions(*order)
        .withColumns({"range": F.spark_partition_id(), "place": place}),
        "pieces-ranked",
    )
    # One row for each range and length: lengths are cut among ranges, so at most ranges + limit rows.
    groups = ranked.groupBy("range", "length").agg(F.count(F.lit(1)).alias("n"), F.min("place").alias("first")).collect()
    counts, rank_of = np.zeros(limit + 1, np.int64), {}
    for g in sorted(groups, key=lambda g: (g["length"], g["range"])):
        rank_of[g["range"], g["length"]] = int(counts[g["length"]]) - g["first"]
        counts[g["length"]] += g["n"]
    places = plan_places(plan_bins(counts, limit), limit)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, part = np.asarray(batch.column("length")), np.asarray(batch.column("range"))
            place = np.asarray(batch.column("place"))
            sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            # Rows come sorted, so there are few runs of equal range and length.
            cuts = np.flatnonzero((np.diff(length) != 0) | (np.diff(part) != 0)) + 1
            for a, b in zip([0, *cuts], [*cuts, len(length)]):
                if a == b:
                    continue
                size = int(length[a])
                rank = place[a:b] + rank_of[int(part[a]), size]
                first, need, first_bin, at = places[size]
                run_of = np.searchsorted(first, rank, "right") - 1
                within = rank - first[run_of]
                sequence[a:b] = first_bin[run_of] + within // need[run_of]
                offset[a:b] = at[run_of] + within % need[run_of] * size
            names = [n for n in batch.schema.names if n not in ("range", "place")]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in names), pa.array(sequence), pa.array(offset)],
                [*names, "sequence_id", "offset"],
            )

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields)
    return ranked.mapInArrow(run, f"{fields}, sequence_id long, offset long")


def packed(docs: DataFrame, tokenizer_path: str, limit: int = 2048) -> DataFrame:
    """All pieces of ``docs`` with the sequence and the offset where each one goes."""
    # Range bounds are sampled from the staged pieces, so no text is encoded twice.
    return pack_pieces(staged(token_pieces(docs, tokenizer_path, limit), "pieces"), limit)
