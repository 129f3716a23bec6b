"""Hashed n-grams of texts as flat arrays, and logistic helpers for the classifiers."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from starloom.llm.tables import documents, spread, staged, words

# Odd multipliers: fractions of the golden ratio, of the roots of 2 and of 3, in 64 bits.
_MIX = np.array([0x9E3779B97F4A7C15, 0x6A09E667F3BCC909, 0xBB67AE8584CAA73B], np.uint64)


def word_hashes(text: Column) -> Column:
    """A 64-bit hash of each word, in order."""
    return F.transform(words(text), lambda w: F.xxhash64(w))


def pair_places(starts: np.ndarray, gap: int) -> np.ndarray:
    """Places whose ``gap``-th successor is in the same run; ``starts`` has an end entry."""
    return spread(starts[:-1], np.maximum(np.diff(starts) - gap, 0))


def word_grams(hashes: np.ndarray, starts: np.ndarray, gaps: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of words and of pairs of words ``gaps`` apart, with the number of the text that each one is from."""
    text_of = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    grams, texts = [hashes * _MIX[0]], [text_of]
    for gap in gaps:
        at = pair_places(starts, gap)
        first = hashes[at] * _MIX[1]
        grams.append((first ^ (first >> np.uint64(29))) * _MIX[0] + hashes[at + gap] * _MIX[2] + np.uint64(gap))
        texts.append(text_of[at])
    return np.concatenate(grams), np.concatenate(texts)


def char_grams(texts: list[str], longest: int, bits: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each length up to ``longest`` the places in a table of 2^bits of all character n-grams, and each text's number of them."""
    flat = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    starts = np.concatenate([[0], np.cumsum(sizes)])
    out, rolling = [], np.zeros(len(flat), np.uint32)
    for n in range(1, longest + 1):
        rolling = rolling[: len(flat) - n + 1] * np.uint32(0x01000193) + flat[n - 1 :] if len(flat) >= n else rolling[:0]
        place = (rolling * np.uint32(0x9E3779B1)) >> np.uint32(32 - bits)
        if n > 1:
            inside = np.ones(len(place), bool)
            for back in range(1, n):
                ends = starts[1:-1] - back
                ends = ends[(ends >= 0) & (ends < len(place))]
                inside[ends] = False
            place = place[inside]
        out.append((place, np.maximum(sizes - n + 1, 0)))
    return out


def run_sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums of consecutive runs of ``counts`` values; 0 for an empty run."""
    out = np.zeros(len(counts))
    full = np.flatnonzero(counts)
    if len(full):
        out[full] = np.add.reduceat(values, (np.cumsum(counts) - counts)[full], dtype=np.float64)
    return out


def logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def labelled_sample(labels: DataFrame, label: str, rows: int, usable: Column | None = None) -> DataFrame:
    """``doc_id, label`` of about ``rows`` labelled documents at most, by a hash of the id.

    A document with several labels has the greatest one; rows without id or label take no part.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
    known = known.where("doc_id is not null and label is not null")
    known = known.where(usable) if usable is not None else known
    known = known.groupBy("doc_id").agg(F.max("label").alias("label"))
    share = rows / max(rows, known.count())
    return known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(share * (1 << 30)))


def sample_texts(docs: DataFrame, sample: DataFrame, most_bytes: int) -> DataFrame:
    """``doc_id, text, label`` of the sampled documents, ``most_bytes`` of text at most, by a hash of the id.

    Of rows that share an id the one whose text has the smallest hash takes part. A text that
    alone is above the bound takes none.
    """
    texts = documents(docs).join(F.broadcast(sample), "doc_id")
    one = F.min(F.struct(F.xxhash64("text").alias("hash"), F.col("text"))).alias("one")
    texts = staged(texts.groupBy("doc_id", "label").agg(one).select("doc_id", "one.text", "label"), "sample-texts")
    # A row of a few bytes for each sampled id.
    sizes = texts.select("doc_id", F.octet_length("text").cast("long").alias("bytes")).where(F.col("bytes") <= most_bytes)
    if (sizes.agg(F.sum("bytes")).first()[0] or 0) <= most_bytes:
        return texts.where(F.octet_length("text") <= most_bytes)
    upto = Window.orderBy(F.xxhash64("doc_id", F.lit(2)), "doc_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    fitting = sizes.withColumn("total", F.sum("bytes").over(upto)).where(F.col("total") <= most_bytes)
    return texts.join(F.broadcast(fitting.select("doc_id")), "doc_id", "left_semi")


def one_task(sample: DataFrame) -> DataFrame:
    """The bounded sample in one partition, in an order that does not depend on the layout of the data."""
    return sample.repartition(1).sortWithinPartitions(F.xxhash64("doc_id", F.lit(1)), "doc_id")


def gather_lists(batches, *names: str) -> dict[str, list]:
    """The rows of all batches of the bounded sample as lists."""
    rows: dict[str, list] = {n: [] for n in names}
    for batch in batches:
        for n in names:
            column = batch.column(n)
            if pa.types.is_list(column.type):
                rows[n] += [np.asarray(x.values) for x in column]
            else:
                rows[n] += column.to_pylist()
    return rows
