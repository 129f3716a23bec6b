"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features are whether a text has a word (letters and digits, in lower case), a
pair of adjacent words, or a pair with one word between, by 64-bit hashes. Each coordinate has its own learning rate,
and the L1 term leaves most weights at exactly zero, so that the model is a small
sorted table of hashes and weights. Training reads a sample of at most about
``sample_rows`` labelled documents, a row of each and ``sample_bytes`` of text at most, in one task; scoring reads all texts.

A null text is empty; an empty text gets the score of the intercept. Rows with
equal or null ``doc_id`` are scored each by itself; a null one is not held out.
Without any training row every score is 0.5. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from starloom.llm.features import labelled_sample, logistic, one_task, sample_texts, word_grams, word_hashes
from starloom.llm.tables import documents, list_parts, slices

GAPS = (1, 2)

# Hashes that are scored at a time: their n-grams take some twenty times as much, in every worker of an executor.
SLICE_BYTES = 1 << 20


@dataclass
class Ftrl:
    """Settings; bounds on the sample, passes over it, and the usual four numbers of the method.

    A feature has to occur in ``least_texts`` sample texts. Rows of label 1, which
    are few, count ``positive_weight`` times.
    """

    sample_rows: int = 12_000
    sample_bytes: int = 64 << 20
    least_texts: int = 3
    passes: int = 5
    positive_weight: float = 3.0
    alpha: float = 1.0
    beta: float = 1.0
    l1: float = 3.0
    l2: float = 1.0


def _hashed(text: Column) -> Column:
    return word_hashes(F.regexp_replace(F.lower(text), "[^\\p{L}\\p{N}]+", " "))


def held_out(doc_id: Column) -> Column:
    """Whether no label of this document may be learned from."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))


def train(features: list[np.ndarray], labels: np.ndarray, n: int, settings: Ftrl) -> tuple[np.ndarray, float]:
    """Weights of ``n`` coordinates and the intercept. ``features`` has each row's coordinates, without repeats."""
    z, s = np.zeros(n + 1), np.zeros(n + 1)

    def weights(at: np.ndarray) -> np.ndarray:
        pull = np.sign(z[at]) * settings.l1
        pull[at == n] = 0  # the intercept has no penalty
        w = -(z[at] - pull) / ((settings.beta + np.sqrt(s[at])) / settings.alpha + settings.l2)
        return np.where(np.abs(z[at]) > np.abs(pull), w, 0.0)

    for _ in range(settings.passes):
        for at, y in zip(features, labels, strict=True):
            at = np.append(at, n)
            w = weights(at)
            g = (float(logistic(w.sum())) - y) * (settings.positive_weight if y else 1.0)
            root = np.sqrt(s[at])
            s[at] += g * g
            z[at] += g - (np.sqrt(s[at]) - root) / settings.alpha * w
    w = weights(np.arange(n + 1))
    return w[:n], float(w[n])


def fit(docs: DataFrame, labels: DataFrame, label: str, settings: Ftrl) -> tuple[np.ndarray, np.ndarray, float]:
    """Hashes that have a weight, in ascending order, their weights, and the intercept."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, labels_of = [], []
        for batch in batches:
            labels_of += batch.column("label").to_pylist()
            flat, starts = list_parts(batch.column("hashes"))
            for a, b in zip(starts, starts[1:]):
                grams.append(np.unique(word_grams(flat[a:b].view(np.uint64), np.array([0, b - a]), GAPS)[0]))
        if not grams:
            return
        # Texts per range of hashes: most features are in too few texts, and go before they are sorted.
        texts = np.zeros(1 << 25, np.uint32)
        for own in grams:
            texts[own >> np.uint64(39)] += 1
        grams = [own[texts[own >> np.uint64(39)] >= settings.least_texts] for own in grams]
        of = [len(own) for own in grams]
        flat = np.concatenate(grams)
        names, place, seen = np.unique(flat, return_inverse=True, return_counts=True)
        shared = seen >= settings.least_texts
        number = np.cumsum(shared) - 1
        place = np.where(shared[place], number[place], -1)
        features = [p[p >= 0] for p in np.split(place, np.cumsum(of)[:-1])]
        w, bias = train(features, np.array(labels_of, float), int(shared.sum()), settings)
        names = names[shared]
        kept = np.flatnonzero(w)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(names[kept].view(np.int64), 0)), pa.array(np.append(w[kept], bias)), pa.array([False] * len(kept) + [True])],
            ["gram", "weight", "intercept"],
        )

    sample = labelled_sample(labels, label, settings.sample_rows, ~held_out(F.col("doc_id")))
    # About sample_rows rows of 12 bytes at most.
    texts = sample_texts(docs, sample, settings.sample_bytes)
    texts = one_task(texts.select("doc_id", _hashed(F.col("text")).alias("hashes"), "label"))
    # The L1 term and the bounded sample bound the rows.
    found = texts.mapInArrow(run, "gram long, weight double, intercept boolean").collect()
    model = sorted((r["gram"] & (1 << 64) - 1, r["weight"]) for r in found if not r["intercept"])
    bias = sum(r["weight"] for r in found if r["intercept"])
    return np.array([g for g, _ in model], np.uint64), np.array([w for _, w in model]), bias


def _scores(model: tuple[np.ndarray, np.ndarray, float], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``doc_id, score`` of rows of ``doc_id, hashes``."""
    grams, weights, bias = model
    # A table of the upper bits says at once that most n-grams have no weight.
    top = np.zeros(1 << 20, bool)
    top[grams >> np.uint64(44)] = True
    for part in slices(batches, "hashes", SLICE_BYTES):
        flat, starts = list_parts(part.column("hashes"))
        found, of = word_grams(flat.view(np.uint64), starts, GAPS)
        maybe = top[found >> np.uint64(44)]
        found, of = found[maybe], of[maybe]
        place = np.searchsorted(grams, found)
        hit = place < len(grams)
        hit[hit] = grams[place[hit]] == found[hit]
        # Whether, not how often: each text's weights once.
        own = np.unique(of[hit] * len(grams) + place[hit]) if hit.any() else np.zeros(0, np.int64)
        sums = np.bincount(own // max(1, len(grams)), weights[own % max(1, len(grams))], len(part))
        yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(logistic(bias + sums))], ["doc_id", "score"])


def score(docs: DataFrame, model: tuple[np.ndarray, np.ndarray, float]) -> DataFrame:
    """``doc_id, score`` of every text."""
    hashed = documents(docs).select("doc_id", _hashed(F.col("text")).alias("hashes"))
    return hashed.mapInArrow(partial(_scores, model), "doc_id long, score double")


def toxicity(docs: DataFrame, labels: DataFrame, label: str = "toxic", settings: Ftrl | None = None) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row of ``docs``; learns from rows that are not held out."""
    scored = score(docs, fit(docs, labels, label, settings or Ftrl()))
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"),
    )
