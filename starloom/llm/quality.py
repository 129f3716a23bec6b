"""Quality rules: counted limits, then a calibrated logistic regression over hashed n-grams.

Features are the relative frequencies of word n-grams (one and two words) and of
character n-grams (one to three), hashed into tables of 2^BITS weights. The model
is trained on labelled quality rows, its log-odds are calibrated on rows that
training did not see, and the verdict is a fixed threshold on the probability.
Training reads a sample of at most about ``sample_rows`` labelled documents, a row of
each and ``sample_bytes`` of text at most, in one task; counting and scoring read all texts, in Arrow batches.

Windows of words are compared by 64-bit hashes. A null text has no words; texts
without words fail the counted limits. Rows with equal or null ``doc_id`` are
judged each by itself. Without labelled rows of both kinds the model accepts
every text. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from starloom.llm.features import char_grams, gather_lists, labelled_sample, logistic, one_task, run_sums, sample_texts, word_grams, word_hashes
from starloom.llm.tables import list_parts, slices

BITS = 18
CHARS = 3
WINDOW = 8

# What counts as a symbol, and the characters between words.
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\v\f\r"


@dataclass
class Settings:
    """Limits of the counted rules, the bounds on the sample, and how the model is trained and used."""

    least_words: int = 20
    most_repeated_percent: int = 30
    sample_rows: int = 5_000
    sample_bytes: int = 64 << 20
    passes: int = 6
    rate: float = 0.5
    l2: float = 1e-6
    threshold: float = 0.5


def repeated_words(hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """For each text the words in windows of ``WINDOW`` words that occur twice or more in it."""
    n = len(starts) - 1
    sizes = np.maximum(np.diff(starts) - WINDOW + 1, 0)
    text_of = np.repeat(np.arange(n), sizes)
    begin = np.repeat(starts[:-1], sizes) + np.arange(len(text_of)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    window = np.zeros(len(begin), np.uint64)
    for k in range(WINDOW):
        window = (window ^ (window >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15) + hashes[begin + k]
    key = window ^ (text_of.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    order = np.argsort(key)
    equal = key[order[1:]] == key[order[:-1]]
    twice = np.zeros(len(key), bool)
    twice[order[1:][equal]] = True
    twice[order[:-1][equal]] = True
    marks = np.zeros(len(hashes) + 1, np.int64)
    np.add.at(marks, begin[twice], 1)
    np.add.at(marks, begin[twice] + WINDOW, -1)
    covered = np.cumsum(marks)[:-1] > 0
    return run_sums(covered, np.diff(starts)).astype(np.int64)


def table_places(texts: list[str], hashes: np.ndarray, starts: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per kind of n-gram the places in the weight table, text after text, and each text's number of them.

    The tables of the kinds stand one after the other.
    """
    kinds = char_grams(texts, CHARS, BITS)
    for gaps in ((), (1,)):
        grams, of = word_grams(hashes, starts, gaps)
        if gaps:
            own = len(hashes)
            grams, of = grams[own:], of[own:]
        kinds.append(((grams >> np.uint64(64 - BITS)).astype(np.uint32), np.bincount(of, minlength=len(starts) - 1)))
    return [(place.astype(np.int32) + np.int32(k << BITS), counts) for k, (place, counts) in enumerate(kinds)]


KINDS = CHARS + 2


def log_odds(kinds: list[tuple[np.ndarray, np.ndarray]], weights: np.ndarray, bias: float) -> np.ndarray:
    """The sum over kinds of the mean weight of a text's n-grams."""
    return bias + sum(run_sums(weights[place], counts) / np.maximum(counts, 1) for place, counts in kinds)


def train(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, settings: Settings) -> tuple[np.ndarray, float]:
    """Weights and intercept by adaptive gradient steps; each row has its places and their relative frequencies."""
    w, s = np.zeros(KINDS << BITS), np.full(KINDS << BITS, 1e-8)
    bias, bias_s = 0.0, 1e-8
    share = max(labels.mean(), 1e-9)
    # Both labels count alike in all.
    weight = np.where(labels > 0, 0.5 / share, 0.5 / max(1 - share, 1e-9))
    for _ in range(settings.passes):
        for (at, x), y, c in zip(rows, labels, weight, strict=True):
            error = (float(logistic(w[at] @ x + bias)) - y) * c
            g = error * x + settings.l2 * w[at]
            s[at] += g * g
            w[at] -= settings.rate * g / np.sqrt(s[at])
            bias_s += error * error
            bias -= settings.rate * error / np.sqrt(bias_s)
    return w, bias


def calibrate(odds: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and shift that make ``logistic(slope * odds + shift)`` a probability, by Newton steps on smoothed labels."""
    good, bad = labels.sum(), len(labels) - labels.sum()
    target = np.where(labels > 0, (good + 1) / (good + 2), 1 / (bad + 2))
    x = np.stack([odds, np.ones(len(odds))], 1)
    theta = np.array([1.0, 0.0])
    for _ in range(50):
        p = logistic(x @ theta)
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2), x.T @ (p - target))
        theta = theta - np.clip(step, -1, 1)
    return float(theta[0]), float(theta[1])


def fit(docs: DataFrame, labels: DataFrame, label: str, settings: Settings) -> tuple[np.ndarray, float] | None:
    """Weights and intercept of the calibrated model; None if there are not rows of both labels."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = gather_lists(batches, "text", "hashes", "label")
        y = np.array(found["label"], float)
        if not 0 < y.sum() < len(y):
            return
        rows = []
        for text, hashes in zip(found["text"], found["hashes"], strict=True):
            at, x = [], []
            for place, counts in table_places([text], hashes.view(np.uint64), np.array([0, len(hashes)])):
                own, n = np.unique(place, return_counts=True)
                at.append(own)
                x.append((n / max(int(counts.sum()), 1)).astype(np.float32))
            rows.append((np.concatenate(at), np.concatenate(x)))
        # Every fifth row calibrates.
        apart = np.arange(len(y)) % 5 == 0
        w, bias = train([r for r, out in zip(rows, apart) if not out], y[~apart], settings)
        odds = np.array([w[at] @ x + bias for (at, x), out in zip(rows, apart) if out])
        slope, shift = calibrate(odds, y[apart])
        # A slope that is not positive means that calibration rows were too few to tell.
        slope, shift = (slope, shift) if slope > 0 else (1.0, 0.0)
        kept = np.flatnonzero(w)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(kept, -1)), pa.array(np.append(w[kept] * slope, bias * slope + shift))], ["place", "weight"]
        )

    sample = labelled_sample(labels, label, settings.sample_rows)
    # About sample_rows rows of 12 bytes at most.
    texts = sample_texts(docs, sample, settings.sample_bytes)
    texts = one_task(texts.select("doc_id", "text", word_hashes(F.col("text")).alias("hashes"), "label"))
    # At most KINDS * 2^BITS + 1 rows.
    found = texts.mapInArrow(run, "place long, weight double").toArrow()
    if not found.num_rows:
        return None
    place, weight = np.asarray(found.column("place")), np.asarray(found.column("weight"))
    weights = np.zeros(KINDS << BITS, np.float32)
    weights[place[place >= 0]] = weight[place >= 0]
    return weights, float(weight[place < 0][0])


VERDICT = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, probability double, kept boolean"
)


def _judged(docs: DataFrame, model: tuple[np.ndarray, float] | None, settings: Settings, filtered: bool) -> DataFrame:
    """Verdicts, or with ``filtered`` the kept rows with all their columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text", 1 << 20):
            flat, starts = list_parts(part.column("hashes"))
            flat, n = flat.view(np.uint64), np.diff(starts)
            repeated = repeated_words(flat, starts)
            chance = np.ones(len(n))
            if model is not None:
                chance = logistic(log_odds(table_places(part.column("text").to_pylist(), flat, starts), *model))
            failed = (n < settings.least_words) | (100 * repeated > settings.most_repeated_percent * n)
            kept = ~failed & (chance >= settings.threshold)
            if filtered:
                rows = part.column("row").filter(pa.array(kept))
                yield pa.RecordBatch.from_arrays(rows.flatten(), [f.name for f in rows.type])
                continue
            names = ["doc_id", "word_chars", "n_symbols", "n_dup_lines"]
            found = {c: part.column(c) for c in names}
            found |= {"n_words": pa.array(n), "n_repeat_words": pa.array(repeated), "base_failed": pa.array(failed)}
            found |= {"probability": pa.array(chance), "kept": pa.array(kept)}
            order = [f.split(" ")[0] for f in VERDICT.split(", ")]
            yield pa.RecordBatch.from_arrays([found[c] for c in order], order)

    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    inputs = [text.alias("text"), word_hashes(text).alias("hashes")]
    if filtered:
        given = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), *inputs)
        return given.mapInArrow(run, docs.schema)
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(SPACES)) != "")
    # The lines as the one entry of an array, so that they are made once.
    repeats = F.transform(F.array(lines), lambda x: F.size(x) - F.size(F.array_distinct(x)))[0]
    given = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        *inputs,
        F.char_length(F.translate(text, SPACES, "")).cast("long").alias("word_chars"),
        (F.char_length(text) - F.char_length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        repeats.cast("long").alias("n_dup_lines"),
    )
    return given.mapInArrow(run, VERDICT)


def quality(docs: DataFrame, labels: DataFrame, label: str = "quality", settings: Settings | None = None) -> DataFrame:
    """Counts, probability and verdict of all rows of ``docs``, by a model trained on ``labels``, whose 1 means good."""
    settings = settings or Settings()
    return _judged(docs, fit(docs, labels, label, settings), settings, False)


def keep_good(docs: DataFrame, labels: DataFrame, label: str = "quality", settings: Settings | None = None) -> DataFrame:
    """The rows of ``docs`` whose verdict is to keep them, with all their columns."""
    settings = settings or Settings()
    return _judged(docs, fit(docs, labels, label, settings), settings, True)
