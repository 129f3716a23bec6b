"""Periodic runs of words by online dyadic square catching.

A run is a stretch of consecutive words with smallest period q that no neighbouring word
extends, here one of at least ``least_repeats * q`` words and ``least_words``. Words are
appended one by one. On every level, L = 2, 4, 8, ..., the completed blocks of L/2 words
make catchers: a catcher waits for the L words of two adjacent blocks to come again, p <= L
words later, by comparing the longest suffix of the text that begins like its own words
(the failure function tells how far to fall back). If they do, the words from its
beginning to now are a square of period p (or more), since they overlap or touch. Only the first such
p matters: if the words came again at two distances p < p' <= L, the larger would be a
multiple of the smaller one (Fine and Wilf). So a catcher reports once, has p > L/2 or leaves the
square to a lower level, and is gone after L words. Reported squares that end
now and have the same period belong to one run: it is extended to the left once, at
most L words, and then grows with each appended word that equals the one p before.

A run of 4 q words contains the catcher's words and their repetition for the level with
L/2 < q <= L, wherever it begins. So with ``least_repeats`` of 4 or more no run is missed. Each word
costs a bounded number of steps on each level: n log n for a text of n words.

What spares steps without changing results: a word whose previous occurrence is more than
L words back cannot be in a repetition that a catcher of level L waits for. So a catcher sleeps
for L/2 words, and begins to compare only if all of these are familiar. Before that, the
stretches of familiar words that are too short for a run on any level are found for all texts of a
batch at once, and the rest, with L words before it, is appended to.

Words are ``[^\\x20\\x09-\\x0D]+`` of whole texts, compared by their bytes. A null text is empty. Rows
with equal or null ``doc_id`` are searched each by itself. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from starloom.llm.tables import documents, slices, words

LEAST_REPEATS, LEAST_WORDS = 4, 6


class Catcher:
    """Waits for ``size`` words from ``begin`` on to come again; awake once the text has 3/2 times as many words from there."""

    __slots__ = ("begin", "size", "matched", "fallback", "own")

    def __init__(self, text: list, begin: int, size: int):
        self.begin, self.size, self.own = begin, size, text[begin : begin + size]
        own = self.own
        self.fallback = fallback = [0] * (size + 1)  # longest proper border of each beginning
        k = 0
        for i in range(1, size):
            while k and own[i] != own[k]:
                k = fallback[k]
            if own[i] == own[k]:
                k += 1
            fallback[i + 1] = k
        self.matched = k
        for word in text[begin + size :]:
            if self.append(word):
                break

    def append(self, word) -> bool:
        """Whether the own words have just come again."""
        k, own = self.matched, self.own
        if k == self.size:
            return True
        while k and own[k] != word:
            k = self.fallback[k]
        if own[k] == word:
            k += 1
        self.matched = k
        return k == self.size


class SquareCatchers:
    """Catchers on all levels and the runs that grow; ``append`` words, then ``finish``."""

    def __init__(self, least_repeats: int = LEAST_REPEATS, least_words: int = LEAST_WORDS):
        if least_repeats < 4:
            raise ValueError("shorter runs may lie between the blocks; least_repeats must be 4 or more")
        self.least_repeats, self.least_words = least_repeats, least_words
        self.text: list = []
        self.last: dict = {}  # place of each word's last occurrence
        self.strange = [-1] * 64  # by level: place of the last word that came again from beyond 2**level words
        self.catchers: list[Catcher] = []
        self.growing: dict[int, int] = {}  # period -> start
        self.runs: list[tuple[int, int, int]] = []

    def append(self, word) -> None:
        text, growing = self.text, self.growing
        m = len(text)
        if growing:
            for period in [p for p in growing if text[m - p] != word]:
                self._close(period, m)
        before = self.last.get(word)
        self.last[word] = m
        text.append(word)
        m += 1
        # Levels with 2**level < distance: the word is strange to them and to those below.
        distance = 64 if before is None else (m - 2 - before).bit_length()
        strange = self.strange
        for level in range(min(distance, m.bit_length())):
            strange[level] = m - 1
        if self.catchers:
            self.catchers = [c for c in self.catchers if self._advance(c, word, m)]
        # Catchers that wake up now: those whose beginning, a multiple of half their size, is 3/2 sizes back.
        level = 1
        while True:
            half = 1 << level - 1
            if m % half or m < 3 * half:
                break
            if strange[level] < m - half:
                self._wake(m - 3 * half, 2 * half, m)
            level += 1

    def _wake(self, begin: int, size: int, m: int) -> None:
        # A run of small period from there to now is another level's.
        if size > 2 and any(2 * p <= size and start <= begin for p, start in self.growing.items()):
            return
        catcher = Catcher(self.text, begin, size)
        if catcher.matched < size:
            self.catchers.append(catcher)
        elif size == 2 and self.text[begin] == self.text[begin + 2]:
            self._report(begin, 1, m)  # three words in a row; no level is below

    def _advance(self, catcher: Catcher, word, m: int) -> bool:
        """Whether the catcher waits on; a square is reported."""
        if catcher.append(word):
            self._report(catcher.begin, m - catcher.begin - catcher.size, m)
            return False
        return m < catcher.begin + 2 * catcher.size and self.strange[catcher.size.bit_length() - 1] < m - 1

    def _report(self, begin: int, period: int, m: int) -> None:
        """The words from ``begin`` to now have this period: a new run, or part of one that grows."""
        if period in self.growing:
            return
        text = self.text
        while begin and text[begin - 1] == text[begin - 1 + period]:
            begin -= 1
        self.growing[period] = begin

    def _close(self, period: int, end: int) -> None:
        start = self.growing.pop(period)
        if end - start >= max(self.least_words, self.least_repeats * period):
            self.runs.append((start, end - start, period))

    def finish(self) -> list[tuple[int, int, int]]:
        """All runs as ``start, length, period``, by start, then period."""
        for period in list(self.growing):
            self._close(period, len(self.text))
        return sorted(self.runs, key=lambda r: (r[0], r[2]))


def runs_of(text: Iterable, least_repeats: int = LEAST_REPEATS, least_words: int = LEAST_WORDS) -> list[tuple[int, int, int]]:
    """The runs of one sequence."""
    catchers = SquareCatchers(least_repeats, least_words)
    for word in text:
        catchers.append(word)
    return catchers.finish()


def familiar_stretches(numbers: np.ndarray, first: np.ndarray, least_repeats: int, least_words: int) -> np.ndarray:
    """Stretches ``begin, end`` of words that can hold runs, for texts that begin at ``first`` in ``numbers`` and share no number.

    A run of period q <= L has, behind its first q words, only words that occurred at most L
    words before. No run is in two stretches or partly in one.
    """
    n = len(numbers)
    order = np.argsort(numbers, kind="stable")
    back = np.full(n, n + 1, np.int64)
    alike = numbers[order[1:]] == numbers[order[:-1]]
    back[order[1:][alike]] = (order[1:] - order[:-1])[alike]
    longest = int(np.diff(np.append(first, n)).max(initial=0))
    found, level = [], 2
    while level == 2 or least_repeats * (level // 2 + 1) <= longest:
        # Words that no run of this level has behind its first period; texts do not touch.
        strange = np.flatnonzero(back > level)
        edges = np.concatenate([[-1], strange, [n]])
        least_period = level // 2 + 1 if level > 2 else 1
        least = max(least_words - level, (least_repeats - 1) * least_period)
        wide = np.flatnonzero(np.diff(edges) > least)
        found += [(a + 1 - level, b) for a, b in zip(edges[wide].tolist(), edges[wide + 1].tolist())]
        level *= 2
    if not found:
        return np.zeros((0, 2), np.int64)
    # A stretch may reach back into the text before.
    found = np.array(found, np.int64)
    own = first[np.searchsorted(first, found[:, 1] - 1, "right") - 1]
    found[:, 0] = np.maximum(found[:, 0], own)
    found = found[np.argsort(found[:, 0], kind="stable")]
    ends = np.maximum.accumulate(found[:, 1])
    apart = np.flatnonzero(found[1:, 0] >= ends[:-1]) + 1
    return np.stack([found[np.append(0, apart), 0], ends[np.append(apart - 1, len(found) - 1)]], 1)


def kept_words(n: int, runs: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """Stretches ``begin, end`` of the words that no run has behind its first period, of ``n`` words."""
    kept, at = [], 0
    for begin, end in sorted((s + q, s + length) for s, length, q in runs):
        if begin > at:
            kept.append((at, begin))
        at = max(at, end)
    return kept + [(at, n)] if at < n else kept


def periodic_runs(docs: DataFrame, least_repeats: int = LEAST_REPEATS, least_words: int = LEAST_WORDS) -> DataFrame:
    """``doc_id, n_words, runs, collapsed`` of every row of ``docs``.

    ``runs`` is an array of ``start, length, period`` by start, then period; ``collapsed`` the text
    without the words that a run has behind its first period, joined by single spaces.
    """
    if least_repeats < 4:
        raise ValueError("least_repeats must be 4 or more")
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text", 4 << 20):
            texts = [t.as_buffer().to_pybytes().split() for t in part.column("text").cast(pa.binary())]
            sizes = np.array([len(t) for t in texts], np.int64)
            first = np.cumsum(sizes) - sizes
            # A word's number is the place of its first occurrence.
            numbers: list[int] = []
            for text, begin in zip(texts, first.tolist()):
                seen: dict[bytes, int] = {}
                numbers += [seen.setdefault(w, i) for i, w in enumerate(text, begin)]
            full = first[sizes > 0]
            stretches = familiar_stretches(np.array(numbers, np.int64), full, least_repeats, least_words)
            runs: list[list[tuple[int, int, int]]] = [[] for _ in texts]
            owners = np.flatnonzero(sizes > 0)[np.searchsorted(full, stretches[:, 0], "right") - 1] if len(stretches) else []
            for (begin, end), owner in zip(stretches.tolist(), owners):
                shift = begin - int(first[owner])
                runs[owner] += [(s + shift, length, q) for s, length, q in runs_of(numbers[begin:end], least_repeats, least_words)]
            collapsed = [
                b" ".join(t) if not own else b" ".join(w for a, b in kept_words(len(t), own) for w in t[a:b]) for t, own in zip(texts, runs)
            ]
            as_rows = [[{"start": s, "length": length, "period": q} for s, length, q in own] for own in runs]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(sizes), pa.array(as_rows, kind), pa.array(collapsed, pa.binary()).cast(pa.string())],
                ["doc_id", "n_words", "runs", "collapsed"],
            )

    return documents(docs).mapInArrow(
        run, "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"
    )


def planted(docs: DataFrame) -> DataFrame:
    """``doc_id, text`` with the words of some documents, chosen by a checksum of the id, replaced by a periodic tail."""
    own = documents(docs).withColumn("h", F.crc32(F.col("doc_id").cast("string").cast("binary")))
    g = F.floor(F.col("h") / 10)

    def tail(w: Column) -> Column:
        n = F.size(w)
        a = F.pmod(g, n).cast("int")
        p = (1 + F.floor((n - a) / (3 + F.pmod(g, F.lit(8))))).cast("int")
        parts = lambda x: F.concat(
            F.slice(w, F.lit(1), x["a"]),
            F.transform(F.sequence(F.lit(0), n - x["a"] - 1), lambda i: F.get(w, x["a"] + F.pmod(i, x["p"]))),
        )
        joined = F.transform(F.array(F.struct(a.alias("a"), p.alias("p"))), lambda x: F.array_join(parts(x), " "))[0]
        return F.when(n > 0, joined).otherwise("")

    new = F.transform(F.array(words(F.col("text"))), tail)[0]
    chosen = F.coalesce(F.pmod(F.col("h"), F.lit(10)) == 0, F.lit(False))
    return own.select("doc_id", F.when(chosen, new).otherwise(F.col("text")).alias("text"))


def run_digest(found: DataFrame) -> DataFrame:
    """Number of runs, the one with the greatest exact length/period, and digests of all runs and of the collapsed text."""
    runs = F.col("runs")
    # Products of whole numbers decide; the first of equals stays.
    higher = lambda r, best: best["start"].isNull() | (r["length"] * best["period"] > best["length"] * r["period"])
    none = F.lit(None).cast("struct<start: bigint, length: bigint, period: bigint>")
    best = F.aggregate(runs, none, lambda best, r: F.when(higher(r, best), r).otherwise(best))
    line = lambda r: F.concat_ws(",", *(r[c].cast("string") for c in ("start", "length", "period")))
    lines = F.array_join(F.transform(runs, lambda r: F.concat(line(r), F.lit("\n"))), "")
    sha = lambda text: F.sha2(text.cast("binary"), 256)
    return found.withColumn("best", best).select(
        "doc_id",
        F.size(runs).cast("long").alias("n_runs"),
        *(F.col(f"best.{c}").alias(c) for c in ("start", "length", "period")),
        F.floor(F.expr("(1000 * best.length) div best.period")).alias("exponent_milli"),
        sha(lines).alias("runs_sha256"),
        sha(F.col("collapsed")).alias("collapsed_sha256"),
    )
