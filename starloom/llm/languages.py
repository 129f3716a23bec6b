"""Language identification by cross-parsing: which language's sample says a text in the fewest phrases.

For every language a suffix automaton of a sample of labelled text is built: it accepts
exactly the strings that occur in the sample. A text is read through it from left to right;
as long as there is a transition the phrase goes on, else a new one begins. So
each phrase is the longest match from its start, and the number of phrases is the least
possible. Phrases times log2(length of the sample), over the text's bytes, estimates the
cross entropy in bits a byte (Ziv and Merhav); the language with the lowest estimate wins.

Texts are compared in lower case, with one space for all that is not a letter or a mark,
as UTF-8 bytes, so that any script has at most 256 symbols. Automata are dense tables over
the bytes that samples contain; a byte unknown to a language is a phrase. All languages read
blocks of ``BLOCK`` bytes side by side, one byte of every block at a time; a phrase ends
where its block does, at most one phrase more for each block, in every language alike.

The sample: rows with id, text and language that are not held out, chosen by a hash of
their text (equal texts count once), at most ``piece_chars`` letters and spaces of each,
``sample_bytes`` for a language and ``total_bytes`` for all. Counts for the choice cover all rows.

A null text, or one without a letter, is ``und`` with score 0, as is everything if no
language was learned. The score is the runner-up's estimate over the sum of both, 0.5 to 1; 1 if
there is a single language. Ties go to the language with more labelled rows, then to the smaller
name. Rows with equal or null ``doc_id`` are predicted each by itself. An empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from starloom.llm.tables import slices

BLOCK = 1024
UNDETERMINED = "und"
_BETWEEN = b"\n"  # between the sample's pieces; no text that is read has it
_HASHES = 1 << 30


@dataclass
class Samples:
    """Bounds on what is learned from."""

    sample_bytes: int = 32 << 10
    total_bytes: int = 256 << 10
    piece_chars: int = 2048
    rows: int = 128  # asked for at first; more if their texts are too short


def plain(text: Column) -> Column:
    """Lower-case words with a space on either side; a single space if there is no letter."""
    words = F.trim(F.regexp_replace(F.lower(text), "[^\\p{L}\\p{M}]+", " "))
    return F.concat(F.lit(" "), words, F.when(words == "", "").otherwise(" "))


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike("\\p{L}"), F.lit(False))


def held_out(doc_id: Column) -> Column:
    """Whether nothing may be learned from this document."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def automaton(text: bytes) -> list[dict[int, int]]:
    """The suffix automaton of ``text``: transitions of each state, 0 the first. At most twice as many states as bytes."""
    moves: list[dict[int, int]] = [{}]
    longest, link = [0], [-1]
    last = 0
    for byte in text:
        new = len(moves)
        moves.append({})
        longest.append(longest[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and byte not in moves[p]:
            moves[p][byte] = new
            p = link[p]
        if p >= 0:
            q = moves[p][byte]
            if longest[q] == longest[p] + 1:
                link[new] = q
            else:
                # The strings of q that are suffixes now get a state of their own.
                split = len(moves)
                moves.append(dict(moves[q]))
                longest.append(longest[p] + 1)
                link.append(link[q])
                while p >= 0 and moves[p].get(byte) == q:
                    moves[p][byte] = split
                    p = link[p]
                link[q] = link[new] = split
        last = new
    return moves


class Languages:
    """The automata of all languages as one list of transitions; tables are made where texts are read."""

    def __init__(self, samples: dict[str, bytes]):
        self.names = list(samples)
        self.bits = np.array([math.log2(len(s) + 1) for s in samples.values()])
        used = sorted({byte for s in samples.values() for byte in s})
        self.symbol = np.zeros(256, np.int64)  # 0 for bytes that no sample has
        self.symbol[used] = np.arange(1, len(used) + 1)
        self.size = len(used) + 1
        # State 0 has no transitions: there a phrase begins.
        self.roots, self.states = [], 1
        source, symbol, target = [], [], []
        for s in samples.values():
            moves = automaton(s)
            self.roots.append(self.states)
            for state, out in enumerate(moves):
                source += [self.states + state] * len(out)
                symbol += out.keys()
                target += [self.states + t for t in out.values()]
            self.states += len(moves)
        self.source, self.target = np.array(source, np.int32), np.array(target, np.int32)
        self.by = np.array(symbol, np.uint8)

    def tables(self) -> tuple[np.ndarray, np.ndarray]:
        """Where each symbol leads from each state, states as places of their rows; and the rows of the roots."""
        table = np.zeros(self.states * self.size, np.int32)
        table[self.source.astype(np.int64) * self.size + self.symbol[self.by]] = self.target * self.size
        roots = np.array(self.roots, np.int64)[:, None] * self.size + np.arange(self.size)
        return table, table[roots] if len(self.roots) else np.zeros((0, self.size), np.int32)

    def phrases(self, tables: tuple[np.ndarray, np.ndarray], data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Phrases of each text, a column for each language; text i is ``sizes[i]`` bytes of ``data`` from ``starts[i]`` on."""
        table, roots = tables
        blocks = -(-sizes // BLOCK)
        of = np.repeat(np.arange(len(sizes)), blocks)
        first = np.arange(len(of)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
        at = starts[of] + first * BLOCK
        left = np.minimum(sizes[of] - first * BLOCK, BLOCK)
        order = np.argsort(-left, kind="stable")
        of, at, left = of[order], at[order], left[order]
        # How many blocks are longer than each place.
        active = len(left) - np.searchsorted(left[::-1], np.arange(BLOCK), "right")
        symbols = self.symbol[data]
        counts = np.zeros((len(self.names), len(of)), np.int32)
        states = np.zeros((len(self.names), len(of)), np.int32)
        for place, n in enumerate(active.tolist()):
            if not n:
                break
            now = symbols[at[:n] + place]
            for number, root in enumerate(roots):
                own = states[number, :n]
                reached = table.take(now + own)
                begins = reached == 0
                counts[number, :n] += begins
                np.copyto(own, np.where(begins, root.take(now), reached))
        out = np.zeros((len(sizes), len(self.names)))
        for number in range(len(self.names)):
            out[:, number] = np.bincount(of, counts[number], len(sizes))
        return out

    def best(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of the winning language and the score for each row of phrase counts."""
        bits = phrases * self.bits
        winner = bits.argmin(1)
        if len(self.names) == 1:
            return winner, np.ones(len(bits))
        two = np.sort(bits, 1)[:, :2]
        return winner, two[:, 1] / np.maximum(two.sum(1), 1e-300)


def learn(docs: DataFrame, settings: Samples | None = None) -> Languages:
    """Languages from the labelled rows of ``docs`` (``doc_id, text, lang``) that are not held out."""
    settings = settings or Samples()
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    own = own.where(F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & has_letter(F.col("text")) & ~held_out(F.col("doc_id")))
    counts = {r["lang"]: r["n"] for r in own.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    # Ties between languages go to the first.
    names = sorted(counts, key=lambda name: (-counts[name], name))
    most = min(settings.sample_bytes, settings.total_bytes // max(1, len(names)))
    own = own.withColumn("hash", F.pmod(F.xxhash64("text"), F.lit(_HASHES)))
    samples: dict[str, bytes] = {}
    wanted, rows = names, settings.rows
    while wanted:
        below = [(name, min(_HASHES, -(-_HASHES * rows // counts[name]))) for name in wanted]
        limits = own.sparkSession.createDataFrame(below, "lang string, below long")
        # About ``rows`` different texts of each language, whose pieces the bounds cut.
        chosen = own.join(F.broadcast(limits), "lang").where("hash < below")
        chosen = chosen.select("lang", "hash", F.substring(plain(F.col("text")), 1, settings.piece_chars).alias("piece"))
        pieces: dict[str, list] = {name: [] for name in wanted}
        for r in chosen.groupBy("lang", "hash").agg(F.min("piece").alias("piece")).collect():
            pieces[r["lang"]].append((r["hash"], r["piece"]))
        short = []
        for name, below_ in below:
            text = _BETWEEN.join(p.encode() for _, p in sorted(pieces[name]))[:most]
            samples[name] = text
            if len(text) < most and below_ < _HASHES:
                short.append(name)
        wanted, rows = short, rows * 8
    return Languages({name: samples[name] for name in names})


def predict(docs: DataFrame, languages: Languages) -> DataFrame:
    """``doc_id, lang_pred, score, phrases`` of every row of ``docs``, the last one the winner's number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = None
        for part in slices(batches, "plain"):
            tables = tables or languages.tables()
            texts = part.column("plain")
            offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
            data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
            known = np.asarray(part.column("known"))
            sizes = np.where(known, np.diff(offsets), 0)
            counts = languages.phrases(tables, data, offsets[:-1] - offsets[0], sizes)
            winner, score = languages.best(counts)
            names = pa.array(languages.names).take(pa.array(winner))
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    pa.array([n if k else UNDETERMINED for n, k in zip(names.to_pylist(), known.tolist())], pa.string()),
                    pa.array(np.where(known, score, 0.0)),
                    pa.array(np.where(known, counts[np.arange(len(winner)), winner], 0).astype(np.int64)),
                ],
                ["doc_id", "lang_pred", "score", "phrases"],
            )

    text = F.col("text").cast("string")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text")).select(
        "doc_id", F.coalesce(plain(F.col("text")), F.lit(" ")).alias("plain"), has_letter(F.col("text")).alias("known")
    )
    if not languages.names:
        return rows.select("doc_id", F.lit(UNDETERMINED).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(0).cast("long").alias("phrases"))
    return rows.mapInArrow(run, "doc_id long, lang_pred string, score double, phrases long")


def identified(docs: DataFrame, settings: Samples | None = None) -> DataFrame:
    """``doc_id, held_out, lang_pred, score, phrases`` of every row of ``docs``; learns from rows that are not held out."""
    found = predict(docs, learn(docs, settings))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "phrases")
