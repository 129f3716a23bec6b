"""Numbers of byte-pair tokens, by merging with a heap and a linked list.

A word's symbols stand in a linked list and its adjacent pairs in a heap by the
rank of their merge. The pair of lowest rank, the leftmost of equals, is popped
and merged until no pair has a rank. The word has as many tokens as it had
symbols at first less its merges, and only that number is kept.

Null texts are empty and have 0 tokens. Repeated rows are counted each by
itself; a null ``doc_id`` stays null; an empty table gives no rows.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from starloom.llm.tables import documents, slices
from starloom.llm.token_ids import byte_signs

# How the vocabulary file cuts normalized text into words, for texts of ASCII characters.
_ASCII_WORDS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\sa-z0-9]+", re.ASCII)

_COUNTERS: dict[str, TokenCounter] = {}


def count_after_merges(symbols: list[int], merges: dict[tuple[int, int], tuple[int, int]]) -> int:
    """Number of symbols that are left once no adjacent pair has a merge; ``merges`` has rank and new symbol of a pair."""
    n = len(symbols)
    if n < 2:
        return n
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(*merges[pair], i) for i, pair in enumerate(zip(symbols, symbols[1:])) if pair in merges]
    if not heap:
        return n
    # (rank, new symbol, place): a rank has one new symbol, so equal ranks come out from left to right.
    heapq.heapify(heap)
    merged = 0
    while heap:
        rank, new, i = heapq.heappop(heap)
        right = after[i]
        # The entry is stale unless both of its symbols are still there, side by side.
        if symbols[i] < 0 or right >= n or merges.get((symbols[i], symbols[right])) != (rank, new):
            continue
        symbols[i], symbols[right] = new, -1
        after[i] = following = after[right]
        merged += 1
        if following < n:
            before[following] = i
            if pair := merges.get((new, symbols[following])):
                heapq.heappush(heap, (*pair, i))
        if (left := before[i]) >= 0 and (pair := merges.get((symbols[left], new))):
            heapq.heappush(heap, (*pair, left))
    return n - merged


class TokenCounter:
    """Counts tokens as the library does for a file whose words end in a marked symbol.

    Normal forms and words of texts beyond ASCII come from the library's own
    steps. Up to ``keep`` words and pieces are remembered, then it starts afresh.
    """

    def __init__(self, path: str, keep: int = 500_000):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocab, suffix = spec["model"]["vocab"], spec["model"]["end_of_word_suffix"]
        self.tokenizer, self.keep = Tokenizer.from_file(path), keep
        special = [t["content"] for t in spec["added_tokens"]]
        self.special = re.compile("|".join(re.escape(s) for s in sorted(special, key=len, reverse=True)))
        self.marks = special
        signs = {s: i for s, i in vocab.items() if len(s) == 1}
        self.inner, self.last = signs, {s: vocab[s + suffix] for s in signs if s + suffix in vocab}
        self.merges = {}
        for rank, (a, b) in enumerate(tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in spec["model"]["merges"]):
            self.merges.setdefault((vocab[a], vocab[b]), (rank, vocab[a + b]))
        self.words: dict[str, int] = {}
        self.pieces: dict[str, int] = {"": 0}

    def word(self, signs: str) -> int:
        """Tokens of one word, given as the signs of its bytes."""
        found = self.words.get(signs)
        if found is None:
            # As in the library, a sign that the vocabulary lacks is left out.
            symbols = [self.inner.get(s) for s in signs[:-1]] + [self.last.get(signs[-1])]
            found = self.words[signs] = count_after_merges([s for s in symbols if s is not None], self.merges)
        return found

    def piece(self, text: str) -> int:
        """Tokens of a text without spaces, line feeds and special strings."""
        if text.isascii():
            found = _ASCII_WORDS.findall(text.lower())
            return sum(map(self.word, found if text.isprintable() else map(byte_signs, found)))
        whole = self.tokenizer.normalizer.normalize_str(text)
        return sum(self.word(w) for w, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(whole) if w)

    def count(self, text: str) -> int:
        total = 0
        if any(mark in text for mark in self.marks):
            parts = self.special.split(text)
            total += len(parts) - 1
        else:
            parts = (text,)
        pieces = self.pieces
        for part in parts:
            # No word holds a space or a line feed, and no normal form depends on what stands behind one.
            for p in part.replace("\n", " ").split(" "):
                n = pieces.get(p)
                if n is None:
                    if len(pieces) > self.keep:
                        pieces.clear()
                    if len(self.words) > self.keep:
                        self.words.clear()
                    n = pieces[p] = self.piece(p)
                total += n
        return total


def counter(path: str) -> TokenCounter:
    """This process's counter for the file at ``path``."""
    if path not in _COUNTERS:
        _COUNTERS[path] = TokenCounter(path)
    return _COUNTERS[path]


def token_counts(docs: DataFrame, tokenizer_path: str, limit: int = 2048) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every row of ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = counter(tokenizer_path)
        for part in slices(batches, "text"):
            texts = part.column("text").to_pylist()
            tokens = np.array([own.count(t) for t in texts], np.int64)
            sizes = np.asarray(pc.binary_length(part.column("text")), np.int64)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(sizes), pa.array(tokens), pa.array(tokens > limit)],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    return documents(docs).mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
