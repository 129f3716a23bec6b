"""Token ids of whole texts by the tokenizers library.

White space between words goes to the word behind it, so a text falls apart at
each single space between two words into pieces that have the same ids alone as
within it. A piece falls apart once more where letters, digits and marks meet,
which the library always cuts from each other. A task encodes each distinct
part once and puts texts together from them, which needs a fraction of the time
that whole texts take.
"""

from __future__ import annotations

import os
import re
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from starloom.llm.tables import spread

END_ID = 0

# White space, in Python's sense, that is not a space or line feed by itself between two other characters.
_UNEVEN = "^ | $|  |\n |\\A\\n| \n|[\t\v\f\r\x1C-\x1F\u0085\u00A0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000]"
_SINGLE_SPACE = re.compile(r"(?<=\S) (?=\S)")
# Letters, digits, marks (all but the apostrophe, which goes with letters): an atom is a run of one kind, with a space in front or not.
_KINDS = "[A-Za-z\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u00FF]+", "[0-9]+", r"[!-&(-/:-@\[-`{-~]+"
_RUN = f"(?:{'|'.join(_KINDS)})"
_ATOM = rf"\A(?: ?{_RUN}|\n)\z"
# Pieces that are made of atoms; a line feed between two of them is one as well.
_ATOMS = rf"\A ?{_RUN}+(?:\n{_RUN}+)*\z"
# All atoms but letters behind another atom, which are what is left between these.
_EDGES, _EDGE = f"( ?(?:{_KINDS[1]}|{_KINDS[2]})|\n)", "\x1E"
_ENCODERS: dict[str, PieceEncoder] = {}


def _sign_table() -> dict[int, int]:
    """The library's sign for each byte: itself if it is visible, else one of those from U+0100 on, in order."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in visible]
    return {b: b for b in visible} | {b: 0x100 + i for i, b in enumerate(hidden)}


_SIGNS = _sign_table()


def byte_signs(text: str) -> str:
    """The signs by which the library's files write the bytes of ``text``."""
    return text.encode().decode("latin-1").translate(_SIGNS)


class _Numbers(dict):
    """Numbers keys in the order of their first use."""

    def __missing__(self, key: str) -> int:
        self[key] = number = len(self)
        return number


class PieceEncoder:
    """Encodes lists of texts; remembers about ``keep`` pieces. Beyond that, pieces that came up only once are forgotten."""

    def __init__(self, path: str, keep: int = 500_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.keep = Tokenizer.from_file(path), keep
        # Words that the library looks for in whole texts.
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.forget()

    def forget(self) -> None:
        self.numbers = _Numbers()
        self.starts = np.zeros(0, np.int64)
        self.lengths = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)
        self.uses = np.zeros(0, np.int64)

    def _keep_repeated(self) -> None:
        """Keep the pieces used twice or more, or nothing if those are too many as well."""
        often = np.flatnonzero(self.uses > 1)
        if len(often) > self.keep * 3 // 4:
            self.forget()
            return
        keys = list(self.numbers)
        self.numbers = _Numbers(zip([keys[i] for i in often.tolist()], range(len(often))))
        self.ids = self.ids[spread(self.starts[often], self.lengths[often])]
        self.lengths = self.lengths[often]
        self.starts = np.cumsum(self.lengths) - self.lengths
        # From here on a piece has to come up again to be kept the next time.
        self.uses = np.ones(len(often), np.int64)

    def _added_in(self, keys: pa.Array) -> np.ndarray:
        """Whether a key holds a word that the library looks for in whole texts."""
        found = np.zeros(len(keys), bool)
        for word in self.added:
            found |= np.asarray(pc.match_substring(keys, word))
        return found

    def _plain(self, keys: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of keys one after the other and their numbers."""
        tokenize, ids, counts, other = self.tokenizer.model.tokenize, [], [0] * len(keys), []
        texts = pa.array(keys, pa.string())
        atom = np.asarray(pc.match_substring_regex(texts, _ATOM)) & ~self._added_in(texts)
        for i, (key, alone) in enumerate(zip(keys, atom.tolist())):
            if not alone:
                other.append(i)
                continue
            # An atom is one word for the library; its model reads it byte for byte.
            if key.isascii() and key != "\n":
                found = tokenize("\u0120" + key[1:] if key[0] == " " else key)
            else:
                found = tokenize(byte_signs(key))
            ids += [t.id for t in found]
            counts[i] = len(found)
        ids, counts = np.array(ids, np.uint32), np.array(counts, np.int64)
        if not other:
            return ids, counts
        places = np.repeat(np.arange(len(keys)), counts)
        found = self.tokenizer.encode([keys[i] for i in other], is_pretokenized=True, add_special_tokens=False)
        if len(found.ids):
            of = np.array(found.word_ids, np.int64)
            counts[other] = np.bincount(of, minlength=len(other))
            places = np.concatenate([places, np.array(other)[of]])
        both = np.concatenate([ids, np.array(found.ids, np.uint32)])
        return both[np.argsort(places, kind="stable")], counts

    def _learn(self, known: int) -> None:
        """Ids of the keys numbered from ``known`` on."""
        ids, counts = self._plain(list(islice(self.numbers, known, None)))
        self.starts = np.concatenate([self.starts, len(self.ids) + np.cumsum(counts) - counts])
        self.lengths = np.concatenate([self.lengths, counts])
        self.ids = np.concatenate([self.ids, ids])

    def _numbers_of(self, keys: pa.Array) -> np.ndarray:
        return np.fromiter(map(self.numbers.__getitem__, keys.to_numpy(zero_copy_only=False).tolist()), np.int64, len(keys))

    def _cut(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the parts of pieces one after the other and how many parts each has; cut outside of Python."""
        cut = np.asarray(pc.match_substring_regex(pieces, _ATOMS)) & ~np.asarray(pc.match_substring_regex(pieces, _ATOM))
        cut &= ~self._added_in(pieces)
        lists = pc.split_pattern(pc.replace_substring_regex(pieces.filter(pa.array(cut)), _EDGES, f"{_EDGE}\\1{_EDGE}"), _EDGE)
        full = np.asarray(pc.binary_length(lists.values)) > 0
        coded = lists.values.filter(pa.array(full)).dictionary_encode()
        sizes = np.ones(len(pieces), np.int64)
        sizes[cut] = np.diff(np.concatenate([[0], np.cumsum(full)])[np.asarray(lists.offsets)])
        starts = np.cumsum(sizes) - sizes
        codes = np.empty(int(sizes.sum()), np.int64)
        codes[starts[~cut]] = self._numbers_of(pieces.filter(pa.array(~cut)))
        codes[spread(starts[cut], sizes[cut])] = self._numbers_of(coded.dictionary)[np.asarray(coded.indices)]
        return codes, sizes

    def _even(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        """Distinct pieces of texts whose spaces all stand between two words, the places there of all pieces, and each text's number."""
        lists = pc.split_pattern(texts, " ")
        offsets = np.asarray(lists.offsets, np.int64)
        coded = lists.values.slice(offsets[0], offsets[-1] - offsets[0]).dictionary_encode()
        starts, which = offsets[:-1] - offsets[0], np.array(coded.indices, np.int64)
        # The first piece of a text has no space in front.
        first = coded.dictionary.take(coded.indices.take(pa.array(starts)))
        which[starts] = len(coded.dictionary) + np.arange(len(texts))
        space, none = pa.scalar(" ", first.type), pa.scalar("", first.type)
        return pa.concat_arrays([pc.binary_join_element_wise(space, coded.dictionary, none), first]), which, np.diff(offsets)

    def _uneven(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        """The same of any texts."""
        pieces, counts = [], []
        for text in texts.to_pylist():
            first, *others = _SINGLE_SPACE.split(text)
            pieces.append(first)
            pieces += [" " + x for x in others]
            counts.append(len(others) + 1)
        coded = pa.array(pieces, texts.type).dictionary_encode()
        return coded.dictionary, np.array(coded.indices, np.int64), np.array(counts, np.int64)

    def _parts(self, pieces: pa.Array, which: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of all parts of texts one after the other and how many each text has."""
        codes, sizes = self._cut(pieces)
        size = sizes[which]
        return codes[spread((np.cumsum(sizes) - sizes)[which], size)], np.add.reduceat(size, np.cumsum(counts) - counts)

    def encode(self, texts: pa.Array, end: int | None = END_ID) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after the other, each text's followed by ``end``, and the number of ids of each text."""
        if not len(texts):
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        if len(self.numbers) > self.keep:
            self._keep_repeated()
        known = len(self.numbers)
        uneven = np.asarray(pc.match_substring_regex(texts, _UNEVEN))
        if not uneven.any():
            codes, counts = self._parts(*self._even(texts))
        elif uneven.all():
            codes, counts = self._parts(*self._uneven(texts))
        else:
            parts = [self._parts(*f(texts.filter(pa.array(x)))) for f, x in ((self._even, ~uneven), (self._uneven, uneven))]
            rows = np.concatenate([np.flatnonzero(~uneven), np.flatnonzero(uneven)])
            both, counts = (np.concatenate(x) for x in zip(*parts))
            back = np.argsort(rows)
            codes = both[spread((np.cumsum(counts) - counts)[back], counts[back])]
            counts = counts[back]
        if len(self.numbers) > known:
            self._learn(known)
        uses = np.bincount(codes, minlength=len(self.numbers))
        uses[: len(self.uses)] += self.uses
        self.uses = uses
        size = self.lengths[codes]
        ids = self.ids[spread(self.starts[codes], size)]
        lengths = np.add.reduceat(size, np.cumsum(counts) - counts)
        if end is not None:
            ids = np.insert(ids, np.cumsum(lengths), end)
            lengths = lengths + 1
        return ids, lengths


def encoder(path: str) -> PieceEncoder:
    """This process's encoder for the file at ``path``."""
    if path not in _ENCODERS:
        _ENCODERS[path] = PieceEncoder(path)
    return _ENCODERS[path]
