"""Ids put together from the parts of texts against the library's own of whole texts."""

import random

import numpy as np
import pyarrow as pa
import pytest

from starloom.llm.queries import BYTE_BPE, vocabulary
from starloom.llm.token_ids import PieceEncoder

SIGNS = [
    *"aBé1²٣ł日ا.,'-_#<>|$!&(/:@[`{~\\Ġ", "the", "ß", "ª", "½", "'s", "<|endoftext|>", "<|", "|>", "endoftext", "😀", "́",
    "\n", "\n", " ", " ", " ", " ", "  ", "\t", "\r", "\x1e", "\x00", "\x7f", " ", "　", "​",
]
WORDS = ["word", "Über", "naïve", "x1", "a.b", "end.\nNext", "foo,bar", "(x)", "don't", "3.14", "A\nB", "é,è", "--", "…", "<b>", "a###"]


def made_text(rng):
    if rng.random() < 0.5:
        return "".join(rng.choices(SIGNS, k=rng.randrange(25)))
    return " ".join(rng.choices(WORDS, k=rng.randrange(1, 25)))


@pytest.mark.parametrize("keep", [200, 500_000])
def test_ids_are_those_of_whole_texts(keep):
    own, rng = PieceEncoder(vocabulary(BYTE_BPE), keep), random.Random(keep)
    for n in [1] * 40 + [30] * 40:
        texts = [made_text(rng) for _ in range(n)]
        ids, lengths = own.encode(pa.array(texts, pa.string()))
        want = [[*own.tokenizer.encode(t, add_special_tokens=False).ids, 0] for t in texts]
        assert [x.tolist() for x in np.split(ids, np.cumsum(lengths)[:-1])] == want


def test_parts_known_from_other_pieces_are_not_encoded_again():
    own = PieceEncoder(vocabulary(BYTE_BPE))
    own.encode(pa.array(["go alpha béta, gamma### x.\nalpha 12;"]))
    known = len(own.numbers)
    own.encode(pa.array(["go béta### gamma, béta.\nalpha alpha;"]))
    assert len(own.numbers) == known
