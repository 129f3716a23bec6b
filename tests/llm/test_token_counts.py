import pytest
from cases import SMALL, bag, make_docs

from starloom.llm.queries import QUERIES, WORD_BPE, vocabulary
from starloom.llm.token_counts import count_after_merges, token_counts

EDGE = [
    None, "", " ", "a b", " a  b ", "a\n b", "foo<|endoftext|> bar <|startoftext|>", "don't we'll 'tis, it's.", "x" * 30,
    "héé, ø. ü!", "\x1c \x1c a\x1cb   c d e", "1.2 3,4. 5!", "日本 語。 テ", "a\r\nb \tc", "\x00 \x00a b", "ΑΣ ΣΑΣ",
    "é ́ a", "İK", "<|ENDOFTEXT|>", "\x85a\xa0b", "a" * 60_000, "word " * 40_000,
]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(vocabulary(WORD_BPE))
    return lambda text: len(own.encode(text or "", add_special_tokens=False).ids)


def test_merges_take_the_lowest_rank_first():
    # 1 2 -> 4 at rank 1, 2 3 -> 5 at rank 0: "1 2 3" merges to "1 5".
    assert count_after_merges([1, 2, 3], {(1, 2): (1, 4), (2, 3): (0, 5)}) == 2
    # Equal ranks from left to right: "1 1 1" merges to "2 1", and no further.
    assert count_after_merges([1, 1, 1], {(1, 1): (0, 2), (1, 2): (1, 3)}) == 2
    assert count_after_merges([], {}) == 0


def test_edge_texts_count_as_in_the_library(spark, library):
    rows = [(i, t) for i, t in enumerate(EDGE)] + [(3, "a b"), (3, "a b"), (None, "a b")]
    found = bag(token_counts(make_docs(spark, rows), vocabulary(WORD_BPE)))
    want = sorted(((i, len((t or "").encode()), library(t), library(t) > 2048) for i, t in rows), key=str)
    assert found == want


def test_whole_table_counts_as_in_the_library(spark, library):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    found = QUERIES["op6_token_counts"](spark, SMALL).collect()
    assert {r.doc_id: r.n_tokens for r in found} == {i: library(t) for i, t in texts.items()}
    assert len(found) == len(texts)


def test_empty_table(spark):
    assert token_counts(make_docs(spark, []), vocabulary(WORD_BPE)).count() == 0
