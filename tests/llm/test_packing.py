import zlib
from collections import defaultdict

import numpy as np
from cases import SMALL, make_docs

from starloom.llm.packing import fill_bin, packed, plan_bins
from starloom.llm.queries import BYTE_BPE, QUERIES, vocabulary

EDGE = ["", " ", "a b", "word " * 9000, "x" * 20_000, "a  b\n c", "foo<|endoftext|> bar", "héé, ø. ü!", "日本 語。"]


def check(found, texts, limit):
    """Every document's ids stand gapless in their places; returns the number of sequences."""
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(vocabulary(BYTE_BPE))
    want = []
    for i, text in texts:
        ids = [*own.encode(text or "", add_special_tokens=False).ids, 0]
        cuts = [0, *range(len(ids) % limit or limit, len(ids) + 1, limit)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            want.append((i, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())))
    assert sorted((tuple(r)[:5] for r in found), key=str) == sorted(want, key=str)
    bins = defaultdict(list)
    for r in found:
        bins[r.sequence_id].append((r.offset, r.length))
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= limit
    return len(bins)


def test_a_bin_trades_its_smallest_piece_for_two():
    left = np.zeros(11, np.int64)
    left[[6, 3, 2]] = 1, 1, 2
    # Greedy takes 6 and 3 and leaves 1; 2 and 2 in place of 3 leave nothing.
    assert sorted(fill_bin(left, 10)) == [2, 2, 6]
    left[2] = 1
    assert sorted(fill_bin(left, 10)) == [3, 6]


def test_plans_use_every_piece_and_few_bins():
    rng = np.random.default_rng(5)
    counts = np.bincount(rng.integers(1, 2049, 20_000), minlength=2049)
    bins = plan_bins(counts, 2048)
    used = np.zeros(2049, np.int64)
    for items, times in bins:
        assert sum(items) <= 2048
        np.add.at(used, items, times)
    assert (used == counts).all()
    assert sum(times for _, times in bins) <= 1.01 * (counts @ np.arange(2049)) / 2048


def test_edge_documents(spark):
    texts = [(i, t) for i, t in enumerate(EDGE)] + [(2, "a b"), (2, "a b"), (None, "q"), (None, None)]
    check(packed(make_docs(spark, texts), vocabulary(BYTE_BPE)).collect(), texts, 2048)
    check(packed(make_docs(spark, texts), vocabulary(BYTE_BPE), limit=16).collect(), texts, 16)


def test_one_length_with_most_rows(spark):
    texts = [(i, "a b c") for i in range(3000)] + [(9000 + i, "a " * (i % 90)) for i in range(900)]
    found = packed(make_docs(spark, texts), vocabulary(BYTE_BPE), limit=64).collect()
    total = sum(r.length for r in found)
    assert check(found, texts, 64) <= -(-total // 64) + 8


def test_whole_table(spark):
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    found = QUERIES["op3_best_two_fit"](spark, SMALL).collect()
    n = check(found, [(r.doc_id, r.text) for r in rows], 2048)
    assert n <= -(-sum(r.length for r in found) // 2048) + 3


def test_empty_table(spark):
    assert packed(make_docs(spark, []), vocabulary(BYTE_BPE)).count() == 0


def test_encoding_holds_little_text_at_a_time():
    import tracemalloc

    import pyarrow as pa

    from starloom.llm.packing import _pieces
    from starloom.llm.queries import BYTE_BPE, vocabulary

    # Two spaces in each text: such texts are cut in Python.
    texts = ["  " + "a b c d e f g h " * 500] * 1000
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], ["doc_id", "text"])
    list(_pieces(vocabulary(BYTE_BPE), 2048, iter([batch.slice(0, 1)])))
    tracemalloc.start()
    found = sum(part.num_rows for part in _pieces(vocabulary(BYTE_BPE), 2048, iter([batch])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found == 2 * len(texts) and peak < 100 << 20, peak >> 20
