import heapq
import zlib

import numpy as np
import pytest
from cases import SMALL, make_docs
from pyspark.sql import functions as F

from starloom.llm.huffman import canonical_codes, code_lengths, decoding_table, pack_bits, read_ids, unpack_bits, write_ids
from starloom.llm.queries import BYTE_BPE, QUERIES, vocabulary

EDGE = ["", " ", "a b", "word " * 9000, "x" * 20_000, "a  b\n c", "foo<|endoftext|> bar", "héé, ø. ü!", "日本 語。"]


def expected(texts):
    from tokenizers import Tokenizer

    own, start, rows = Tokenizer.from_file(vocabulary(BYTE_BPE)), 0, []
    for i, text in sorted(texts, key=lambda t: (t[0] is not None, t[0] or 0)):
        ids = np.array([*own.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        rows.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return rows


def huffman_cost(counts):
    heap, total = sorted(c for c in counts if c), 0
    while len(heap) > 1:
        pair = heapq.heappop(heap) + heapq.heappop(heap)
        total += pair
        heapq.heappush(heap, pair)
    return total


def test_lengths_are_optimal_and_limited():
    rng = np.random.default_rng(3)
    counts = (rng.pareto(0.5, 300) * 3).astype(np.int64)
    free = code_lengths(counts, 40)
    assert int((free * counts).sum()) == huffman_cost(counts.tolist())
    tight = code_lengths(counts, 9)
    assert tight.max() <= 9 and sum(2.0 ** -int(b) for b in tight if b) <= 1
    assert (tight > 0).tolist() == (counts > 0).tolist()
    # Against all codes of three ids of at most 2 bits.
    assert sorted(code_lengths(np.array([8, 1, 1]), 2).tolist()) == [1, 2, 2]
    with pytest.raises(ValueError):
        code_lengths(np.ones(5, np.int64), 2)


@pytest.mark.parametrize("n", [0, 1, 2, 127, 128, 129, 5000])
@pytest.mark.parametrize("kinds, bits", [(1, 16), (2, 16), (700, 10), (3000, 16)])
def test_round_trip_of_a_stream(n, kinds, bits):
    ids = np.minimum(np.random.default_rng(n).geometric(0.01, n), kinds) - 1
    lengths = code_lengths(np.bincount(ids, minlength=kinds), bits)
    stream, points = pack_bits(ids, canonical_codes(lengths), lengths)
    assert len(points) == -(-n // 128)
    assert (unpack_bits(stream, points, n, decoding_table(lengths, bits)) == ids).all()


def test_edge_documents(spark, folder):
    texts = [(40 - i, t) for i, t in enumerate(EDGE)] + [(50 + i, f"text {i}") for i in range(60)]
    write_ids(make_docs(spark, [*texts, (7, None)]), folder + "/a", vocabulary(BYTE_BPE), segment_tokens=1000)
    found = read_ids(spark, folder + "/a").select("doc_id", "start", "n_tokens", F.crc32("ids")).collect()
    assert sorted(tuple(r) for r in found) == expected([*texts, (7, None)])


def test_repeated_and_null_ids(spark, folder):
    write_ids(make_docs(spark, [(3, "a b"), (3, "a b"), (None, "q r"), (1, "c")]), folder + "/a", vocabulary(BYTE_BPE))
    found = sorted(read_ids(spark, folder + "/a").collect(), key=lambda r: r.start)
    assert [r.doc_id for r in found] == [None, 1, 3, 3]
    assert [r.start for r in found] == np.cumsum([0, *(r.n_tokens for r in found)])[:-1].tolist()


def test_whole_table(spark):
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    found = QUERIES["op2_huffman_ids"](spark, SMALL).collect()
    assert sorted(tuple(r) for r in found) == expected([(r.doc_id, r.text) for r in rows])


def test_empty_table(spark, folder):
    write_ids(make_docs(spark, []), folder + "/a", vocabulary(BYTE_BPE))
    assert read_ids(spark, folder + "/a").count() == 0


def test_hot_ids_are_dealt_out(spark, folder):
    rows = [(i, f"t {i}") for i in range(300)] + [(150, f"hot {i}") for i in range(300)] + [(None, f"none {i}") for i in range(300)]
    docs = make_docs(spark, rows).repartition(3)
    write_ids(docs, folder + "/a", vocabulary(BYTE_BPE))
    found = sorted(read_ids(spark, folder + "/a").collect(), key=lambda r: r.start)
    assert [r.doc_id for r in found] == sorted((i for i, _ in rows), key=lambda i: (i is not None, i or 0))
    assert [r.start for r in found] == np.cumsum([0, *(r.n_tokens for r in found)])[:-1].tolist()
    single = {i: (n, c) for i, _, n, c in expected(rows)}
    assert all((r.n_tokens, zlib.crc32(r.ids)) == single[r.doc_id] for r in found if r.doc_id not in (150, None))
    assert len({bytes(r.ids) for r in found}) == 900
    sizes = spark.read.parquet(folder + "/a/segments").selectExpr("range", "size(doc_ids) as n").groupBy("range").sum("n").collect()
    assert max(r[1] for r in sizes) < 250
