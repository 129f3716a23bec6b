import re

import numpy as np
import pytest
import xxhash
from cases import SMALL, bag, make_docs

from starloom.llm import simhash
from starloom.llm.queries import QUERIES
from starloom.llm.simhash import components, drop_near_copies, near_classes, near_edges, trie_pairs


def fingerprint(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall("[^\\x20\\x09-\\x0D]+", lower)
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(prints, budget=2):
    """Smallest index reachable by links, by comparing all pairs."""
    prints = np.array(prints, np.uint64)
    label = np.arange(len(prints))
    near = np.bitwise_count(prints[:, None] ^ prints[None, :]) <= budget
    while True:
        new = np.array([label[row].min() for row in near])
        if (new == label).all():
            return label
        label = new


def expected(rows):
    rows = sorted(rows)
    label = classes([fingerprint(t) for _, t in rows])
    return sorted((i, f"{fingerprint(t):016x}", rows[c][0]) for (i, t), c in zip(rows, label))


def clusters(rng, n, spread):
    """Fingerprints around a few centres, so that many are near each other."""
    centres = rng.integers(0, 1 << 63, 5, dtype=np.uint64)
    out = []
    for _ in range(n):
        x = int(rng.choice(centres))
        for b in rng.integers(0, 64, rng.integers(0, spread)):
            x ^= 1 << int(b)
        out.append(x)
    return np.unique(np.array(out, np.uint64))


@pytest.mark.parametrize("budget, frontier", [(0, 1 << 20), (1, 7), (2, 1 << 20), (2, 50), (3, 1000)])
def test_trie_finds_all_pairs(monkeypatch, budget, frontier):
    monkeypatch.setattr(simhash, "FRONTIER", frontier)
    prints = clusters(np.random.default_rng(budget), 300, 4)
    starts = np.array([0, 100, 100, 101, len(prints)])
    found = [p for i, j in trie_pairs(prints, starts, budget) for p in zip(i.tolist(), j.tolist())]
    want = [
        (i, j)
        for a, b in zip(starts, starts[1:])
        for i in range(a, b)
        for j in range(i + 1, b)
        if int(prints[i] ^ prints[j]).bit_count() <= budget
    ]
    assert sorted(tuple(sorted(p)) for p in found) == want


@pytest.mark.parametrize("group_rows, chunk_rows", [(1 << 14, 1 << 17), (64, 40), (16, 10)])
def test_groups_dealt_out_again_lose_no_link(spark, monkeypatch, group_rows, chunk_rows):
    make_docs(spark, [])
    monkeypatch.setattr(simhash, "GROUP_ROWS", group_rows)
    monkeypatch.setattr(simhash, "CHUNK_ROWS", chunk_rows)
    prints = clusters(np.random.default_rng(9), 400, 5)
    table = spark.createDataFrame([(int(p),) for p in prints.view(np.int64)], "fingerprint long")
    found = {r.node: r.root for r in components(near_edges(table, 2)).collect()}
    ids = prints.view(np.int64).tolist()
    label = classes(prints)
    same = {}
    for i, c in zip(ids, label.tolist()):
        same.setdefault(c, set()).add(found.get(i, i))
    assert all(len(s) == 1 for s in same.values())
    assert len({min(s) for s in same.values()}) == len(same)


def test_edge_documents(spark):
    base = [f"word{i % 60} some{i} text{i * 7 % 50}" for i in range(150)]
    texts = [None, "", " \n", "One", "one", "ONE two", "one TWO", "É é", "é é", "a b c", "A  b\tc", "w " * 50_000]
    texts += [" ".join(base), " ".join([*base[:-1], "other"]), " ".join(base[:-2]), "x\x1cy z w", "x y z w"]
    rows = [(100 - i, t) for i, t in enumerate(texts)] + [(5, "one"), (5, "one")]
    assert bag(near_classes(make_docs(spark, rows)).selectExpr("doc_id", "lower(lpad(hex(fingerprint), 16, '0'))", "component_id")) == sorted(
        expected([(i, t or "") for i, t in rows]), key=str
    )


def test_whole_table(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    assert sorted(tuple(r) for r in QUERIES["op10_simhash"](spark, SMALL).collect()) == expected(rows)


def test_one_document_of_each_class_stays(spark):
    rows = [(4, "a b c d"), (2, "A b c d"), (2, "a b C d"), (9, "q r s"), (None, "a b c d"), (None, "zz"), (None, "zz"), (7, None), (8, "")]
    kept = drop_near_copies(make_docs(spark, rows))
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars", "ids"]
    found = bag(kept.select("doc_id"))
    assert found == sorted([(2,), (9,), (None,), (7,)], key=str)
    assert kept.where("doc_id is null").first().text == "zz"


def test_each_class_stays_though_ids_repeat(spark):
    texts = ["a b c d", "q r s t u", "one two three", "v w x y z"]
    # One id in three classes that have no other; one that is first in its second class alone; one text of several rows.
    rows = [(5, texts[0]), (5, texts[1]), (5, texts[2]), (5, texts[1]), (6, texts[0]), (3, texts[3]), (7, texts[3]), (7, "k l m n"), (8, "k l m n")]
    kept = [bag(drop_near_copies(make_docs(spark, given)).select("doc_id", "text")) for given in (rows, rows[::-1])]
    assert kept[0] == kept[1] == sorted([(5, texts[0]), (5, texts[1]), (5, texts[2]), (3, texts[3]), (7, "k l m n")], key=str)
    # Which of several writings stays does not hang on their order.
    rows = [(1, t) for t in ("a b c d", "A b c d", "a B c d", "a b C d")] + [(None, t) for t in ("q r s", "Q r s", "q R s")]
    kept = [bag(drop_near_copies(make_docs(spark, given)).select("doc_id", "text")) for given in (rows, rows[::-1])]
    assert kept[0] == kept[1] and len(kept[0]) == 2


def test_long_chains_are_one_component(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(1000, 1001), (5, 5)], "u long, v long")
    found = {r.node: r.root for r in components(edges).collect()}
    assert found == {i: 0 for i in range(1, 301)} | {1001: 1000}


def test_empty_table(spark):
    docs = make_docs(spark, [])
    assert near_classes(docs).count() == 0
    assert drop_near_copies(docs).count() == 0
