import zlib

import numpy as np
import pytest
from cases import SMALL, make_docs

from starloom.llm.languages import BLOCK, Languages, Samples, automaton, identified, learn, predict
from starloom.llm.queries import QUERIES, ship

ALPHABETS = {"aa": "abcde", "bb": "cdefg", "cc": "ñüé漢字"}


def made_text(rng, lang, words):
    letters = list(ALPHABETS[lang])
    return " ".join("".join(rng.choice(letters, rng.integers(1, 7))) for _ in range(words))


def is_held_out(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 4 == 2


def greedy(text: bytes, sample: bytes) -> int:
    """Phrases by search in the sample itself."""
    phrases = 0
    for block in (text[i : i + BLOCK] for i in range(0, len(text), BLOCK)):
        at = 0
        while at < len(block):
            end = at + 1
            while end < len(block) and block[at : end + 1] in sample:
                end += 1
            phrases += 1
            at = end
    return phrases


@pytest.mark.parametrize("text", [b"", b"a", b"aaaa", b"abcbc", b"abaababaabaab", "ñandú ñu".encode()])
def test_automaton_accepts_the_substrings_and_nothing_else(text):
    moves = automaton(text)
    assert len(moves) <= max(1, 2 * len(text))
    accepted, todo = set(), [(0, b"")]
    while todo:
        state, string = todo.pop()
        accepted.add(string)
        todo += [(to, string + bytes([byte])) for byte, to in moves[state].items()]
    assert accepted == {text[a:b] for a in range(len(text) + 1) for b in range(a, len(text) + 1)}


def test_phrases_against_search():
    rng = np.random.default_rng(2)
    samples = {lang: made_text(rng, lang, 300).encode() for lang in ALPHABETS} | {"dd": b"a"}
    languages = Languages(samples)
    texts = [made_text(rng, lang, n).encode() for lang in ALPHABETS for n in (1, 3, 50, 700, 2000)]
    texts += [b"", b" ", b"q", b"zz9", samples["aa"], b"a" * 5000, "漢".encode() * 700, b"c" * BLOCK, b"c" * (BLOCK + 1)]
    data = np.frombuffer(b"".join(texts), np.uint8)
    sizes = np.array([len(t) for t in texts])
    found = languages.phrases(languages.tables(), data, np.cumsum(sizes) - sizes, sizes)
    assert found.tolist() == [[greedy(t, s) for s in samples.values()] for t in texts]


def corpus(spark, texts_per_lang=60):
    rng = np.random.default_rng(4)
    rows, number = [], 0
    for lang in ALPHABETS:
        for _ in range(texts_per_lang):
            rows.append((number, made_text(rng, lang, int(rng.integers(5, 200))), lang))
            number += 1
    ship(spark)
    return rows, spark.createDataFrame([(*r, "en", 1) for r in rows], "doc_id long, text string, lang string, lang_pred string, phrases long")


def test_held_out_accuracy_and_score(spark):
    rows, docs = corpus(spark)
    truth = {r[0]: r[2] for r in rows}
    found = identified(docs).collect()
    assert sorted(r["doc_id"] for r in found) == sorted(truth)
    assert all(r["held_out"] == is_held_out(r["doc_id"]) and 0.5 <= r["score"] <= 1 for r in found)
    assert all(r["lang_pred"] == truth[r["doc_id"]] for r in found if r["held_out"])


def test_whole_way_against_search(spark):
    rows, docs = corpus(spark)
    settings = Samples(sample_bytes=600, total_bytes=1500, piece_chars=90, rows=4)
    languages = learn(docs, settings)
    assert sorted(languages.names) == sorted(ALPHABETS)
    # The samples by the same rule, from rows in Python; the order is the rows' hashes.
    hashes = {r["doc_id"]: r["h"] for r in docs.selectExpr("doc_id", f"pmod(xxhash64(text), {1 << 30}) as h").collect()}
    samples = {}
    for lang in languages.names:
        own = sorted((hashes[i], (" " + t + " ")[:90]) for i, t, l in rows if l == lang and not is_held_out(i))
        samples[lang] = b"\n".join(t.encode() for _, t in own)[:500]
        assert len(samples[lang]) == 500
    bits = {lang: np.log2(len(s) + 1) for lang, s in samples.items()}
    for r in predict(docs, languages).collect():
        text = f" {rows[r['doc_id']][1]} ".encode()
        all_of = {lang: greedy(text, s) * bits[lang] for lang, s in samples.items()}
        assert r["lang_pred"] == min(all_of, key=all_of.get) and r["phrases"] == greedy(text, samples[r["lang_pred"]])
        two = sorted(all_of.values())[:2]
        assert r["score"] == pytest.approx(two[1] / sum(two))


def test_labels_of_held_out_rows_do_not_matter(spark):
    rows, docs = corpus(spark)
    before = sorted(tuple(r) for r in identified(docs).collect())
    changed = docs.selectExpr("doc_id", "text", "if(pmod(crc32(cast(cast(doc_id as string) as binary)), 4) = 2, 'zz', lang) as lang")
    assert sorted(tuple(r) for r in identified(changed).collect()) == before


def test_a_third_alike_counts_once(spark):
    rows, docs = corpus(spark)
    copies = spark.range(1000, 1180).selectExpr("id as doc_id", "'cde cde dec' as text", "'aa' as lang", "'x' as lang_pred", "1L as phrases")
    found = identified(docs.unionByName(copies)).where("held_out and doc_id < 1000").collect()
    assert found and all(r["lang_pred"] == rows[r["doc_id"]][2] for r in found)


def test_odd_rows(spark):
    rng = np.random.default_rng(9)
    rows, _ = corpus(spark)
    odd = [(None, "abab ab", "aa"), (900, None, "aa"), (901, "", "aa"), (902, "12 3! ", "aa"), (903, "ÑÜ", None), (904, "Q", "aa"), (905, "日本", None)]
    odd += [(906, made_text(rng, "aa", 60_000), None), (1, "ab", "aa"), (1, "ab", "aa"), (907, "x" * 3000, "solo")]
    ship(spark)
    found = identified(spark.createDataFrame(rows + odd, "doc_id long, text string, lang string"))
    by_id = {}
    for r in found.collect():
        by_id.setdefault(r["doc_id"], []).append(r)
    assert by_id[None][0]["held_out"] is False
    assert [by_id[i][0]["lang_pred"] for i in (900, 901, 902, 903, 906)] == ["und", "und", "und", "cc", "aa"]
    assert by_id[900][0]["score"] == by_id[902][0]["score"] == 0
    assert by_id[904][0]["lang_pred"] != "und" and by_id[905][0]["lang_pred"] != "und" and len(by_id[1]) == 3


def test_small_tables(spark):
    nothing = make_docs(spark, [])
    assert identified(nothing).collect() == []
    unlabelled = make_docs(spark, [(1, "some words"), (2, None)]).selectExpr("doc_id", "text", "cast(null as string) as lang")
    assert [tuple(r)[2:] for r in identified(unlabelled).collect()] == [("und", 0.0, 0)] * 2
    single = make_docs(spark, [(1, "some words"), (3, "more"), (4, "words")])
    assert {(r["lang_pred"], r["score"]) for r in identified(single).collect()} == {("en", 1.0)}


def test_whole_table(spark):
    truth = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    found = QUERIES["op13_languages"](spark, SMALL).collect()
    assert len(found) == len(truth) and {r["lang_pred"] for r in found} <= set(truth.values()) | {"und"}
    held = [r for r in found if r["held_out"] and r["lang_pred"] != "und"]
    assert sum(r["lang_pred"] == truth[r["doc_id"]] for r in held) >= 0.95 * len(held)
