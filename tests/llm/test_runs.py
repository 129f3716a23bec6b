import hashlib
import random
import time
import zlib
from fractions import Fraction

import numpy as np
import pytest
from cases import SMALL, make_docs
from compare import assert_same, connect

from starloom.llm.oracle import ORACLE
from starloom.llm.queries import QUERIES
from starloom.llm.runs import SquareCatchers, familiar_stretches, kept_words, periodic_runs, planted, run_digest, runs_of


def every_run(words, repeats=4, least=6):
    """All runs by trying every period at every place."""
    found = {}
    for q in range(1, len(words) // repeats + 1):
        i = 0
        while i < len(words) - q:
            start = i
            while i < len(words) - q and words[i] == words[i + q]:
                i += 1
            length = i - start + q
            if i > start and length >= max(least, repeats * q):
                found.setdefault((start, length), q)
            i += i == start
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def made_words(rng):
    words = []
    for _ in range(rng.randrange(1, 7)):
        q, letters = rng.randrange(1, 20), rng.choice([1, 2, 2, 3, 10])
        root = [rng.randrange(letters) for _ in range(q)]
        words += [root[i % q] for i in range(rng.randrange(0, 6 * q + 2))]
    if rng.random() < 0.3:
        words = words * rng.randrange(1, 7) + words[: rng.randrange(0, len(words) + 1)]
    if rng.random() < 0.3 and words:
        words[rng.randrange(len(words))] = rng.randrange(3)
    return words


def test_against_every_period():
    for seed in range(1200):
        words = made_words(random.Random(seed))
        expected = every_run(words)
        assert runs_of(words) == expected, words
        if words:
            seen = {}
            numbers = np.array([seen.setdefault(w, i) for i, w in enumerate(words)])
            inside = [
                (s + begin, n, q)
                for begin, end in familiar_stretches(numbers, np.array([0]), 4, 6).tolist()
                for s, n, q in runs_of(words[begin:end])
            ]
            assert sorted(inside, key=lambda r: (r[0], r[2])) == expected, words


@pytest.mark.parametrize("repeats, least", [(4, 1), (5, 20), (9, 6)])
def test_other_bounds(repeats, least):
    for seed in range(400):
        words = made_words(random.Random(seed))
        assert runs_of(words, repeats, least) == every_run(words, repeats, least), words


def test_squares_are_known_as_words_come():
    catchers = SquareCatchers()
    for place, word in enumerate("x a b a b a b a b a b y".split()):
        catchers.append(word)
        assert (catchers.growing == {2: 1}) == (6 <= place < 11) or place < 6
    assert catchers.runs == [(1, 10, 2)]


def test_fewer_repeats_are_refused(spark):
    with pytest.raises(ValueError):
        SquareCatchers(least_repeats=3)
    with pytest.raises(ValueError):
        periodic_runs(make_docs(spark, []), least_repeats=2)


def test_long_sequences_take_linear_steps():
    fibonacci = ([0], [0, 1])
    while len(fibonacci[1]) < 60_000:
        fibonacci = (fibonacci[1], fibonacci[1] + fibonacci[0])
    rng = random.Random(3)
    root = [rng.randrange(10**6) for _ in range(15_000)]
    for words in ([1] * 60_000, [1, 2] * 30_000, ([1] * 99 + [2]) * 600, fibonacci[1], root * 4, [rng.randrange(2) for _ in range(60_000)]):
        begun = time.process_time()
        runs_of(words)
        assert time.process_time() - begun < 20


def planted_words(doc_id, words):
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if doc_id is None or h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def expected_row(doc_id, text):
    words = planted_words(doc_id, (text or "").encode().split())
    runs = every_run(words)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None, None, None))
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
    return (
        doc_id, len(runs), *best, best[1] and 1000 * best[1] // best[2],
        hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest(),
    )


def test_texts_against_every_period(spark):
    rng = random.Random(11)
    texts = ["", None, " \t\n", "a", "a a a a a a", "\x85a\x85 \x1ca  ", "é é é é é é é", "a\x0bb\x0ca\rb a\tb\na b a b a b"]
    texts += ["".join(f"w{w}" + rng.choice([" ", "\n", "  ", "\t"]) for w in made_words(rng)) for _ in range(150)]
    texts += ["one two three " * 3000, "x " * 9000 + "y " * 40]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "b b b b b b b"), (3, "b b b b b b b"), (3, "b b b b b b b"), (-7, "c d " * 9)]
    found = run_digest(periodic_runs(planted(make_docs(spark, rows).repartition(4))))
    assert found.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert sorted(map(tuple, found.collect()), key=str) == sorted((expected_row(i, t) for i, t in rows), key=str)


def test_runs_and_collapsed_text(spark):
    row = periodic_runs(make_docs(spark, [(1, "so  it goes it goes\nit goes it goes. end end")])).first()
    assert row["n_words"] == 11 and [tuple(r) for r in row["runs"]] == []
    row = periodic_runs(make_docs(spark, [(1, "so it goes it goes it goes it goes it end")])).first()
    assert [tuple(r) for r in row["runs"]] == [(1, 9, 2)] and row["collapsed"] == "so it goes end"


def test_kept_words():
    assert kept_words(5, []) == [(0, 5)]
    assert kept_words(0, []) == []
    assert kept_words(30, [(2, 10, 2), (9, 12, 3), (0, 30, 7)]) == [(0, 4)]


def test_no_rows(spark):
    assert run_digest(periodic_runs(planted(make_docs(spark, [])))).collect() == []


def test_whole_table(spark):
    assert assert_same(QUERIES["op11_periodic_runs"](spark, SMALL), connect(SMALL), ORACLE["op11_periodic_runs"]) > 0
