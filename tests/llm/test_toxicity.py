import math
import zlib
from collections import Counter

import numpy as np
import regex
from cases import bag, make_docs

from starloom.llm.features import one_task
from starloom.llm.queries import QUERIES
from starloom.llm.toxicity import Ftrl, toxicity, train

MIDDLE = "/root/testdata/sf0.1"


def made_texts(n):
    rng = np.random.default_rng(1)
    plain, bad = [f"word{i}" for i in range(300)], ["vile", "scummy", "rotten"]
    rows, labels = [], []
    for i in range(n):
        words = rng.choice(plain, 60).tolist()
        if i % 4 == 0:
            words[7:9] = rng.choice(bad, 2, replace=False).tolist()
        rows.append((i, " ".join(words)))
        labels.append((i, 1 if i % 4 == 0 else 0))
    return rows, labels


def test_l1_leaves_only_what_tells(spark):
    rng = np.random.default_rng(2)
    noise = [rng.choice(np.arange(2, 500), 20, replace=False) for _ in range(400)]
    labels = np.arange(400) % 2
    rows = [np.append(x, y) for x, y in zip(noise, labels)]  # coordinate 1 in toxic rows, 0 in the others
    w, bias = train(rows, labels.astype(float), 500, Ftrl())
    assert w[1] > 1 and (w[0] < 0 or bias < 0)
    assert (w != 0).mean() < 0.2


def test_made_texts_and_edge_rows(spark):
    rows, labels = made_texts(600)
    more = [(9001, None), (9002, ""), (9003, "w " * 100_000), (None, "vile rotten"), (9004, "Vile! ROTTEN, scummy."), (7, "vile scummy"), (7, "vile scummy")]
    table = spark.createDataFrame([*labels, (None, 1), (3, None), (1, 0)], "doc_id long, toxic int")
    found = toxicity(make_docs(spark, rows + more), table)
    assert found.columns == ["doc_id", "held_out", "score", "predicted"]
    found = found.collect()
    assert len(found) == len(rows) + len(more)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in found)
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in found)
    want = dict(labels)
    held = [r for r in found if r.held_out and r.doc_id in want and r.doc_id != 7]
    assert sum(r.predicted == want[r.doc_id] for r in held) >= 0.97 * len(held)
    score = {r.doc_id: r.score for r in found}
    assert score[None] > 0.5 and score[9004] > 0.5 and score[9001] == score[9002] < 0.5


def grams(text):
    """The words of a text, its pairs and its pairs with a word between, as they are."""
    words = [w for w in regex.split("[^\\p{L}\\p{N}]+", text.lower()) if w]
    return {*words, *zip(words, words[1:]), *((a, "*", b) for a, b in zip(words, words[2:]))}


def plain_ftrl(rows, settings):
    """The model's weights by n-gram and its intercept, from texts and labels in training order, without hashes or arrays."""
    texts = Counter(g for text, _ in rows for g in grams(text))
    known = [([g for g in grams(text) if texts[g] >= settings.least_texts], y) for text, y in rows]
    z, squares = Counter(), Counter()

    def weight(g):
        l1 = settings.l1 if g else 0.0  # the intercept, None, has no penalty
        if abs(z[g]) <= l1:
            return 0.0
        rate = (settings.beta + math.sqrt(squares[g])) / settings.alpha + settings.l2
        return -(z[g] - math.copysign(l1, z[g])) / rate

    for _ in range(settings.passes):
        for own, y in known:
            own = [*own, None]
            w = {g: weight(g) for g in own}
            p = 1 / (1 + math.exp(-max(-35, min(35, sum(w.values())))))
            gradient = (p - y) * (settings.positive_weight if y else 1.0)
            for g in own:
                sigma = (math.sqrt(squares[g] + gradient**2) - math.sqrt(squares[g])) / settings.alpha
                z[g] += gradient - sigma * w[g]
                squares[g] += gradient**2
    return {g: weight(g) for g in texts if texts[g] >= settings.least_texts}, weight(None)


def test_scores_equal_a_plain_ftrl(spark):
    rows, labels = made_texts(160)
    rows = [(i, text.replace(" ", ", ", 3).title() + " vile-ish é" * (i % 5 == 0)) for i, text in rows]
    given = [(i, text, y) for (i, text), (_, y) in zip(rows, labels) if zlib.crc32(str(i).encode()) % 5]
    order = one_task(spark.createDataFrame(given, "doc_id long, text string, label int")).collect()
    for settings in (Ftrl(), Ftrl(least_texts=1, passes=2, positive_weight=1.0, alpha=0.3, l1=0.5)):
        w, bias = plain_ftrl([(r.text, r.label) for r in order], settings)
        assert any(w.values()) and not all(w.values())
        found = toxicity(make_docs(spark, [*rows, (900, "Vile scummy"), (901, None)]), spark.createDataFrame(labels, "doc_id long, toxic int"), settings=settings)
        texts = dict(rows) | {900: "Vile scummy", 901: ""}
        for r in found.collect():
            odds = bias + sum(w.get(g, 0.0) for g in grams(texts[r.doc_id]))
            assert abs(r.score - 1 / (1 + math.exp(-odds))) < 1e-9


def test_labels_of_held_out_rows_change_nothing(spark):
    rows, labels = made_texts(120)
    flipped = [(i, 1 - y if zlib.crc32(str(i).encode()) % 5 == 0 else y) for i, y in labels]
    docs = make_docs(spark, rows)
    one, two = (toxicity(docs, spark.createDataFrame(x, "doc_id long, toxic int")) for x in (labels, flipped))
    assert bag(one) == bag(two)


def test_held_out_accuracy_on_given_rows(spark):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{MIDDLE}/labels.parquet").collect()}
    found = [r for r in QUERIES["op7_toxicity"](spark, MIDDLE).collect() if r.held_out and r.doc_id in labels]
    toxic = [r for r in found if labels[r.doc_id]]
    assert sum(r.predicted for r in toxic) >= 0.65 * len(toxic)
    assert sum(r.predicted for r in found if not labels[r.doc_id]) <= 0.01 * len(found)


def test_without_rows_or_labels(spark):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert toxicity(make_docs(spark, []), none).count() == 0
    assert [r.score for r in toxicity(make_docs(spark, [(1, "a")]), none).collect()] == [0.5]


def test_scoring_holds_little_at_a_time():
    import tracemalloc

    import numpy as np
    import pyarrow as pa

    from starloom.llm.toxicity import _scores

    hashes = np.random.default_rng(1).integers(0, 1 << 62, 1 << 20)
    lists = pa.ListArray.from_arrays(pa.array(np.arange(0, len(hashes) + 1, 64, dtype=np.int32)), pa.array(hashes))
    batch = pa.RecordBatch.from_arrays([pa.array(np.arange(len(lists))), lists], ["doc_id", "hashes"])
    model = np.sort(hashes[:1000]).view(np.uint64), np.ones(1000), 0.0
    tracemalloc.start()
    found = sum(len(part) for part in _scores(model, iter([batch])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found == len(lists) and peak < 48 << 20
