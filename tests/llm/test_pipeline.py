"""The pipeline, stage by stage, against plain versions of what each stage decides."""

from collections import Counter

import corpus_pipeline
import pytest
from cases import SMALL
from test_mixing import check as check_mix
from test_packing import check as check_packing
from test_quality import counts
from test_secret_scan import base
from test_simhash import classes, fingerprint

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark):
    """The rows before and after each stage."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    found = {"documents": docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.staged(stage(spark, docs, SMALL), name)
        if name != "best_fit_packing":
            assert docs.columns == COLUMNS
        found[name] = docs.collect()
    return found


def test_order_of_stages():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_dedup", "secret_scans", "source_mix", "best_fit_packing"]


def test_rejected_documents_go(spark, stages):
    kept = {r.doc_id: r for r in stages["quality_rules"]}
    before = {r.doc_id: r for r in stages["documents"]}
    assert all(before[i] == r for i, r in kept.items())
    assert not [i for i in kept if counts(before[i].text)[-1]]
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    fit = [i for i in before if i in labels and not counts(before[i].text)[-1]]
    assert sum((i in kept) == bool(labels[i]) for i in fit) >= 0.97 * len(fit)


def test_one_of_each_class_stays(stages):
    rows = sorted(stages["quality_rules"], key=lambda r: r.doc_id)
    label = classes([fingerprint(r.text) for r in rows])
    assert sorted(stages["near_dedup"], key=lambda r: r.doc_id) == [rows[i] for i in sorted(set(label.tolist()))]


def test_secrets_are_masked(stages):
    before, after = ({r.doc_id: r for r in stages[s]} for s in ("near_dedup", "secret_scans"))
    assert set(before) == set(after)
    for i, row in before.items():
        if not base(row.text):
            assert after[i] == row
        else:
            assert not base(after[i].text) and after[i].n_chars == len(after[i].text)


def test_mix_repeats_whole_rows(stages):
    before = {r.doc_id: r for r in stages["secret_scans"]}
    times = Counter(r.doc_id for r in stages["source_mix"])
    assert all(before[r.doc_id] == r for r in stages["source_mix"])
    assert max(times.values()) <= 3

    class Taken:
        pass

    sizes = Counter()
    for r in before.values():
        sizes[r.source] += len((r.text or "").split())
    from test_mixing import targets, words

    want = targets(sizes)
    found = []
    for r in before.values():
        row = Taken()
        row.doc_id, row.size = r.doc_id, len(words(r.text))
        row.source_size, row.target, row.taken = sizes[r.source], float(want[r.source]), times[r.doc_id] * len(words(r.text))
        found.append(row)
    check_mix([(r.doc_id, r.text, r.source) for r in before.values()], found)


def test_all_tokens_are_packed(stages):
    texts = [(r.doc_id, r.text) for r in stages["source_mix"]]
    n = check_packing(stages["best_fit_packing"], texts, 2048)
    assert n <= -(-sum(r.length for r in stages["best_fit_packing"]) // 2048) + 3


def test_run_gives_the_rows_of_the_last_stage(spark, stages):
    found = corpus_pipeline.run(spark, SMALL)
    assert sorted(map(tuple, found.drop("sequence_id", "offset").collect())) == sorted(tuple(r)[:5] for r in stages["best_fit_packing"])
