import re
from collections import defaultdict
from fractions import Fraction

import duckdb
import pytest
from cases import SMALL, bag, make_docs
from compare import assert_same, connect

from starloom.llm.mixing import mix_documents, mixed
from starloom.llm.oracle import ORACLE
from starloom.llm.queries import QUERIES


def targets(sizes):
    """Shares by weight, the excess of those above three times their size shared again, as stated."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    stopped = set()
    while True:
        rest = sum(sizes.values()) - sum(3 * sizes[s] for s in stopped)
        free = sum(weight[s] for s in order if s not in stopped)
        found = {s: Fraction(3 * sizes[s]) if s in stopped else Fraction(weight[s] * rest, free) for s in order}
        above = {s for s in order if found[s] > 3 * sizes[s]}
        if not above:
            return found
        stopped |= above


def words(text):
    return re.findall("[^\\x20\\x09-\\x0D]+", text or "")


def check(rows, found):
    assert sorted(((r.doc_id, r.size) for r in found), key=str) == sorted(((r[0], len(words(r[1]))) for r in rows), key=str)
    sizes, largest = defaultdict(int), defaultdict(int)
    for _, text, source in rows:
        sizes[source] += len(words(text))
        largest[source] = max(largest[source], len(words(text)))
    want = targets(sizes)
    by_size = defaultdict(list)
    for s in sizes:
        by_size[sizes[s], float(want[s])].append(s)
    taken = defaultdict(int)
    for r in found:
        assert 0 <= r.taken <= 3 * r.size
        assert (r.source_size, r.target) in by_size
        taken[r.source_size, r.target] += r.taken
    for key, total in taken.items():
        assert abs(total - key[1] * len(by_size[key])) <= sum(largest[s] for s in by_size[key])


def made_rows():
    rows = [(i, "w " * (i * 7 % 40), f"s{i % 5}") for i in range(400)]
    rows += [(1000 + i, "a b c", "hot") for i in range(300)] + [(2000, "x " * 9, "tiny"), (2001, None, "none"), (2002, "\n \t", "none")]
    return rows + [(3000 + i, "q r s t", None) for i in range(9)] + [(None, "u v", "ß"), (7, "twice here", "é"), (7, "twice here", "é")]


def test_targets_and_sums(spark):
    rows = made_rows()
    found = mixed(make_docs(spark, rows)).collect()
    check(rows, found)
    assert bag(mixed(make_docs(spark, rows[::-1]))) == sorted((tuple(r) for r in found), key=str)


def test_sql_gives_the_same(spark):
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, source VARCHAR)")
    # Rows that repeat are joined to one another by SQL, hence left out.
    rows = [r for r in made_rows() if r[0] != 7]
    con.executemany("INSERT INTO documents VALUES (?, ?, ?)", rows)
    assert assert_same(mixed(make_docs(spark, rows)), con, ORACLE["op5_mixing"]) == len(rows)


@pytest.fixture(scope="module")
def tables():
    con = connect(SMALL)
    yield con
    con.close()


def test_whole_table(spark, tables):
    assert assert_same(QUERIES["op5_mixing"](spark, SMALL), tables, ORACLE["op5_mixing"]) > 0
    rows = [(r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    check(rows, QUERIES["op5_mixing"](spark, SMALL).collect())


def test_documents_come_as_often_as_taken(spark):
    rows = [r for r in made_rows() if r[0] not in (7, None)]
    docs = make_docs(spark, rows)
    found = mix_documents(docs)
    assert found.columns == docs.columns
    times = defaultdict(int)
    for r in found.collect():
        times[r.doc_id] += 1
    want = {r.doc_id: r.taken // r.size for r in mixed(docs).collect() if r.size}
    assert {i: times[i] for i in want} == want


def test_empty_and_wordless_tables(spark):
    assert mixed(make_docs(spark, [])).count() == 0
    assert mix_documents(make_docs(spark, [])).count() == 0
    found = mixed(make_docs(spark, [(1, "", "a"), (2, None, None)])).collect()
    assert [(r.size, r.source_size, r.target, r.taken) for r in found] == [(0, 0, 0.0, 0)] * 2


@pytest.mark.parametrize("copies", [1, 2, 1500])
def test_alike_rows_come_as_near_to_the_target_as_others(spark, copies):
    # A third or more of a source's rows are one row, and the budget ends among them or next to them.
    rows = [(5, "one two three four five six seven", "a")] * copies + [(100 + i, "w " * (1 + i % 9), "a") for i in range(copies)]
    rows += [(50_000 + i, "x y z", s) for i in range(copies) for s in ("b", "c", "d")]
    docs = make_docs(spark, rows).repartition(7)
    found = mixed(docs).collect()
    taken = sum(r.taken for r in found if r.doc_id < 50_000)
    target = next(r.target for r in found if r.doc_id == 5)
    assert abs(taken - target) <= 9
    assert len({r.taken for r in found if r.doc_id == 5}) <= 2 and len(found) == len(rows)
    assert bag(mixed(docs)) == sorted((tuple(r) for r in found), key=str)
    times = sum(1 for r in mix_documents(docs).collect() if r.doc_id == 5)
    assert times == sum(r.taken for r in found if r.doc_id == 5) // 7


def test_sql_of_repeated_rows(spark):
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, source VARCHAR)")
    rows = made_rows() + [(1000, "a b c", "hot")] * 250
    con.executemany("INSERT INTO documents VALUES (?, ?, ?)", rows)
    assert assert_same(mixed(make_docs(spark, rows)), con, ORACLE["op5_mixing"]) == len(rows)
