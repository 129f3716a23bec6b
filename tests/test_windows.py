"""Windows of event time over several runs, with late rows and after a lost micro-batch."""

import datetime
import os

from pyspark.sql import functions as F

from fixtures import rows
from starloom.streaming import close_windows

SCHEMA = "ts timestamp_ntz, kind string, n long"


def at(hour, minute=0):
    return datetime.datetime(2024, 3, 1, hour, minute)


def test_windows_close_once_and_late_rows_are_counted(spark, folder):
    number = 0

    def run(*events):
        nonlocal number
        if events:
            spark.createDataFrame(list(events), SCHEMA).coalesce(1).write.parquet(f"{folder}/landing/{number}")
        number += 1
        schema = spark.createDataFrame([], SCHEMA).schema
        sums = {"n": F.sum("n"), "lines": F.count(F.lit(1))}
        return close_windows(spark, f"{folder}/landing", schema, "ts", "1 hour", "30 minutes", ["kind"], sums, f"{folder}/out", f"{folder}/check")

    def closed():
        found = spark.read.parquet(f"{folder}/out") if os.path.exists(f"{folder}/out") else spark.createDataFrame([], "window_start timestamp_ntz, kind string, n long")
        return rows(found, "window_start", "kind", "n")

    first = run((at(1, 10), "a", 1), (at(1, 50), "a", 2), (at(1, 20), "b", 5), (at(2, 10), "a", 7))
    assert (first.rows, first.late_rows) == (4, 0) and closed() == []
    # Still open, as half an hour has not passed since its end; a row of it may come.
    second = run((at(1, 59), "a", 4), (at(2, 40), None, 3))
    assert second.late_rows == 0 and closed() == [(at(1), "a", 7), (at(1), "b", 5)]
    third = run((at(1, 30), "a", 100), (at(5), "a", 1))
    assert third.late_rows == 1
    assert closed() == [(at(1), "a", 7), (at(1), "b", 5), (at(2), None, 3), (at(2), "a", 7)]
    nothing = run()
    assert (nothing.rows, nothing.late_rows) == (0, 0) and len(closed()) == 4


def test_the_cut_into_micro_batches_does_not_matter(spark, folder):
    events = [(at(h, m), "ab"[m % 2], h * m) for h in range(8) for m in range(0, 60, 7)]
    found = []
    for cut, files in ((8, None), (8, 1), (3, 2)):
        root = f"{folder}/{cut}-{files}"
        step = -(-len(events) // cut)
        for i in range(cut):
            spark.createDataFrame(events[i * step : (i + 1) * step], SCHEMA).coalesce(1).write.parquet(f"{root}/landing/{i}")
            os.utime(f"{root}/landing/{i}")
        schema = spark.createDataFrame([], SCHEMA).schema
        done = close_windows(
            spark, f"{root}/landing", schema, "ts", "2 hours", "2 hours", ["kind"], {"n": F.sum("n")}, f"{root}/out", f"{root}/check", files
        )
        assert (done.rows, done.late_rows) == (len(events), 0)
        found.append(rows(spark.read.parquet(f"{root}/out"), "window_start", "kind", "n"))
    wanted = {}
    for ts, kind, n in events:
        start = ts.replace(hour=ts.hour // 2 * 2, minute=0)
        if start + datetime.timedelta(hours=4) <= events[-1][0]:
            wanted[start, kind] = wanted.get((start, kind), 0) + n
    assert found == [sorted((*k, n) for k, n in wanted.items())] * 3
