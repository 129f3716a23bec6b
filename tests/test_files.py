import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from fixtures import plan, rows
from starloom.schemas import BRONZE
from starloom.sources.files import CORRUPT, high_water_mark, on_files, read_csv, rows_after
from starloom.sources.order_lines import bronze_batch, bronze_sales, table

HEADER = ",".join(BRONZE.fieldNames())
LINE = 'BR1,DLR1,Alp-M1,7,1,DT1,28,5,2020,North,"One, Two ""Motors""",Alpha'


def write(path, *lines):
    path.write_bytes(("\r\n".join([HEADER, *lines]) + "\r\n").encode())
    return str(path)


def test_csv_with_quoted_comma_and_crlf(spark, tmp_path):
    found = read_csv(spark, write(tmp_path / "a.csv", LINE, LINE.replace("Alpha", "Beta")), BRONZE)
    assert found.columns == BRONZE.fieldNames()
    assert rows(found, "DealerName", "Product_Name") == [('One, Two "Motors"', "Alpha"), ('One, Two "Motors"', "Beta")]
    assert rows(found, "Revenue", "Day") == [(7, 28), (7, 28)]


def test_bad_csv_row_fails_or_is_kept(spark, tmp_path):
    path = write(tmp_path / "a.csv", LINE, LINE.replace(",7,", ",seven,"))
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        read_csv(spark, path, BRONZE).collect()
    kept = read_csv(spark, path, BRONZE, keep_bad_rows=True)
    assert [r["Revenue"] for r in kept.collect()] == [7, None]
    assert sum(r[CORRUPT] is not None for r in kept.collect()) == 1


def test_csv_columns_in_another_order_are_refused(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text(HEADER.replace("Branch_ID,Dealer_ID", "Dealer_ID,Branch_ID") + "\n" + LINE + "\n")
    with pytest.raises(Exception, match="CSV header"):
        read_csv(spark, str(path), BRONZE).collect()


def test_csv_columns_can_be_pruned(spark, tmp_path):
    found = read_csv(spark, write(tmp_path / "a.csv", LINE), BRONZE)
    assert rows(found, "DealerName") == [('One, Two "Motors"',)]
    assert found.agg(F.sum("Revenue")).first()[0] == 7
    assert found.count() == 1


def test_csv_line_end_inside_quotes(spark, tmp_path):
    path = write(tmp_path / "a.csv", LINE.replace("One, Two", "One\nTwo"))
    found = read_csv(spark, path, BRONZE, multi_line=True).collect()
    assert [r["DealerName"] for r in found] == ['One\nTwo "Motors"']


def test_sql_on_files(spark, folder):
    path = f"{folder}/odd`name"
    spark.range(3).write.parquet(path)
    assert spark.sql(f"SELECT sum(id) AS s FROM {on_files(path)}").first()[0] == 3


def test_rows_after_mark_reach_the_scan(spark):
    events = table(spark, SMALL, "events")
    mark = high_water_mark(events.where(F.col("ts") < F.lit("2024-01-10").cast("timestamp_ntz")), "ts")
    assert isinstance(mark, dt.datetime)
    newer = rows_after(events, "ts", mark)
    assert "GreaterThan(ts," in plan(newer)
    assert 0 < newer.count() < events.count()
    assert newer.where(F.col("ts") <= F.lit(str(mark)).cast("timestamp_ntz")).count() == 0
    assert rows_after(newer, "ts", high_water_mark(newer, "ts")).count() == 0


def test_without_mark_all_rows_are_new(spark):
    events = table(spark, SMALL, "events")
    assert high_water_mark(events.where("false"), "ts") is None
    assert rows_after(events, "ts", None).count() == events.count()


def test_ties_and_missing_marks_are_not_lost(spark):
    loaded = spark.createDataFrame([(1, 5), (2, 6)], "k int, m int")
    now = loaded.union(spark.createDataFrame([(3, 6), (4, 7)], "k int, m int"))
    mark = high_water_mark(loaded, "m")
    assert rows(rows_after(now, "m", mark, ["k"], loaded)) == [(3, 6), (4, 7)]
    missing = now.union(spark.createDataFrame([(9, None)], "k int, m int"))
    assert rows(rows_after(missing, "m", mark, ["k"], loaded)) == [(3, 6), (4, 7), (9, None)]
    with pytest.raises(ValueError, match="1 rows have no m"):
        high_water_mark(missing, "m")


def test_marks_of_other_types(spark):
    numbers = spark.range(5)
    assert rows(rows_after(numbers, "id", 2)) == [(3,), (4,)]
    days = numbers.select(F.expr("timestamp'2024-01-01 00:00:00' + make_dt_interval(id)").alias("t"))
    mark = high_water_mark(days.limit(3), "t")
    assert rows_after(days, "t", mark).count() == 2


def test_batches_split_the_sales(spark):
    parts = [bronze_batch(spark, SMALL, n).count() for n in range(3)]
    assert min(parts) > 0
    assert sum(parts) == bronze_sales(spark, SMALL).count() == table(spark, SMALL, "lineitem").count()
    assert "LessThan(o_orderdate" in plan(bronze_batch(spark, SMALL, 0))


def test_unused_columns_are_not_read(spark):
    text = plan(bronze_sales(spark, SMALL).select("Date_ID"))
    scans = [line for line in text.splitlines() if "ReadSchema" in line]
    assert scans and not any("l_extendedprice" in line or "p_name" in line for line in scans)
