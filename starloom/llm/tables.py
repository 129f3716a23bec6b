"""Helpers that the operators share: staged tables, words, slices of record batches."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from starloom.session import new_folder
from starloom.sources.files import read_parquet

# What separates words, as a pattern for Java and for Python.
GAP = "[\\x20\\x09-\\x0D]+"
WORD = "[^\\x20\\x09-\\x0D]+"


def documents(docs: DataFrame, *more: str) -> DataFrame:
    """``doc_id`` and ``text`` alone, whatever other columns there are; a null text is an empty one."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        *more,
    )


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to a new folder that all executors share and read it back; cuts the lineage."""
    path = new_folder(df.sparkSession, label)
    df.write.parquet(path)
    return read_parquet(df.sparkSession, path, df.schema)


def drop_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder of this application that nothing reads any more."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def free_name(df: DataFrame, wish: str) -> str:
    """``wish``, with underscores behind it until no column of ``df`` has that name in either case."""
    taken = {c.lower() for c in df.columns}
    while wish.lower() in taken:
        wish += "_"
    return wish


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def words(text: Column) -> Column:
    """The words of a text as an array."""
    return F.filter(F.split(text, GAP), lambda w: w != "")


def slices(batches: Iterable[pa.RecordBatch], column: str, limit: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Cut batches so that a slice holds ``limit`` bytes of ``column`` at most, or one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        col = batch.column(column)
        if pa.types.is_list(col.type):
            sizes = pc.multiply(pc.list_value_length(col), 8)
        else:
            sizes = pc.binary_length(col)
        ends = np.cumsum(np.asarray(pc.fill_null(sizes, 0), dtype=np.int64))
        start = 0
        while start < batch.num_rows:
            before = int(ends[start - 1]) if start else 0
            end = max(start + 1, int(np.searchsorted(ends, before + limit, "right")))
            yield batch.slice(start, end - start)
            start = end


def list_parts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The values of a list column without nulls and where each row's begin; one more entry for the end."""
    offsets = np.asarray(column.offsets, dtype=np.int64)
    flat = np.asarray(column.values)[offsets[0] : offsets[-1]]
    return flat, offsets - offsets[0]


def spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """``starts[i], starts[i] + 1, ...`` over ``lengths[i]`` places for each i, one after the other."""
    lengths = lengths.astype(np.int64)
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(total, dtype=np.int64)
