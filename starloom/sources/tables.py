"""Parquet tables of the catalog at fixed places, changed by Spark's own overwrite.

Rows are written aside first, where they can be checked or used; ``put`` then lets them take the
place of the whole table, or of the partitions that they replace, by INSERT OVERWRITE
with dynamic partitions. All other partitions stay unread. From the moment that
counts the copy is marked, and it goes when the overwrite has ended: whoever opens a
table with a marked copy overwrites once more, so a crash within Spark's commit loses no
rows. A table has one writer at a time; who reads files that are replaced meanwhile has to read again.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import DataType, StructField, StructType

from starloom.schemas import no_rows

_MARKS = {True: "_REPLACES_ALL", False: "_REPLACES_PARTS"}
_MODE = "spark.sql.sources.partitionOverwriteMode"
_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
_WRITERS = "spark.sql.maxConcurrentOutputFileWriters"

# Files that a task which copies staged rows holds open at once; they lie by partition already, so Spark sorts
# only rows of a task that meets more partitions than this.
OPEN_FILES = 128

# Codec of large copies that are read a few times and dropped.
COPY_CODEC = "zstd"

# Input, in bytes of its files, for each partition of a shuffle, and the most partitions asked for.
TASK_BYTES = 8 << 20
MOST_PARTITIONS = 20_000


def file_system(spark: SparkSession, path: str):
    """``path`` as the JVM's object, and whatever file system holds it."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path, hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    hadoop_path, fs = file_system(spark, path)
    return fs.exists(hadoop_path)


def drop_folder(spark: SparkSession, path: str) -> None:
    hadoop_path, fs = file_system(spark, path)
    fs.delete(hadoop_path, True)


def partitions_for(df: DataFrame) -> int:
    """Partitions of a shuffle of ``df``: what the session says, and more if its files are large, so that a task's share does not grow with them."""
    spark = df.sparkSession
    size = 0
    for file in df.inputFiles():
        hadoop_path, fs = file_system(spark, file)
        size += fs.getFileStatus(hadoop_path).getLen()
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), min(-(-size // TASK_BYTES), MOST_PARTITIONS))


@contextmanager
def spread(df: DataFrame) -> Iterator[None]:
    """For a write of ``df``: its shuffles get as many partitions as its input needs; adaptive execution joins small ones again."""
    conf = df.sparkSession.conf
    before = conf.get(_PARTITIONS, None)
    conf.set(_PARTITIONS, str(max(partitions_for(df), int(before or 0))))
    try:
        yield
    finally:
        conf.unset(_PARTITIONS) if before is None else conf.set(_PARTITIONS, before)


def write_spread(df: DataFrame, path: str) -> None:
    """Write a copy of ``df`` with its shuffles in as many partitions as its input needs."""
    with spread(df):
        df.write.mode("overwrite").option("compression", COPY_CODEC).parquet(path)


class CatalogTable:
    """The external table ``name``; ``parts`` gives type and expression of each partition column, never null.

    ``order`` sorts the rows of each file, which narrows the value range of its row groups.
    With ``buckets``, keys and a number, rows lie in that many buckets by their keys, and
    ``merged`` finds rows to replace without a shuffle of the table. Such keys are numbers from 1 on, and the files hold
    0 for NULL, so that an ordinary equality finds it; ``read`` gives NULL again.
    """

    def __init__(
        self, spark: SparkSession, name: str, path: str, schema: StructType,
        parts: Mapping[str, tuple[DataType, Column]] | None = None, order: str | None = None,
        buckets: tuple[Sequence[str], int] | None = None,
    ):
        self.spark, self.name, self.path, self.schema, self.order = spark, name, path, schema, order
        self.bucket_keys, self.bucket_number = ([*buckets[0]], buckets[1]) if buckets else ([], 0)
        self.parts = dict(parts or {})
        self.whole = StructType([*schema.fields, *(StructField(p, kind) for p, (kind, _) in self.parts.items())])
        parent, _, folder = path.rpartition("/")
        self.aside = f"{parent}/_aside.{folder}"
        self._known = False

    def exists(self) -> bool:
        """Whether anything was ever put in. Ends an overwrite that a crash has left, and publishes the table if the catalog lacks it."""
        for whole, mark in () if self._known else _MARKS.items():
            if exists(self.spark, f"{self.aside}/{mark}"):
                self._publish()
                self._overwrite(whole)
        there = exists(self.spark, self.path)
        if there and not (self._known and self.spark.catalog.tableExists(self.name)):
            self._publish()
        self._known = there
        return there

    def read(self, *with_parts: str) -> DataFrame:
        """The current rows, with the partition columns named; none if nothing was put in."""
        columns = [*self.schema.fieldNames(), *with_parts]
        if not self.exists():
            return no_rows(self.spark, self.whole).select(columns)
        return self._with_nulls(self.spark.table(self.name).select(columns))

    def _with_nulls(self, stored: DataFrame) -> DataFrame:
        return stored.select([F.nullif(c, F.lit(0)).alias(c) if c in self.bucket_keys else F.col(c) for c in stored.columns])

    def _without_nulls(self, df: DataFrame) -> DataFrame:
        def key(c: str) -> Column:
            refused = F.raise_error(F.concat(F.lit(f"{self.name}: {c} must not be "), F.col(c).cast("string")))
            return F.when(F.col(c) < 1, refused.cast("bigint")).otherwise(F.coalesce(c, F.lit(0))).cast(self.schema[c].dataType).alias(c)

        return df.select([key(c) if c in self.bucket_keys else F.col(c) for c in df.columns])

    def merged(self, rows: DataFrame, replaced: DataFrame, within: Column) -> DataFrame:
        """Rows of the partitions ``within`` whose keys are not in ``replaced``, and ``rows``, laid out by bucket.

        Only ``rows`` and ``replaced`` are shuffled, to where the table's buckets are read. Both kinds of rows of a
        bucket come from a task of their own, so what is written has two files for each bucket at most.
        """
        keys = self.bucket_keys
        old = self.spark.table(self.name).where(within).select(self.schema.fieldNames()).alias("old")
        gone = self._without_nulls(replaced.select(keys)).alias("gone")
        match = reduce(and_, [F.col(f"old.{k}") == F.col(f"gone.{k}") for k in keys])
        kept = old.join(gone, match, "left_anti")
        new = self._without_nulls(rows.select(self.schema.fieldNames())).repartition(self.bucket_number, *keys)
        return self._with_nulls(kept.unionByName(new))

    @contextmanager
    def staged(self, df: DataFrame, laid_out: bool = False) -> Iterator[DataFrame]:
        """``df`` with its partition columns, written aside; gone afterwards unless an overwrite from it was cut off.

        Rows are brought together by partition or bucket, unless they are ``laid_out`` already.
        """
        self.exists()
        for part, (kind, value) in self.parts.items():
            df = df.withColumn(part, value.cast(kind))
        df = self._without_nulls(df.select(self.whole.fieldNames()))
        if self.bucket_keys and not laid_out:
            df = df.repartition(self.bucket_number, *self.bucket_keys)
        elif self.parts and not laid_out:
            # Brings a partition's rows together, and splits one that is too large for a task.
            df = df.hint("rebalance", *self.parts)
        sort = [*self.parts, *([self.order] if self.order else [])]
        df = df.sortWithinPartitions(*sort) if sort else df
        # Tables without partitions are small and may be written side by side.
        write_spread(df, self.aside) if self.parts else df.write.mode("overwrite").parquet(self.aside)
        try:
            yield self._with_nulls(self.spark.read.schema(self.whole).parquet(self.aside))
        finally:
            if not any(exists(self.spark, f"{self.aside}/{mark}") for mark in _MARKS.values()):
                drop_folder(self.spark, self.aside)

    def put(self, within: Column | None = None) -> None:
        """Let the staged rows take the place of those partitions that meet ``within``, or of the whole table."""
        gone = []
        if within is not None and self.exists():
            keys = lambda rows: rows.select(*self.parts).distinct()
            new = self.spark.read.schema(self.whole).parquet(self.aside)
            # Partitions that get no rows: as few as folders.
            gone = keys(self.spark.table(self.name).where(within)).join(keys(new), list(self.parts), "left_anti").collect()
        mark, fs = file_system(self.spark, f"{self.aside}/{_MARKS[within is None]}")
        fs.create(mark, True).close()
        self._publish()
        empty = ", ".join(f"CAST(NULL AS {f.dataType.simpleString()})" for f in self.schema)
        for row in gone:
            spec = ", ".join(f"`{p}` = {row[p]!r}" for p in self.parts)
            self.spark.sql(f"INSERT OVERWRITE TABLE {self.name} PARTITION ({spec}) SELECT {empty} WHERE false")
        self._overwrite(within is None)

    def replace(self, df: DataFrame, check=None) -> None:
        """``df`` becomes the whole table, unless ``check`` of the staged rows raises."""
        with self.staged(df) as new:
            if check is not None:
                check(new.select(self.schema.fieldNames()))
            self.put()

    def _overwrite(self, whole: bool) -> None:
        conf = {_MODE: "static" if whole else "dynamic", _WRITERS: str(OPEN_FILES)} if self.parts else {}
        before = {name: self.spark.conf.get(name) for name in conf}
        for name, value in conf.items():
            self.spark.conf.set(name, value)
        try:
            self.spark.read.schema(self.whole).parquet(self.aside).write.insertInto(self.name, overwrite=True)
        finally:
            for name, value in before.items():
                self.spark.conf.set(name, value)
        drop_folder(self.spark, self.aside)
        self._known = True

    def _publish(self) -> None:
        """Declare the table, so that no file is opened for its schema; the catalog finds the partitions by their folders."""
        if not self.spark.catalog.tableExists(self.name):
            self.spark.sql(f"CREATE SCHEMA IF NOT EXISTS {self.name.rpartition('.')[0]}")
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.whole)
            by = f"PARTITIONED BY ({', '.join(f'`{p}`' for p in self.parts)})" if self.parts else ""
            self._check_folders()
            keys = ", ".join(f"`{k}`" for k in self.bucket_keys)
            buckets = f"CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {self.bucket_number} BUCKETS" if keys else ""
            self.spark.sql(f"CREATE TABLE {self.name} ({columns}) USING parquet {by} {buckets} LOCATION '{self.path}'")
            if self.parts and exists(self.spark, self.path):
                self.spark.sql(f"ALTER TABLE {self.name} RECOVER PARTITIONS")
        described = {r["col_name"]: r["data_type"] for r in self.spark.sql(f"DESCRIBE TABLE EXTENDED {self.name}").collect()}
        hadoop_path, fs = file_system(self.spark, self.path)
        if described["Location"] != fs.makeQualified(hadoop_path).toString():
            raise ValueError(f"{self.name} is a table at {described['Location']}, not at {self.path}")
        if int(described.get("Num Buckets", 0)) != self.bucket_number:
            raise ValueError(f"{self.name} has {described.get('Num Buckets', 0)} buckets, not {self.bucket_number}")
        columns = self.spark.table(self.name).columns
        if columns != self.whole.fieldNames():
            raise ValueError(f"{self.name} has the columns {columns}, not {self.whole.fieldNames()}")

    def _check_folders(self) -> None:
        """A folder by other partition columns would look empty; one folder tells."""
        hadoop_path, fs = file_system(self.spark, self.path)
        found = fs.listStatusIterator(hadoop_path) if self.parts and fs.exists(hadoop_path) else None
        while found is not None and found.hasNext():
            column, equals, _ = found.next().getPath().getName().partition("=")
            if equals:
                if column != next(iter(self.parts)):
                    raise ValueError(f"{self.path} is partitioned by {column}, not by {next(iter(self.parts))}")
                return


def range_bucket(key: str, width: int) -> Column:
    """Number of the ``width``-wide range that a key (1, 2, ...) falls into; -1 for NULL."""
    return F.coalesce(F.floor((F.col(key) - 1) / width), F.lit(-1)).cast("int")


def hash_bucket(column: str, number: int) -> Column:
    """One of ``number`` buckets by a hash of the value; NULLs share one."""
    return F.pmod(F.xxhash64(column), F.lit(number)).cast("int")
