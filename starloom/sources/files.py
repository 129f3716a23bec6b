"""Readers: Parquet, SQL directly on files, CSV batches, and rows newer than a mark."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType, TimestampNTZType

CORRUPT = "_corrupt_record"


def read_parquet(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """All files under ``path`` with a declared schema, so no footer is read to infer one."""
    return spark.read.schema(schema).parquet(path)


def on_files(path: str) -> str:
    """``path`` as a relation for SQL text: ``SELECT ... FROM {on_files(path)}``."""
    return "parquet.`" + path.replace("`", "``") + "`"


def csv_options(reader):
    """Options of a batch or stream reader for CSV with a header that is checked, and doubled quotes."""
    return reader.option("header", True).option("enforceSchema", False).option("escape", '"')


def read_csv(
    spark: SparkSession, path: str, schema: StructType, keep_bad_rows: bool = False, multi_line: bool = False
) -> DataFrame:
    """A CSV batch; quoted commas and either kind of line end. The header must name the schema's columns in order.

    A row that does not fit the schema fails a read of the column that does not fit,
    or is kept with its text in ``_corrupt_record``. Spark does not parse columns
    that a query leaves out, so a count or a projection can pass over a bad row;
    silver reads all columns and refuses it. ``multi_line`` admits line ends inside
    quotes, at the price that a file is no longer split among tasks.
    """
    reader = csv_options(spark.read).option("multiLine", multi_line)
    if keep_bad_rows:
        schema = StructType([*schema.fields, StructField(CORRUPT, StringType())])
        return reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).schema(schema).csv(path)
    return reader.option("mode", "FAILFAST").schema(schema).csv(path)


def high_water_mark(df: DataFrame, column: str) -> Any:
    """Greatest value of ``column``; None if there are no rows. One row reaches the driver.

    Raises if there are rows without a value: no mark could ever tell whether they were loaded.
    """
    mark, missing = df.agg(F.max(column), F.count_if(F.col(column).isNull())).first()
    if missing:
        raise ValueError(f"{missing} rows have no {column}")
    return mark


def rows_after(df: DataFrame, column: str, mark: Any, keys: Sequence[str] = (), loaded: DataFrame | None = None) -> DataFrame:
    """Rows beyond the mark of the last load; all rows if nothing was loaded yet.

    Rows may still arrive that have exactly the mark's value. With ``keys``, which
    identify a row, and ``loaded``, the rows loaded before, those ties come too unless
    ``loaded`` has them. The mark is a literal of the column's own type, so the filter
    reaches the Parquet scan. Rows without a value are kept, so that the next mark
    is refused instead of their being lost.
    """
    if mark is None:
        return df
    dtype = df.schema[column].dataType
    # A Python datetime would become an instant in this machine's time zone.
    value = str(mark) if isinstance(dtype, TimestampNTZType) else mark
    limit = F.lit(value).cast(dtype)
    if loaded is None:
        return df.where((F.col(column) > limit) | F.col(column).isNull())
    ties = loaded.where(F.col(column) == limit).select(*keys).alias("loaded")
    match = reduce(and_, [F.col(f"new.{k}").eqNullSafe(F.col(f"loaded.{k}")) for k in keys])
    newer = df.where((F.col(column) >= limit) | F.col(column).isNull())
    return newer.alias("new").join(ties, match, "left_anti")


RAW = "raw_line"  # rows that could not be read keep their line here


def with_raw_line(schema: StructType) -> StructType:
    """``schema`` for a CSV reader that keeps lines it cannot read."""
    return StructType([*schema.fields, StructField(RAW, StringType())])


def refusal(schema: StructType) -> Column:
    """Why the line in ``RAW`` is no row of ``schema``: the first value that does not fit, or the number of fields.

    The line is read once more as strings; that costs nothing for lines that are rows.
    """
    texts = StructType([StructField(f.name, StringType()) for f in schema] + [StructField("too_many", StringType())])
    fields = F.from_csv(F.col(RAW), texts.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " "), {"escape": '"'})
    fits = [F.lit(None).cast("string")]
    for f in schema:
        value = fields[f.name]
        bad = value.isNotNull() & value.try_cast(f.dataType).isNull()
        fits.append(F.when(bad, F.concat(F.lit(f"{f.name}: "), value)))
    return F.coalesce(*fits[1:], F.lit("number of fields"))
