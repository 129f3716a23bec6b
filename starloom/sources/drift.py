"""Parquet folders whose files were written with different schemas over time.

A job reads the footer of each file, one small row a file, and sums them by schema; no
more rows than there are different schemas reach the driver. The schemas become one: columns
are added, types widened as far as Spark's Parquet reader widens values without loss. So all generations
of files are one scan with column pruning and pushed filters, and no file is rewritten.
Files that fit no such schema are refused by name, with the reason, and their names keep the
scan from opening them.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from urllib.parse import unquote, urlsplit

import pyarrow as pa
import pyarrow.fs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.pandas.types import from_arrow_type
from pyspark.sql.types import (
    ArrayType, ByteType, DataType, DateType, DecimalType, DoubleType, FloatType, IntegerType, LongType, MapType,
    ShortType, StructField, StructType, TimestampNTZType, TimestampType,
)

from starloom.session import ship_code

# Where Spark notes a file's schema, and the digits that whole numbers need in a decimal.
SPARK_SCHEMA = b"org.apache.spark.sql.parquet.row.metadata"
DIGITS = {ByteType: 10, ShortType: 10, IntegerType: 10, LongType: 20}
SMALL = (ByteType, ShortType, IntegerType)
# Schemes that the JVM's file systems and Arrow's name differently.
SCHEMES = {"s3a": "s3", "s3n": "s3"}

FOOTERS = "file string, schema string, problem string"


class SchemaDrift(ValueError):
    """Files whose schema cannot be reconciled with that of the others."""


def widened(a: DataType, b: DataType) -> DataType | None:
    """The narrowest type to which a Parquet scan widens values of both without loss; None if there is none."""
    if a == b:
        return a
    if isinstance(a, StructType) and isinstance(b, StructType):
        merged, lost = _merge(a, b)
        return None if lost else merged
    if isinstance(a, ArrayType) and isinstance(b, ArrayType):
        element = widened(a.elementType, b.elementType)
        return element and ArrayType(element, a.containsNull or b.containsNull)
    if isinstance(a, MapType) and isinstance(b, MapType):
        key, value = widened(a.keyType, b.keyType), widened(a.valueType, b.valueType)
        return MapType(key, value, a.valueContainsNull or b.valueContainsNull) if key and value else None
    whole = list(DIGITS)
    if type(a) in DIGITS and type(b) in DIGITS:
        return max(a, b, key=lambda t: whole.index(type(t)))
    for one, other in ((a, b), (b, a)):
        if isinstance(one, DoubleType) and isinstance(other, (FloatType, *SMALL)):
            return one
        if isinstance(one, FloatType) and isinstance(other, SMALL):
            return DoubleType()
        if isinstance(one, TimestampNTZType) and isinstance(other, DateType):
            return one
        if isinstance(one, DecimalType) and type(other) in DIGITS:
            return _decimal(max(one.precision - one.scale, DIGITS[type(other)]), one.scale)
    if isinstance(a, DecimalType) and isinstance(b, DecimalType):
        return _decimal(max(a.precision - a.scale, b.precision - b.scale), max(a.scale, b.scale))
    return None


def _decimal(before: int, scale: int) -> DecimalType | None:
    return DecimalType(before + scale, scale) if before + scale <= 38 else None


def _merge(a: StructType, b: StructType) -> tuple[StructType, list[str]]:
    """``a`` with the columns of ``b`` added and its types widened, and why ``b`` does not fit. Names match without regard to case."""
    fields, lost = {f.name.lower(): f for f in a}, []
    for f in b:
        known = fields.get(f.name.lower())
        kind = widened(known.dataType, f.dataType) if known else f.dataType
        if kind is None:
            lost.append(f"{known.name}: {f.dataType.simpleString()} instead of {known.dataType.simpleString()}")
        else:
            fields[f.name.lower()] = StructField(known.name if known else f.name, kind)
    return StructType(list(fields.values())), lost


def _spark_schema(file: pq.ParquetFile) -> StructType:
    """A file's schema as Spark wrote it down, else by its Parquet types; raises if Spark cannot read one of them."""
    noted = (file.metadata.metadata or {}).get(SPARK_SCHEMA)
    if noted:
        return StructType.fromJson(json.loads(noted))
    int96 = {file.schema.column(i).path for i in range(len(file.schema)) if file.schema.column(i).physical_type == "INT96"}
    fields = []
    for f in file.schema_arrow:
        if f.name in int96:
            kind = TimestampType()
        elif pa.types.is_timestamp(f.type) and f.type.unit == "ns":
            raise ValueError(f"{f.name}: timestamps of nanoseconds")
        else:
            kind = from_arrow_type(f.type, prefer_timestamp_ntz=True)
        fields.append(StructField(f.name, kind))
    return StructType(fields)


def _plain(schema: StructType) -> StructType:
    """The schema without metadata and nullability, which do not matter here."""
    return StructType([StructField(f.name, _nullable(f.dataType)) for f in schema])


def _nullable(kind: DataType) -> DataType:
    if isinstance(kind, StructType):
        return _plain(kind)
    if isinstance(kind, ArrayType):
        return ArrayType(_nullable(kind.elementType))
    if isinstance(kind, MapType):
        return MapType(_nullable(kind.keyType), _nullable(kind.valueType))
    return kind


def open_footer(uri: str) -> pq.ParquetFile:
    """A file of the URI that Spark gives it, of which Arrow reads no more than the footer.

    Arrow takes the place of the JVM's file systems here: the machine needs its access to them.
    """
    parts = urlsplit(uri)
    if parts.scheme in ("", "file"):
        return pq.ParquetFile(unquote(parts.path))
    system, path = pyarrow.fs.FileSystem.from_uri(parts._replace(scheme=SCHEMES.get(parts.scheme, parts.scheme)).geturl())
    return pq.ParquetFile(system.open_input_file(path))


def _footers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        schemas, problems = [], []
        for uri in batch.column("file").to_pylist():
            try:
                with open_footer(uri) as file:
                    own = _plain(_spark_schema(file))
                if len({n.lower() for n in own.names}) < len(own):
                    raise ValueError("column names that differ in case alone")
                schema, problem = own.json(), None
            except FileNotFoundError:
                raise  # a file that went away, or a folder that this machine does not see, is no file's fault
            except Exception as error:  # whatever the footer holds
                lines = str(error).splitlines()
                schema, problem = None, f"{type(error).__name__}: {lines[0] if lines else ''}"
            schemas.append(schema)
            problems.append(problem)
        yield pa.RecordBatch.from_arrays(
            [batch.column("file"), pa.array(schemas, pa.string()), pa.array(problems, pa.string())], ["file", "schema", "problem"]
        )


def file_schemas(spark: SparkSession, path: str, recursive: bool = False) -> DataFrame:
    """``file, schema, problem`` of each Parquet file under ``path``: its schema as JSON, or why it has none."""
    ship_code(spark)
    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", recursive).load(path)
    files = found.select(F.col("_metadata.file_path").alias("file"))
    # Names are few bytes: left to themselves they would end up in one task.
    return files.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "file").mapInArrow(_footers, FOOTERS)


@dataclass
class Reconciled:
    """The schema that holds for all files but the ``refused`` ones, which are named with the reason."""

    path: str
    schema: StructType
    recursive: bool = False
    refused: dict[str, str] = field(default_factory=dict)

    def read(self, spark: SparkSession) -> DataFrame:
        """Rows of all files but the refused ones, in one scan; a column that a file lacks is NULL."""
        rows = spark.read.schema(self.schema).option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", self.recursive)
        rows = rows.parquet(self.path)
        # A filter on names is applied to the listing, so that these files are never opened.
        return rows.where(~F.col("_metadata.file_path").isin(list(self.refused))) if self.refused else rows


def reconcile(
    spark: SparkSession,
    path: str,
    expected: StructType | None = None,
    required: Sequence[str] = (),
    recursive: bool = False,
    most_schemas: int = 10_000,
    most_refused: int = 0,
) -> Reconciled:
    """One schema for all Parquet files under ``path``.

    Types start from those of ``expected``, if given; then schemas count by their number of files,
    ties by the first name, and each one widens what came before or is refused with its files.
    A file that lacks one of the ``required`` columns is refused, as is one without a readable
    footer. ``most_schemas`` bounds what the driver holds; more refused files than ``most_refused``
    raise ``SchemaDrift``, which names some of them. Without any file the schema is ``expected``.
    """
    footers = file_schemas(spark, path, recursive).cache()
    try:
        groups = (
            footers.groupBy("schema", "problem").agg(F.count(F.lit(1)).alias("files"), F.min("file").alias("first"))
            .orderBy(F.desc("files"), "first").limit(most_schemas + 1).collect()
        )
        if len(groups) > most_schemas:
            raise SchemaDrift(f"more than {most_schemas} different schemas under {path}")
        schema, reasons = expected or StructType([]), []
        for group in groups:
            if group["problem"]:
                reasons.append((group["schema"], group["problem"], group["problem"], group["files"]))
                continue
            own = StructType.fromJson(json.loads(group["schema"]))
            names = {n.lower() for n in own.names}
            merged, lost = _merge(schema, own)
            lost += [f"{c}: missing" for c in required if c.lower() not in names]
            if lost:
                reasons.append((group["schema"], None, "; ".join(lost), group["files"]))
            else:
                schema = merged
        if not reasons:
            return Reconciled(path, schema, recursive)
        why = spark.createDataFrame([r[:3] for r in reasons], "schema string, problem string, reason string")
        match = F.col("f.schema").eqNullSafe(F.col("why.schema")) & F.col("f.problem").eqNullSafe(F.col("why.problem"))
        named = footers.alias("f").join(F.broadcast(why).alias("why"), match).select("file", "reason")
        number = sum(r[3] for r in reasons)
        if number > most_refused:
            some = "; ".join(f"{r['file']} ({r['reason']})" for r in named.orderBy("file").limit(5).collect())
            raise SchemaDrift(f"{number} files do not fit, e.g. {some}")
        return Reconciled(path, schema, recursive, {r["file"]: r["reason"] for r in named.collect()})
    finally:
        footers.unpersist()
