"""Incremental loads by Structured Streaming: files that arrived since the last run."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from starloom.plans.lakehouse import Lakehouse
from starloom.schemas import BRONZE
from starloom.session import new_folder
from starloom.sources.files import RAW, csv_options, read_parquet, refusal, with_raw_line
from starloom.sources.tables import drop_folder


FORMATS = ("parquet", "csv")


def load_new_files(
    lakehouse: Lakehouse,
    landing: str,
    checkpoint: str,
    on_duplicate: str = "raise",
    files_per_batch: int | None = None,
    file_format: str = "parquet",
    quarantine: str | None = None,
    most_refused: float = 0.01,
) -> list[int]:
    """Load the files in ``landing`` that no earlier run has loaded; return the rows of each micro-batch.

    The checkpoint remembers which files were taken. Each file is a batch of silver
    by its path, and the fact is what silver gives, so neither the cut into
    micro-batches nor a file that comes again (after a crash, or with a new checkpoint)
    changes the result. CSV files have a header that names the bronze columns in order; a
    row that does not fit fails the run. With a folder for ``quarantine`` such rows go there instead, with
    their file, line and reason, and the others are loaded; a micro-batch of which more than the share
    ``most_refused`` does not fit still fails, and leaves everything as it was. The files are then read twice; if they
    change in between, the run fails before silver and fact do.
    """
    if file_format not in FORMATS:
        raise ValueError(f"file_format must be one of {FORMATS}")
    if quarantine is not None and file_format != "csv":
        raise ValueError("only CSV rows can be put into quarantine")
    counts: list[int] = []

    def load(batch: DataFrame, number: int) -> None:
        if quarantine is not None:
            load_rows(*parted(batch, number))
        else:
            load_rows(batch)

    def load_rows(rows: DataFrame, expected: int | None = None) -> None:
        seen = Observation()
        lakehouse.load_files(rows.observe(seen, F.count(F.lit(1)).alias("rows")), on_duplicate, expected)
        counts.append(seen.get["rows"])

    def parted(batch: DataFrame, number: int) -> tuple[DataFrame, int]:
        """The rows of a micro-batch that could be read, and their number; the others are put aside first.

        The files are read once for the bad rows and once for the good ones, which takes less disk than a copy of all.
        """
        spark, path, seen = lakehouse.spark, new_folder(lakehouse.spark, "refused"), Observation()
        try:
            # All columns are written, as Spark parses no others, and a value that is not parsed is not refused.
            refused = batch.observe(seen, F.count(F.lit(1)).alias("rows")).where(F.col(RAW).isNotNull())
            refused.withColumn("reason", refusal(BRONZE)).write.parquet(path)
            rows = seen.get["rows"]
            refused = read_parquet(spark, path, StructType([StructField(c, StringType()) for c in ("file_path", RAW, "reason")]))
            bad = refused.count()
            if bad > most_refused * rows:
                shown = [tuple(r) for r in refused.limit(3).collect()]
                raise ValueError(f"{bad} of {rows} rows do not fit, e.g. {shown}")
            if bad:
                # A micro-batch that comes again replaces its own folder.
                refused.write.mode("overwrite").parquet(f"{quarantine}/batch={number}")
            return batch.where(F.col(RAW).isNull()).drop(RAW), rows - bad
        finally:
            drop_folder(spark, path)

    schema = BRONZE if quarantine is None else with_raw_line(BRONZE)
    reader = lakehouse.spark.readStream.schema(schema).option("recursiveFileLookup", "true")
    if quarantine is not None:
        reader = csv_options(reader).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", RAW)
    elif file_format == "csv":
        reader = csv_options(reader).option("mode", "FAILFAST")
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    query = (
        reader.format(file_format)
        .load(landing)
        .select("*", F.col("_metadata.file_path").alias("file_path"))
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return [n for n in counts if n]
