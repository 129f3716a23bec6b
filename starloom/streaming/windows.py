"""Sums per window of event time, kept in the state of a stream and written once a window is closed."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType


@dataclass
class WindowRun:
    """What one run has done: rows read, and rows that came after their window had closed."""

    rows: int
    late_rows: int


def close_windows(
    spark: SparkSession,
    landing: str,
    schema: StructType,
    time: str,
    width: str,
    delay: str,
    keys: Sequence[str],
    sums: dict[str, Column],
    out: str,
    checkpoint: str,
    files_per_batch: int | None = None,
) -> WindowRun:
    """Add the Parquet files in ``landing`` that no earlier run has taken; append windows that are closed by now to ``out``.

    A window closes when ``delay`` has passed since its end, by the latest time that was seen.
    Open windows wait in the state store next to the checkpoint, so a run goes on where the last one has stopped,
    and state is as large as the open windows' groups. Rows of closed windows are left out and counted, never
    added to a window that was written. Each micro-batch writes its own folder and replaces it if it
    comes again. ``sums`` names aggregations by their output columns.
    """
    reader = spark.readStream.schema(schema).option("recursiveFileLookup", "true")
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    # A watermark needs points in time; local times become those of the session's zone, and go back below.
    rows = reader.parquet(landing).withColumn("event_time", F.col(time).cast("timestamp")).withWatermark("event_time", delay)
    found = rows.groupBy(F.window("event_time", width), *keys).agg(*(value.alias(name) for name, value in sums.items()))
    kind = schema[time].dataType
    found = found.select(F.col("window.start").cast(kind).alias("window_start"), F.col("window.end").cast(kind).alias("window_end"), *keys, *sums)

    def write(closed: DataFrame, number: int) -> None:
        closed.write.mode("overwrite").parquet(f"{out}/batch={number}")

    query = (
        found.writeStream.foreachBatch(write).outputMode("append").option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    progress = query.recentProgress
    late = sum(int(op["numRowsDroppedByWatermark"]) for p in progress for op in p["stateOperators"])
    return WindowRun(sum(int(p["numInputRows"]) for p in progress), late)
