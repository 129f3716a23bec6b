"""One row per natural id out of many sale lines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def latest_members(rows: DataFrame, id_col: str, attrs: Sequence[str] = (), recency: Column | None = None) -> DataFrame:
    """Distinct non-NULL ids, each with the attributes it had last.

    Last means the greatest ``recency`` (NULL counts as oldest), then the
    greatest attribute values.

    The first aggregation, over id and attributes, keeps only a number per
    group and so runs as a hash aggregation; it shrinks the lines to the distinct
    pairs inside each map task, whatever the share of one id. The second picks
    among the few pairs of an id and again combines before its shuffle.
    """
    rows = rows.where(F.col(id_col).isNotNull())
    if not attrs:
        return rows.select(id_col).distinct()
    seen = F.max(F.lit(0) if recency is None else recency).alias("seen")
    pairs = rows.groupBy(id_col, *attrs).agg(seen)
    winner = pairs.groupBy(id_col).agg(F.max(F.struct("seen", *attrs)).alias("last"))
    return winner.select(id_col, *[F.col(f"last.{a}").alias(a) for a in attrs])
