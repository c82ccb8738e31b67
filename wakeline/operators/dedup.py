"""De-duplication that always keeps the same row, whatever the partitioning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def drop_duplicates(df: DataFrame, keys: Sequence[str],
                    prefer: Sequence[str] = ()) -> DataFrame:
    """One row per key: the smallest by `prefer`, then by the remaining columns.

    An aggregate with map-side combine, so that many copies of one key shrink to one row per
    task before the shuffle, and a retried task picks the same survivor.
    """
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    ranked = [*prefer, *(c for c in rest if c not in prefer)]
    survivor = F.min(F.struct(*ranked)).alias("_row")
    return df.groupBy(*keys).agg(survivor).select(
        *(F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns)
    )
