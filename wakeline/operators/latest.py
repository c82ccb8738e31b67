"""Latest row per key and keyed merges, as aggregates with map-side combine (no window sort)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_by_key(df: DataFrame, keys: Sequence[str], order: str,
                  ties: Sequence[str] = ()) -> DataFrame:
    """The row with the greatest `order` per key, NULL times last, ties by `ties`.

    Remaining columns break the last ties, so the same input always gives the same row.
    """
    rest = [c for c in df.columns if c not in keys]
    ranked = [order, *(c for c in ties if c != order)]
    ranked += [c for c in rest if c not in ranked]
    newest = F.max(F.struct(*ranked)).alias("_row")
    return df.groupBy(*keys).agg(newest).select(
        *(F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns)
    )


def upsert(target: DataFrame, updates: DataFrame, keys: Sequence[str],
           update_cols: Sequence[str] | None = None, newer_by: str | None = None) -> DataFrame:
    """Target rows with matching keys take the update's columns; other updates are added.

    `update_cols` limits which columns a match overwrites (the rest keep the target's value).
    With `newer_by` a match is overwritten only by a row that is at least as new. One shuffle,
    no join; several updates of one key are settled by `newer_by`, then by value.
    """
    columns = target.columns
    rest = [c for c in columns if c not in keys]
    changed = [c for c in rest if update_cols is None or c in update_cols]
    kept = [c for c in rest if c not in changed]
    both = target.select(*columns, F.lit(0).alias("_side")).unionByName(
        updates.select(*columns, F.lit(1).alias("_side"))
    )
    time_first = [newer_by] if newer_by else []
    newest = F.struct(*time_first, "_side", *(c for c in changed if c not in time_first))
    aggregates = [F.max(newest).alias("_new")]
    if kept:
        aggregates.append(F.min(F.struct("_side", *kept)).alias("_old"))
    merged = both.groupBy(*keys).agg(*aggregates)

    def pick(name: str):
        if name in keys:
            return F.col(name)
        return F.col(f"_new.{name}" if name in changed else f"_old.{name}").alias(name)

    return merged.select(*(pick(c) for c in columns))


def replace_day(table: DataFrame, rows: DataFrame, date_col: str, day: str) -> DataFrame:
    """The table with all rows of one day exchanged for the given rows of that day."""
    this_day = F.col(date_col) == F.to_date(F.lit(day))
    return table.filter(~F.coalesce(this_day, F.lit(False))).unionByName(rows.filter(this_day))
