"""Gap sessions that never sort all rows of one key in one task.

Time is cut into bins no longer than the gap. Two rows of a bin can then never be more than the
gap apart, so a bin belongs to one session as a whole and shrinks to (first, last, count) before
the shuffle. Only these bin rows are ordered per key: at most one per gap of elapsed time,
however many rows the key has.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wakeline.schema import SESSION_GAP_SECONDS

# Bin length where rows are joined back to their bin: short, so that the rows of a hot key are
# many small groups; a key still has at most 1440 bin rows per day to order.
ROW_BIN_SECONDS = 60


def _seconds(ts: Column) -> Column:
    return F.unix_timestamp(ts)


def time_bin(ts: Column, seconds: int) -> Column:
    return F.floor(_seconds(ts) / F.lit(seconds)).cast("bigint")


def bin_rows(df: DataFrame, keys: Sequence[str], ts: str, seconds: int) -> DataFrame:
    """First, last and count of the rows of each key and time bin."""
    return (
        df.filter(F.col(ts).isNotNull())
        .groupBy(*keys, time_bin(F.col(ts), seconds).alias("bin"))
        .agg(
            F.min(ts).alias("first_ts"),
            F.max(ts).alias("last_ts"),
            F.count("*").alias("row_count"),
        )
    )


def number_sessions(bins: DataFrame, keys: Sequence[str], gap_seconds: int) -> DataFrame:
    """Add session_id (1, 2, ...) to bin rows: a new session starts after a longer gap."""
    ordered = Window.partitionBy(*keys).orderBy("bin")
    previous = F.lag("last_ts").over(ordered)
    starts = F.when(
        previous.isNull() | (_seconds(F.col("first_ts")) - _seconds(previous) > gap_seconds), 1
    ).otherwise(0)
    running = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        bins.withColumns({"prev_last_ts": previous, "_starts": starts})
        .withColumn("session_id", F.sum("_starts").over(running))
        .drop("_starts")
    )


def merge_bins(numbered: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Entry, exit, row count and dwell minutes of each numbered session."""
    dwell = F.round((_seconds(F.col("exit_ts")) - _seconds(F.col("entry_ts"))) / 60.0, 2)
    return (
        numbered.groupBy(*keys, "session_id")
        .agg(
            F.min("first_ts").alias("entry_ts"),
            F.max("last_ts").alias("exit_ts"),
            F.sum("row_count").alias("ping_count"),
        )
        .withColumn("dwell_minutes", dwell)
    )


def gap_sessions(df: DataFrame, keys: Sequence[str], ts: str,
                 gap_seconds: int = SESSION_GAP_SECONDS) -> DataFrame:
    """One row per session: runs of rows of a key whose neighbours are at most the gap apart."""
    bins = bin_rows(df, keys, ts, gap_seconds)
    return merge_bins(number_sessions(bins, keys, gap_seconds), keys)


def tag_sessions(df: DataFrame, keys: Sequence[str], ts: str,
                 gap_seconds: int = SESSION_GAP_SECONDS,
                 bin_seconds: int = ROW_BIN_SECONDS) -> DataFrame:
    """Every row with its session_id. Rows of a hot key spread over its short bins in the join."""
    width = min(gap_seconds, bin_seconds)
    numbered = number_sessions(bin_rows(df, keys, ts, width), keys, gap_seconds)
    lookup = numbered.select(*keys, F.col("bin").alias("_bin"), "session_id")
    binned = df.withColumn("_bin", time_bin(F.col(ts), width))
    return binned.join(lookup, [*keys, "_bin"], "left").drop("_bin")


def previous_row_time(df: DataFrame, keys: Sequence[str], ts: str,
                      bin_seconds: int = ROW_BIN_SECONDS, name: str = "prev_ts") -> DataFrame:
    """Every row with the time of the row before it in its key, as lag over time order gives.

    The lag runs inside short bins; the first row of a bin takes the last time of the bin before.
    """
    bins = bin_rows(df, keys, ts, bin_seconds)
    before = F.lag("last_ts").over(Window.partitionBy(*keys).orderBy("bin"))
    lookup = bins.select(*keys, F.col("bin").alias("_bin"), before.alias("_before"))
    inside = F.lag(ts).over(Window.partitionBy(*keys, "_bin").orderBy(ts))
    return (
        df.withColumn("_bin", time_bin(F.col(ts), bin_seconds))
        .join(lookup, [*keys, "_bin"], "left")
        .withColumn(name, F.coalesce(inside, F.col("_before")))
        .drop("_bin", "_before")
    )
