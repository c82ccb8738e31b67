"""Distribution statistics per group that need no task to hold a whole group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wakeline.operators.joins import dimension_join
from wakeline.session import materialize


def percentile_threshold(df: DataFrame, groups: Sequence[str], value: str, percent: float,
                         name: str = "threshold_distance") -> DataFrame:
    """Approximate percentile per group; tasks exchange quantile sketches, not rows."""
    return df.groupBy(*groups).agg(
        F.percentile_approx(value, float(percent) / 100.0).alias(name)
    )


def five_numbers(df: DataFrame, groups: Sequence[str], value: str,
                 digits: int = 2) -> DataFrame:
    """Minimum, quartiles (interpolated) and maximum of a value rounded to some digits, per group.

    Equal values are counted before the percentile, so a group's memory follows the number of
    distinct rounded readings (speeds reach about 100), not the number of rows.
    """
    counted = (
        df.filter(F.col(value).isNotNull()).groupBy(*groups, F.round(value, digits).alias(value))
        .agg(F.count("*").alias("_n"))
    )
    quartiles = F.percentile(value, F.array(*(F.lit(q) for q in (0.25, 0.5, 0.75))), F.col("_n"))
    summary = counted.groupBy(*groups).agg(
        F.sum("_n").alias("value_count"),
        F.min(value).alias("min_value"),
        quartiles.alias("_q"),
        F.max(value).alias("max_value"),
    )
    return summary.select(
        *groups, "value_count", "min_value",
        F.col("_q")[0].alias("q1"), F.col("_q")[1].alias("median"), F.col("_q")[2].alias("q3"),
        "max_value",
    )


def histogram(df: DataFrame, groups: Sequence[str], value: str, bins: int = 30
              ) -> DataFrame:
    """Equal-width histogram per group over the group's own range, with density.

    The counted values and the ranges, one row per group, are written down; the ranges are
    broadcast where their size allows it, otherwise the join is salted.

    Bins are closed on the left; the last one also holds the maximum. A group with a single
    distinct value gets a range of one unit around it.
    """
    known = df.filter(F.col(value).isNotNull()).select(*groups, F.col(value).alias("_v"))
    # Counting equal values first keeps everything after it small when values are rounded.
    counted = materialize(known.groupBy(*groups, "_v").agg(F.count("*").alias("_n")), "values")
    ranges = counted.groupBy(*groups).agg(
        F.min("_v").alias("_lo"), F.max("_v").alias("_hi"), F.sum("_n").alias("_total")
    )
    flat = F.col("_lo") == F.col("_hi")
    ranges = ranges.select(
        *groups, "_total",
        F.when(flat, F.col("_lo") - 0.5).otherwise(F.col("_lo")).alias("_lo"),
        F.when(flat, F.col("_hi") + 0.5).otherwise(F.col("_hi")).alias("_hi"),
    )
    width = (F.col("_hi") - F.col("_lo")) / bins
    index = F.least(F.floor((F.col("_v") - F.col("_lo")) / width).cast("int"), F.lit(bins - 1))
    binned = (
        dimension_join(counted, ranges, groups, ("_v",), "inner")
        .groupBy(*groups, index.alias("bin"), "_lo", width.alias("_width"), "_total")
        .agg(F.sum("_n").alias("value_count"))
    )
    return binned.select(
        *groups, "bin",
        (F.col("_lo") + F.col("bin") * F.col("_width")).alias("bin_start"),
        "value_count",
        (F.col("value_count") / (F.col("_total") * F.col("_width"))).alias("density"),
    )
