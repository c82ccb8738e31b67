"""Stored sketches per day that answer for any range of days by merging, without a rescan.

Quantiles come from KLL sketches, sets with union and intersection from theta sketches, plain
distinct counts from HyperLogLog sketches. A day's sketches are small rows; a range reads these.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rank error of a KLL sketch of this size: about 1.3 % (two-sided, 99 % of queries).
KLL_K = 200
#: Theta sketches are exact up to 2**12 members; beyond, the relative error is about 1.6 %.
THETA_LG = 12
#: HyperLogLog with 2**12 registers: relative error about 1.6 %.
HLL_LG = 12


def quantile_sketches(df: DataFrame, keys: Sequence[str], value: str, k: int = KLL_K) -> DataFrame:
    """(keys, sketch) of a value's distribution; null values are left out."""
    return df.where(F.col(value).isNotNull()).groupBy(*keys).agg(
        F.kll_sketch_agg_double(F.col(value).cast("double"), k).alias("sketch"))


def merged_quantiles(sketches: DataFrame, keys: Sequence[str], rank: float,
                     name: str = "threshold") -> DataFrame:
    """(keys, n, quantile) over all sketches of a group of keys, e.g. all its days."""
    merged = sketches.groupBy(*keys).agg(F.kll_merge_agg_double("sketch").alias("_all"))
    return merged.select(*keys, F.kll_sketch_get_n_double("_all").alias("n"),
                         F.kll_sketch_get_quantile_double("_all", F.lit(rank)).alias(name))


def member_sketches(df: DataFrame, keys: Sequence[str], member: str,
                    lg_entries: int = THETA_LG) -> DataFrame:
    """(keys, members): a theta sketch of the distinct members of each group."""
    return df.groupBy(*keys).agg(F.theta_sketch_agg(member, lg_entries).alias("members"))


def estimated(sketch: Column) -> Column:
    """Rounded number of members; no sketch, no members."""
    return F.coalesce(F.round(F.theta_sketch_estimate(sketch)).cast("bigint"), F.lit(0).cast("bigint"))


def members_of_both(sketches: DataFrame, keys: Sequence[str], first: Column,
                    second: Column) -> DataFrame:
    """(keys, in_first, in_second, in_both): members of two ranges and of both.

    `first` and `second` are conditions on the sketches' rows, such as two ranges of days or two
    ports. One pass; a group with no sketch in one of the ranges has no member there.
    """
    def union(condition: Column) -> Column:
        return F.theta_union_agg(F.when(condition, F.col("members")))

    none = F.theta_union_agg(F.when(F.lit(False), F.col("members")))
    merged = sketches.groupBy(*keys).agg(
        union(first).alias("_first"), union(second).alias("_second"), none.alias("_none"))
    left, right = (F.coalesce(F.col(c), F.col("_none")) for c in ("_first", "_second"))
    return merged.select(*keys, estimated(left).alias("in_first"),
                         estimated(right).alias("in_second"),
                         estimated(F.theta_intersection(left, right)).alias("in_both"))
