"""Vessels and speed per port in sliding windows, from mergeable slots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wakeline.operators.sketches import HLL_LG

WINDOW_SECONDS = 3600
SLIDE_SECONDS = 900
#: Vessels in a window from which a port is busy, and crowded.
RISK_LEVELS = ((50, "HIGH"), (20, "MEDIUM"))


def port_slots(inside: DataFrame, port: str = "port_id", vessel: str = "MMSI",
               ts: str = "BaseDateTime", speed: str = "SOG", slide_seconds: int = SLIDE_SECONDS,
               exact: bool = False) -> DataFrame:
    """(port, slot, vessels, speed_sum, speed_count) of each slot of one slide's length.

    `vessels` is a HyperLogLog sketch, or with `exact` the set of vessels. A position is aggregated
    into one slot, however many windows overlap there; later steps read slots only.
    """
    slot = F.floor(F.unix_timestamp(ts) / slide_seconds).cast("bigint")
    vessels = F.collect_set(vessel) if exact else F.hll_sketch_agg(vessel, HLL_LG)
    return inside.groupBy(port, slot.alias("slot")).agg(
        vessels.alias("vessels"), F.sum(F.col(speed).cast("decimal(18,6)")).alias("speed_sum"),
        F.count(speed).alias("speed_count"))


def _risk(vessels: Column, levels) -> Column:
    label = F.lit("LOW")
    for least, name in sorted(levels):
        label = F.when(vessels >= least, F.lit(name)).otherwise(label)
    return label


def port_congestion(slots: DataFrame, port: str = "port_id", window_seconds: int = WINDOW_SECONDS,
                    slide_seconds: int = SLIDE_SECONDS, levels=RISK_LEVELS,
                    exact: bool = False) -> DataFrame:
    """(port, window_start, active_vessels_count, avg_speed_knots, congestion_risk).

    Windows start at every slide; only windows with a position appear. Slots are merged, so a vessel
    that stays counts once in a window; the count is within the sketch's error, or exact.
    """
    if window_seconds % slide_seconds:
        raise ValueError("a window has to be a whole number of slides")
    width = window_seconds // slide_seconds
    spread = slots.withColumn("_window", F.explode(
        F.sequence(F.col("slot") - (width - 1), F.col("slot"))))
    if exact:
        count = F.size(F.array_distinct(F.flatten(F.collect_list("vessels")))).cast("bigint")
    else:
        count = F.hll_sketch_estimate(F.hll_union_agg("vessels"))
    windows = spread.groupBy(port, "_window").agg(
        count.alias("active_vessels_count"), F.sum("speed_sum").alias("_speed"),
        F.sum("speed_count").alias("_readings"))
    return windows.select(
        port, F.timestamp_seconds(F.col("_window") * slide_seconds).alias("window_start"),
        "active_vessels_count",
        F.round((F.col("_speed") / F.col("_readings")).cast("double"), 2).alias("avg_speed_knots"),
        _risk(F.col("active_vessels_count"), levels).alias("congestion_risk"))
