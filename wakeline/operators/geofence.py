"""Events of vessels at zones: ENTER, INSIDE and EXIT.

A vessel is in a zone from the first position there (ENTER) over further ones (INSIDE) until its
first position elsewhere, or until it has been silent for too long (EXIT, at the end of the silence
allowed). Positions of a vessel have different times. streaming/geofence.py gives the same events
with state per vessel.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wakeline.operators.sessions import ROW_BIN_SECONDS, time_bin

SILENCE_SECONDS = 7200


def with_neighbours(df: DataFrame, keys: Sequence[str], ts: str, carried: str,
                    bin_seconds: int = ROW_BIN_SECONDS) -> DataFrame:
    """Every row with structs `before` and `after`: time and `carried` of the rows around it.

    As lag and lead over the time order of a key, but a hot key's rows are ordered within short
    bins only; the first and last row of a bin look at the bins around theirs.
    """
    row = F.struct(F.col(ts).alias("ts"), F.col(carried).alias("value"))
    binned = df.withColumn("_bin", time_bin(F.col(ts), bin_seconds))
    bins = binned.groupBy(*keys, "_bin").agg(F.min_by(row, ts).alias("_first"),
                                             F.max_by(row, ts).alias("_last"))
    by_bin = Window.partitionBy(*keys).orderBy("_bin")
    around = bins.select(*keys, "_bin", F.lag("_last").over(by_bin).alias("_before"),
                         F.lead("_first").over(by_bin).alias("_after"))
    inside = Window.partitionBy(*keys, "_bin").orderBy(ts)
    return binned.join(around, [*keys, "_bin"]).withColumns({
        "before": F.coalesce(F.lag(row).over(inside), F.col("_before")),
        "after": F.coalesce(F.lead(row).over(inside), F.col("_after")),
    }).drop("_bin", "_before", "_after")


def geofence_events(placed: DataFrame, zone: str = "port_name", vessel: str = "MMSI",
                    ts: str = "BaseDateTime", silence_seconds: int = SILENCE_SECONDS,
                    known_until=None) -> DataFrame:
    """(vessel, zone, event_type, event_time) from positions with their zones (see zone_of_each).

    A vessel that is not heard of again leaves a zone when its silence ends by `known_until`, a
    timestamp column; without it such exits are left open.
    """
    visited = placed.groupBy(vessel, ts).agg(F.collect_set(zone).alias("_zones"))
    silence = F.expr(f"interval {int(silence_seconds)} seconds")
    rows = with_neighbours(visited, [vessel], ts, "_zones")
    inside = rows.select(vessel, F.col(ts).alias("_at"), "before", "after",
                         F.explode("_zones").alias(zone))

    def there(side: str):
        return F.coalesce(F.array_contains(F.col(f"{side}.value"), F.col(zone)), F.lit(False))

    stays = there("before") & (F.col("_at") <= F.col("before.ts") + silence)
    silent_until = F.col("_at") + silence
    heard = F.col("after.ts") <= silent_until
    gone = F.when(heard, F.when(~there("after"), F.col("after.ts"))).when(
        F.col("after.ts").isNotNull() | (
            F.lit(False) if known_until is None
            else F.coalesce(silent_until <= known_until, F.lit(False))), silent_until)
    events = F.array_compact(F.array(
        F.struct(F.when(stays, "INSIDE").otherwise("ENTER").alias("event_type"),
                 F.col("_at").alias("event_time")),
        F.when(gone.isNotNull(), F.struct(F.lit("EXIT").alias("event_type"),
                                          gone.alias("event_time")))))
    return inside.select(vessel, zone, F.inline(events))
