"""Zone events of a stream, with keyed state and event-time timers."""

from __future__ import annotations

from collections.abc import Iterator
from datetime import timedelta

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from wakeline.operators.geofence import SILENCE_SECONDS
from wakeline.schema import WATERMARK
from wakeline.session import ship_package


class GeofenceProcessor(StatefulProcessor):
    """State of a vessel: the zones it is in and when it was last heard of there, in microseconds.

    A vessel has one timer, for the end of the silence after its last position in a zone. Positions
    that are not newer than the newest one seen are late and change nothing.
    """

    def __init__(self, silence_seconds: int):
        self.silence = silence_seconds * 1_000_000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.zones = handle.getMapState("zones", "zone string", "last_us bigint")
        self.newest = handle.getValueState("newest", "last_us bigint")
        self.timer = handle.getValueState("timer", "at_ms bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        there: dict[int, set[str]] = {}
        for part in rows:
            for at, zone in zip(part["at_us"].tolist(), part["zone"].tolist()):
                found = there.setdefault(at, set())
                if isinstance(zone, str):
                    found.add(zone)
        state = {zone[0]: last[0] for zone, last in self.zones.iterator()}
        known = dict(state)
        newest = self.newest.get()[0] if self.newest.exists() else None
        events: list[tuple[str, str, int]] = []
        for at in sorted(there):
            if newest is not None and at <= newest:
                continue
            newest = at
            for zone, last in list(state.items()):
                if at > last + self.silence:
                    events.append((zone, "EXIT", last + self.silence))
                    del state[zone]
                elif zone not in there[at]:
                    events.append((zone, "EXIT", at))
                    del state[zone]
            for zone in there[at]:
                events.append((zone, "INSIDE" if zone in state else "ENTER", at))
                state[zone] = at
        if newest is not None:
            self.newest.update((newest,))
        self._keep(known, state)
        yield self._table(key, events)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = expiredTimerInfo.getExpiryTimeInMs() * 1000
        known = {zone[0]: last[0] for zone, last in self.zones.iterator()}
        state = {zone: last for zone, last in known.items() if last + self.silence > now}
        self.timer.clear()
        self._keep(known, state)
        yield self._table(key, [(zone, "EXIT", last + self.silence)
                                for zone, last in known.items() if zone not in state])

    def _keep(self, known: dict[str, int], state: dict[str, int]) -> None:
        for zone in known.keys() - state.keys():
            self.zones.removeKey((zone,))
        for zone, last in state.items():
            if known.get(zone) != last:
                self.zones.updateValue((zone,), (last,))
        wanted = -(-(min(state.values()) + self.silence) // 1000) if state else None
        current = self.timer.get()[0] if self.timer.exists() else None
        if wanted == current:
            return
        if current is not None:
            self.handle.deleteTimer(current)
            self.timer.clear()
        if wanted is not None:
            self.handle.registerTimer(wanted)
            self.timer.update((wanted,))

    @staticmethod
    def _table(key, events: list[tuple[str, str, int]]) -> pd.DataFrame:
        zones, kinds, times = zip(*events) if events else ((), (), ())
        return pd.DataFrame({
            "vessel": pd.Series([key[0]] * len(events), dtype="int64"),
            "zone": pd.Series(zones, dtype="object"),
            "event_type": pd.Series(kinds, dtype="object"),
            "at_us": pd.Series(times, dtype="int64")})

    def close(self) -> None:
        pass


def stream_geofence_events(placed: DataFrame, zone: str = "port_name", vessel: str = "MMSI",
                           ts: str = "BaseDateTime", silence_seconds: int = SILENCE_SECONDS,
                           watermark: str = WATERMARK) -> DataFrame:
    """As operators.geofence.geofence_events, for a stream of positions with their zones.

    Exits by silence appear when the watermark has passed the end of the silence. Needs the RocksDB
    state store (session.STREAMING_CONF).
    """
    ship_package(placed.sparkSession)
    rows = placed.withWatermark(ts, watermark).select(
        F.col(vessel).cast("bigint").alias("vessel"), F.col(zone).alias("zone"),
        F.unix_micros(ts).alias("at_us"), F.col(ts).alias("event_at"))
    events = rows.groupBy("vessel").transformWithStateInPandas(
        statefulProcessor=GeofenceProcessor(silence_seconds),
        outputStructType="vessel bigint, zone string, event_type string, at_us bigint",
        outputMode="Append", timeMode="EventTime")
    return events.select(F.col("vessel").alias(vessel), F.col("zone").alias(zone), "event_type",
                         F.timestamp_micros("at_us").alias("event_time"))


def final_watermark(positions: DataFrame, ts: str, watermark: timedelta):
    """The watermark a stream ends with that has read all of these positions, as a column."""
    newest = positions.agg(F.max(ts).alias("t")).first()["t"]
    return F.lit(None if newest is None else newest - watermark).cast("timestamp")
