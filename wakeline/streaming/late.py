"""De-duplication that keeps late rows as data instead of dropping them.

Spark's watermark drops a late row inside the operator. Here the newest time of each vessel is kept
in state, so a row that comes too late for the stored keys is marked and leaves by the same
micro-batch as the others. What is on time is unique by vessel and time.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import timedelta

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from wakeline.session import ship_package

LATE = "_late"
BUCKET = "_bucket"
#: Groups the vessels are dealt over; a checkpoint holds its states by them.
BUCKETS = 1024


class LateAwareDeduplicator(StatefulProcessor):
    """State of a vessel: its newest time in earlier micro-batches, and the times seen since then.

    A row at or before the newest time less the delay is late; times that old are forgotten. Rows of
    one micro-batch do not make each other late, whatever their order. A call takes the vessels of a
    bucket together, as a call for each costs far more than its few rows; only the states of vessels
    that have rows are read and written.
    """

    def __init__(self, delay: timedelta, vessel: str, ts: str, order: tuple[str, ...]):
        self.delay, self.vessel, self.ts = delay // timedelta(microseconds=1), vessel, ts
        self.order = list(order)

    def init(self, handle: StatefulProcessorHandle) -> None:
        # One value: a state call costs more than the few times of the delay's span.
        self.known = handle.getMapState(
            "known", "vessel string", "newest_us bigint, seen_us array<bigint>")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        found = pd.concat(list(rows), ignore_index=True).drop(columns=BUCKET, errors="ignore").sort_values(
            [self.vessel, self.ts, *self.order], kind="stable")
        at = found[self.ts].to_numpy().astype("datetime64[us]").astype(np.int64)
        codes, vessels = pd.factorize(found[self.vessel], use_na_sentinel=False)
        bounds = [0, *(np.flatnonzero(np.diff(codes)) + 1).tolist(), len(at)]
        late, kept = np.zeros(len(at), bool), np.zeros(len(at), bool)
        for vessel, start, end in zip(vessels, bounds, bounds[1:]):
            late[start:end], kept[start:end] = self._settle(str(vessel), at[start:end])
        found[LATE] = late
        yield found[kept]

    def _settle(self, vessel: str, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which rows of a vessel, in order of time, are late and which are kept."""
        newest, seen = self.known.getValue((vessel,)) or (None, [])
        late = np.zeros(len(at), bool) if newest is None else at <= newest - self.delay
        first = np.append(True, at[1:] != at[:-1])
        fresh = ~late & first & ~np.isin(at, np.array(seen, np.int64))
        now = int(at[-1]) if newest is None else max(newest, int(at[-1]))
        kept = [t for t in [*seen, *at[fresh].tolist()] if t > now - self.delay]
        self.known.updateValue((vessel,), (now, kept))
        return late, late | fresh

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        return iter(())

    def close(self) -> None:
        pass


def mark_late(clean: DataFrame, delay: timedelta, vessel: str = "MMSI", ts: str = "BaseDateTime",
              order: tuple[str, ...] = ()) -> DataFrame:
    """The rows of a stream that are on time, once each, and all late ones, marked in `_late`."""
    ship_package(clean.sparkSession)
    kinds = T.StructType([*clean.schema.fields, T.StructField(LATE, T.BooleanType())])
    dealt = clean.withColumn(BUCKET, F.pmod(F.xxhash64(vessel), F.lit(BUCKETS)))
    return dealt.groupBy(BUCKET).transformWithStateInPandas(
        statefulProcessor=LateAwareDeduplicator(delay, vessel, ts, order), outputStructType=kinds,
        outputMode="Append", timeMode="None")
