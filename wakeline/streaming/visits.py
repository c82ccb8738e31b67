"""Port visits of a stream: session windows that leave when the watermark has passed them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wakeline.schema import SESSION_GAP_SECONDS, WATERMARK


def stream_port_visits(inside: DataFrame, keys: tuple[str, ...] = ("MMSI", "port_id"),
                       ts: str = "BaseDateTime", gap_seconds: int = SESSION_GAP_SECONDS,
                       watermark: str = WATERMARK) -> DataFrame:
    """(keys, entry_ts, exit_ts, ping_count, dwell_minutes) of every finished visit, in append mode.

    A visit ends when the watermark is a gap past its last position; what is then still open comes
    with a later micro-batch. The rows of a visit are merged into one state row each time.
    """
    sessions = inside.withWatermark(ts, watermark).groupBy(
        *keys, F.session_window(ts, f"{int(gap_seconds)} seconds").alias("_session")).agg(
        F.min(ts).alias("entry_ts"), F.max(ts).alias("exit_ts"), F.count("*").alias("ping_count"))
    dwell = (F.unix_timestamp("exit_ts") - F.unix_timestamp("entry_ts")) / 60.0
    return sessions.select(*keys, "entry_ts", "exit_ts", "ping_count",
                           F.round(dwell, 2).alias("dwell_minutes"))
