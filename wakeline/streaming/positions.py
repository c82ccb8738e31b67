"""The cleaning rules on a message stream: same columns and outcomes as the batch form."""

from __future__ import annotations

import json
import logging
from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from wakeline.operators import clean
from wakeline.operators.clean import CleanResult
from wakeline.operators.dedup import drop_duplicates
from wakeline.schema import MESSAGE_METADATA, RAW_FIELDS, WATERMARK
from wakeline.sources.messages import parse_messages
from wakeline.streaming.late import LATE, mark_late

log = logging.getLogger("wakeline.streaming")

DUPLICATE_KEY = ("MMSI", "BaseDateTime")
FIRST_MESSAGE = ("kafka_timestamp", "kafka_partition", "kafka_offset")
LATE_ROWS_SCHEMA = "query string, run string, batch_id bigint, late_rows bigint"


def _archived_columns(df: DataFrame) -> DataFrame:
    parts = ("speed_kmh", "year", "month", "day", "hour", "day_of_week", "quarter", "date")
    marks = [LATE] if LATE in df.columns else []
    return df.select(*MESSAGE_METADATA, *RAW_FIELDS, *parts, *marks)


def clean_stream(messages: DataFrame, watermark: str = WATERMARK,
                 keep_late: timedelta | None = None) -> CleanResult:
    """Branches of a message stream; only the clean branch keeps state.

    The event time is part of the duplicate key, so the watermark can drop old keys from the
    state. Rejects and dead letters leave before that, with their duplicates. With `keep_late` the
    clean branch holds late rows as well, marked: those that are this much older than the newest
    position of their vessel.
    """
    parsed = parse_messages(messages)
    result = clean.clean_positions(parsed)
    if keep_late is None:
        unique = result.clean.withWatermark("BaseDateTime", watermark).dropDuplicates(
            list(DUPLICATE_KEY)
        )
    else:
        unique = mark_late(result.clean, keep_late, order=FIRST_MESSAGE)
    # Each branch is a query that parses every message; these two type few of them.
    return CleanResult(
        result.tagged, _archived_columns(clean.add_time_parts(unique)),
        clean.parsed_rejects(parsed), clean.parsed_dead_letters(parsed),
    )


def clean_batch(messages: DataFrame,
                stage: Callable[[DataFrame], DataFrame] | None = None) -> CleanResult:
    """The same branches for a bounded set of messages, in any order of time.

    No watermark, hence no late rows: the right choice for replaying days out of order. Of
    several rows with the same vessel and time the earliest message stays.
    """
    result = clean.clean_positions(parse_messages(messages), stage)
    unique = drop_duplicates(
        result.clean, DUPLICATE_KEY, FIRST_MESSAGE
    )
    return CleanResult(
        result.tagged, _archived_columns(clean.add_time_parts(unique)), result.rejects,
        result.dead_letters,
    )


def late_rows(progress: dict) -> int:
    """Rows a micro-batch dropped behind the watermark, from its progress report."""
    return sum(op.get("numRowsDroppedByWatermark", 0) for op in progress.get("stateOperators", []))


class LateRowLog(StreamingQueryListener):
    """Writes how many rows each micro-batch dropped behind the watermark, where any were."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        dropped = late_rows(json.loads(progress.json))
        if dropped:
            log.warning("%s: %d late rows in batch %d", progress.name, dropped, progress.batchId)
            self.spark.createDataFrame(
                [(progress.name, str(progress.runId), progress.batchId, dropped)], LATE_ROWS_SCHEMA
            ).coalesce(1).write.mode("append").parquet(self.path)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def running_totals(events: DataFrame, ts: str, key: str) -> DataFrame:
    """Count and newest time per key so far; as a stream, in update mode, the changed keys."""
    return events.groupBy(key).agg(F.count("*").alias("pv"), F.max(ts).alias("last_time"))


def tumbling_counts(events: DataFrame, ts: str, key: str, seconds: int = 5,
                    watermark: str | None = None) -> DataFrame:
    """Tumbling-window count per key, for streams (with a watermark) and for batches."""
    timed = events if watermark is None else events.withWatermark(ts, watermark)
    return (
        timed.groupBy(F.window(ts, f"{int(seconds)} seconds").alias("_w"), key)
        .agg(F.count("*").alias("pv"))
        .select(F.col("_w.start").alias("start_time"), key, "pv")
    )
