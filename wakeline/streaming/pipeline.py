"""The three queries of the streaming job and their triggers."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import timedelta

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from wakeline.operators.clean import outcome_metrics
from wakeline.schema import (
    ALERT_THRESHOLD_KNOTS,
    FLEET_STATE_SCHEMA,
    LIVE_TRIGGER_SECONDS,
    MAX_RECORDS_PER_FILE,
    MESSAGE_SCHEMA,
    TABLE_KEYS,
    WATERMARK,
)
from wakeline.sources import archive, tables
from wakeline.streaming.positions import (
    DUPLICATE_KEY,
    FIRST_MESSAGE,
    LateRowLog,
    clean_batch,
    clean_stream,
)
from wakeline.streaming.sinks import (
    AlertSink,
    ArchiveSink,
    BatchSink,
    FleetStateSink,
    LateSink,
    fan_out,
)


@dataclass(frozen=True)
class StreamPaths:
    """Folders of a streaming job below one base."""

    base: str

    @property
    def archive(self) -> str:
        return f"{self.base}/archive"

    @property
    def fleet_state(self) -> str:
        return f"{self.base}/active_fleet_state"

    @property
    def alerts(self) -> str:
        return f"{self.base}/vessel_speed_alerts"

    @property
    def rejects(self) -> str:
        return f"{self.base}/rejected"

    @property
    def dead_letters(self) -> str:
        return f"{self.base}/rejected_json"

    @property
    def late_rows(self) -> str:
        return f"{self.base}/late_rows"

    @property
    def late_positions(self) -> str:
        return f"{self.base}/late_positions"

    def checkpoint(self, query: str) -> str:
        return f"{self.base}/checkpoints/{query}"


def trigger(mode: str, live_seconds: int = LIVE_TRIGGER_SECONDS) -> dict:
    """'drain' takes what is there, in order of time, and stops; 'live' runs at an interval."""
    if mode == "drain":
        return {"availableNow": True}
    if mode == "live":
        return {"processingTime": f"{int(live_seconds)} seconds"}
    raise ValueError(f"unknown run mode: {mode}")


def message_files(spark: SparkSession, path: str, max_files: int = 1) -> DataFrame:
    """A message stream replayed from Parquet files, a bounded number per micro-batch."""
    return spark.readStream.schema(MESSAGE_SCHEMA).option("maxFilesPerTrigger", max_files).parquet(
        path
    )


def fleet_state(spark: SparkSession, path: str) -> DataFrame:
    """The newest position of every vessel."""
    return tables.latest_state(spark, path, FLEET_STATE_SCHEMA, ["mmsi"], "event_ts")


def default_sinks(spark: SparkSession, paths: StreamPaths,
                  threshold: float = ALERT_THRESHOLD_KNOTS,
                  max_records: int = MAX_RECORDS_PER_FILE, publish=None) -> list[BatchSink]:
    """Latest state, speed alerts, archive: in this order, as one unit per micro-batch."""
    return [
        FleetStateSink(paths.fleet_state),
        AlertSink(paths.alerts, threshold=threshold, publish=publish),
        ArchiveSink(paths.archive, max_records),
    ]


def start_pipeline(messages: DataFrame, paths: StreamPaths, sinks: Sequence[BatchSink],
                   mode: str = "drain", watermark: str = WATERMARK,
                   live_seconds: int = LIVE_TRIGGER_SECONDS,
                   keep_late: timedelta | None = None) -> list[StreamingQuery]:
    """Start the main, reject and dead-letter queries, each with its own checkpoint.

    With `keep_late`, rows that are this late are stored in their own table (see clean_stream).

    Rejects and dead letters go through Spark's Parquet stream sink, which commits each file
    once, also when a batch is repeated.
    """
    branches = clean_stream(messages, watermark, keep_late)
    if keep_late is not None:
        sinks = [LateSink(list(sinks), paths.late_positions, paths.archive, DUPLICATE_KEY)]
    run = trigger(mode, live_seconds)
    main = (
        branches.clean.writeStream.queryName("positions").foreachBatch(fan_out(sinks))
        .option("checkpointLocation", paths.checkpoint("positions")).trigger(**run).start()
    )
    side = [
        df.writeStream.queryName(name).format("parquet").option("path", path)
        .option("checkpointLocation", paths.checkpoint(name)).trigger(**run).start()
        for name, df, path in (
            ("rejects", branches.rejects, paths.rejects),
            ("dead_letters", branches.dead_letters, paths.dead_letters),
        )
    ]
    return [main, *side]


def run_pipeline(messages: DataFrame, paths: StreamPaths, sinks: Sequence[BatchSink],
                 mode: str = "drain", watermark: str = WATERMARK,
                 live_seconds: int = LIVE_TRIGGER_SECONDS,
                 keep_late: timedelta | None = None) -> None:
    """Start the queries and wait for all of them; the first failure stops the others.

    Rows that arrive behind the watermark are dropped and their number is written beside the data;
    with `keep_late` none is dropped.
    """
    spark = messages.sparkSession
    late = LateRowLog(spark, paths.late_rows)
    spark.streams.addListener(late)
    queries = start_pipeline(messages, paths, sinks, mode, watermark, live_seconds, keep_late)
    try:
        for query in queries:
            query.awaitTermination()
    finally:
        for query in queries:
            if query.isActive:
                query.stop()
        # Progress events of the last batches are still on their way.
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
        spark.streams.removeListener(late)


def backfill(messages: DataFrame, paths: StreamPaths,
             threshold: float = ALERT_THRESHOLD_KNOTS,
             max_records: int = MAX_RECORDS_PER_FILE, publish=None,
             more_sinks: Sequence[BatchSink] = ()) -> dict[str, int]:
    """Clean a bounded set of messages in one batch, in any order of time, and lose none.

    Positions and alerts that are already stored are not added again; rejects and dead letters
    carry no key and are added with every run. Alerts are published, and further sinks fed, with
    all positions of the run. The messages are parsed once, as their tagged rows are written down;
    the count of each outcome is observed in that write and returned.
    """
    outcomes = Observation("outcomes")
    result = clean_batch(messages, lambda tagged: tables.materialize(
        tagged.observe(outcomes, *outcome_metrics()), "tagged"))
    # The stored dates must not be read while the same job appends to them.
    clean = tables.materialize(result.clean, "backfill")
    AlertSink(paths.alerts, max_records, threshold=threshold, publish=publish)(clean, 0)
    archive.append_new(clean, paths.archive, DUPLICATE_KEY, max_records=max_records)
    FleetStateSink(paths.fleet_state)(clean, 0)
    for sink in more_sinks:
        sink(clean, 0)
    result.rejects.write.mode("append").parquet(paths.rejects)
    result.dead_letters.write.mode("append").parquet(paths.dead_letters)
    return outcomes.get


def compact(spark: SparkSession, paths: StreamPaths, day: str) -> None:
    """Rewrite a day of archive and alerts as few files, each key once, and snapshot the state.

    The snapshot covers all changes that were written up to the day before yesterday.
    """
    archive.compact_day(spark, paths.archive, day, DUPLICATE_KEY, FIRST_MESSAGE)
    archive.compact_day(spark, paths.alerts, day, TABLE_KEYS["vessel_speed_alerts"],
                        date_col="alert_date")
    closed = spark.range(1).select(F.date_sub(F.current_date(), 2).cast("string").alias("d"))
    tables.snapshot_state(spark, paths.fleet_state, closed.first()["d"], FLEET_STATE_SCHEMA,
                          ["mmsi"], "event_ts")
