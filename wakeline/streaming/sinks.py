"""Micro-batch sinks. Each one may see the same batch twice and then leaves the same result."""

from __future__ import annotations

import logging
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wakeline.functions import geo
from wakeline.operators.latest import latest_by_key
from wakeline.plans.kpi import alert_messages, speed_alerts
from wakeline.schema import ALERT_THRESHOLD_KNOTS, MAX_RECORDS_PER_FILE, TABLE_KEYS
from wakeline.sources import archive, jdbc
from wakeline.sources.jdbc import JdbcTarget
from wakeline.streaming.late import LATE
from wakeline.streaming.positions import DUPLICATE_KEY

log = logging.getLogger("wakeline.streaming")

BatchSink = Callable[[DataFrame, int], None]


def fleet_updates(batch: DataFrame, *by: str) -> DataFrame:
    """Newest position per vessel (and per value of `by`) in a batch, as rows of the state table."""
    placed = batch.filter(F.col("LAT").isNotNull() & F.col("LON").isNotNull())
    state = placed.select(
        F.col("MMSI").cast("bigint").alias("mmsi"),
        F.col("VesselName").alias("vessel_name"),
        F.col("LON").alias("lon"),
        F.col("LAT").alias("lat"),
        geo.point_wkt(F.col("LON"), F.col("LAT")).alias("geom_wkt"),
        F.col("SOG").alias("sog_knots"),
        F.col("COG").alias("cog_degrees"),
        F.col("Heading").alias("heading_degrees"),
        F.col("Status").cast("string").alias("nav_status"),
        F.col("BaseDateTime").alias("event_ts"),
        *by,
    )
    return latest_by_key(state, ["mmsi", *by], "event_ts").withColumn(
        "last_updated", F.current_timestamp()
    )


@dataclass
class FleetStateSink:
    """Appends the newest position of each vessel in a batch; reading takes the newest of all.

    Changes go to the folder of the day they are written on, so that snapshots can leave it behind.
    A late batch or a repeated one changes nothing, and no trigger rewrites the fleet.
    """

    path: str

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        changes = fleet_updates(batch).withColumn("written_on", F.current_date())
        archive.append_by_date(changes, self.path, "written_on")


@dataclass
class _Appended:
    """Rows added to date folders, once each.

    A run of the stream gives every key once. Stored rows that may hold a key of a batch are
    therefore those of an earlier run: a backfill, a stream with another checkpoint, or an attempt
    at the same batch. They lie in days that had a folder when the run started; rows of these days
    are compared with the stored keys, rows of later days are appended without a look.
    """

    path: str
    max_records: int = MAX_RECORDS_PER_FILE
    run: str = field(default_factory=lambda: uuid.uuid4().hex[:12])
    earlier: set[str] | None = None

    def store(self, rows: DataFrame, keys: Sequence[str], date_col: str) -> None:
        spark = rows.sparkSession
        if self.earlier is None:
            self.earlier = archive.stored_days(spark, self.path, date_col)
        if self.earlier:
            archive.append_new(rows, self.path, keys, date_col, self.max_records, self.earlier)
        else:
            archive.append_by_date(rows, self.path, date_col, self.max_records)


@dataclass
class AlertSink(_Appended):
    """Writes alert rows and optionally publishes messages (at least once)."""

    threshold: float = ALERT_THRESHOLD_KNOTS
    publish: Callable[[DataFrame], None] | None = None

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        # The clean branch is unique by vessel and time, which is the key of an alert.
        alerts = speed_alerts(batch, self.threshold).withColumn(
            "alert_date", F.to_date("detected_at")
        )
        self.store(alerts, TABLE_KEYS["vessel_speed_alerts"], "alert_date")
        if self.publish is not None:
            self.publish(alert_messages(batch, self.threshold))


@dataclass
class ArchiveSink(_Appended):
    """Adds the batch to the date-partitioned archive and leaves an audit marker."""

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        self.store(batch, DUPLICATE_KEY, "date")
        archive.write_marker(batch.sparkSession, self.path, batch_id, self.run)


@dataclass
class JdbcFleetStateSink:
    """Upserts the newest positions into a database table keyed by mmsi."""

    target: JdbcTarget
    table: str = "active_fleet_state"

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        updates = fleet_updates(batch)
        changed = [c for c in updates.columns if c != "mmsi"]
        jdbc.upsert_via_staging(
            updates, self.target, self.table, ["mmsi"], changed, f"batch{batch_id}",
            newer_by="event_ts",
        )


@dataclass
class JdbcAlertSink:
    """Upserts alert rows into a database table; a repeated batch finds its own rows."""

    target: JdbcTarget
    table: str = "vessel_speed_alerts"
    threshold: float = ALERT_THRESHOLD_KNOTS

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        alerts = speed_alerts(batch, self.threshold)
        keys = TABLE_KEYS["vessel_speed_alerts"]
        changed = [c for c in alerts.columns if c not in keys]
        jdbc.upsert_via_staging(
            alerts, self.target, self.table, keys, changed, f"batch{batch_id}"
        )


@dataclass
class LateSink:
    """Splits a marked batch: late rows go to a table of their own, the others to the sinks.

    A late row whose key is stored on time or late already is a copy and is left out.
    """

    sinks: list[BatchSink]
    path: str
    archive_path: str
    keys: tuple[str, ...]
    date_col: str = "date"

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        on_time = batch.filter(~F.col(LATE)).drop(LATE)
        for sink in self.sinks:
            sink(on_time, batch_id)
        late = batch.filter(LATE).drop(LATE).dropDuplicates(list(self.keys))
        if late.isEmpty():
            return
        days = [row[0] for row in late.select(self.date_col).distinct().collect()]
        stored = archive.read_archive(batch.sparkSession, self.archive_path, days, self.date_col)
        if stored is not None:
            late = late.join(stored.select(*self.keys), list(self.keys), "left_anti").select(
                *late.columns)
        archive.append_new(late, self.path, self.keys, self.date_col)


def fan_out(sinks: Sequence[BatchSink]) -> BatchSink:
    """One handler that feeds a batch to all sinks; the batch is computed once.

    A failing sink fails the batch, which the query then repeats from its checkpoint.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            if batch.isEmpty():
                return
            for sink in sinks:
                sink(batch, batch_id)
        except Exception:
            log.exception("batch %d failed", batch_id)
            raise
        finally:
            batch.unpersist()

    return handle
