"""Checks of the streaming job on a file-replayed topic, drained with availableNow."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from wakeline_checks import views
from wakeline_checks.registry import oracle, query, run_job
from wakeline.operators.latest import latest_by_key
from wakeline.schema import RAW_FIELDS, REJECT_SCHEMA
from wakeline.session import STREAMING_CONF, shared_dir
from wakeline.sources import archive, files, messages
from wakeline.streaming.pipeline import (
    StreamPaths,
    default_sinks,
    fleet_state,
    message_files,
    run_pipeline,
)
from wakeline.streaming.positions import running_totals, tumbling_counts

# Files of a replay arrive in any order of event time, so nothing may count as late.
_REPLAY_WATERMARK = "400 days"
_FILES = 3
# Messages a file of a replay holds, about; a larger table has more files, not larger ones.
_FILE_MESSAGES = 50_000


def file_groups(rows: int, groups: int = 1) -> int:
    """Files in each of several equal groups that hold these rows together."""
    return max(1, -(-rows // (groups * _FILE_MESSAGES)))


def _topic(rows, folder: str, groups: int) -> int:
    """Write messages as equal groups of files; the number of files in a group.

    All columns deal them out: offsets may be null or repeat, which would gather in one file.
    """
    each = file_groups(rows.count(), groups)
    rows.repartition(groups * each, *rows.columns).write.parquet(folder)
    return each


def write_in_turn(spark, parts, folder: str) -> int:
    """Write tables one after the other, each as the same number of files, which is returned.

    A stream that takes so many files at a time then reads one table a micro-batch. Empty files
    fill up what a table lacks.
    """
    each = max(file_groups(part.count()) for part in parts)
    for number, part in enumerate(parts, 1):
        spread = part.coalesce(1) if each == 1 else part.repartition(each)
        spread.write.mode("append").parquet(folder)
        stored = sum(name.endswith(".parquet") for name in files.children(spark, folder))
        for _ in range(number * each - stored):
            spark.createDataFrame([], part.schema).coalesce(1).write.mode("append").parquet(folder)
    return each


def own_session(spark):
    """A session of its own for stream settings, so that later queries keep theirs."""
    own = spark.newSession()
    for key in ("spark.sql.shuffle.partitions", "spark.sql.session.timeZone"):
        own.conf.set(key, spark.conf.get(key))
    for key, value in STREAMING_CONF.items():
        own.conf.set(key, value)
    return own


def _replayed(spark, sf_dir) -> StreamPaths:
    """Drain the whole topic through the three queries and their sinks."""
    own = own_session(spark)
    base = shared_dir(spark, "stream")
    each = _topic(views.messages(own, sf_dir), f"{base}/topic", _FILES)
    paths = StreamPaths(base)
    topic = message_files(own, f"{base}/topic", max_files=2 * each)
    run_pipeline(topic, paths, default_sinks(own, paths), watermark=_REPLAY_WATERMARK)
    return paths


# A stream keeps any of the equal copies of a message, so the offset alone may differ.
_PAYLOAD = [name for name in RAW_FIELDS if name != "BaseDateTime"]
_UNIQUE = (
    "SELECT CAST(BaseDateTime AS VARCHAR) AS BaseDateTime, " + ", ".join(_PAYLOAD)
    + ", CAST(CAST(BaseDateTime AS DATE) AS VARCHAR) AS date FROM unique_rows"
)


@query("x2_stream_dedup_archive", oracle(_UNIQUE, "unique_rows"))
def stream_archive(spark, sf_dir):
    """Unique positions in the archive after de-duplication across micro-batches."""
    paths = _replayed(spark, sf_dir)
    return archive.read_archive(spark, paths.archive).select("BaseDateTime", *_PAYLOAD, "date")


@query("e1_backfill_out_of_order", oracle(
    _UNIQUE.replace("SELECT ", "SELECT kafka_offset, ", 1), "unique_rows"))
def backfill_out_of_order(spark, sf_dir):
    """The stream job with its default options over files of days in reverse order, run twice."""
    base = shared_dir(spark, "backfill")
    rows = views.messages(spark, sf_dir)
    newest_first = rows.repartitionByRange(
        4 * file_groups(rows.count(), 4), F.col("timestamp").desc())
    newest_first.write.parquet(f"{base}/topic")
    for _ in range(2):
        run_job(spark, "stream", "--base", base, "--topic-files", f"{base}/topic")
    return archive.read_archive(spark, f"{base}/archive").select(
        "kafka_offset", "BaseDateTime", *_PAYLOAD, "date")


def _backfilled_then_drained(spark, sf_dir) -> StreamPaths:
    """A backfill of a topic, and a stream that then reads the same topic from its start."""
    own = own_session(spark)
    base = shared_dir(spark, "resumed")
    each = _topic(views.messages(own, sf_dir), f"{base}/topic", 4)
    run_job(own, "stream", "--base", base, "--topic-files", f"{base}/topic")
    paths = StreamPaths(base)
    topic = message_files(own, f"{base}/topic", max_files=each)
    run_pipeline(topic, paths, default_sinks(own, paths), watermark=_REPLAY_WATERMARK)
    return paths


@query("e1_backfill_then_stream", oracle(_UNIQUE, "unique_rows"))
def backfill_then_stream(spark, sf_dir):
    """Each position once, though a backfill and a stream of several batches read all of them."""
    paths = _backfilled_then_drained(spark, sf_dir)
    return archive.read_archive(spark, paths.archive).select("BaseDateTime", *_PAYLOAD, "date")


@query("e1_alerts_after_backfill", oracle(
    "SELECT MMSI AS mmsi, CAST(BaseDateTime AS VARCHAR) AS detected_at, SOG AS sog_knots"
    " FROM unique_rows WHERE SOG > 20", "unique_rows"))
def alerts_after_backfill(spark, sf_dir):
    paths = _backfilled_then_drained(spark, sf_dir)
    return archive.read_archive(spark, paths.alerts).select("mmsi", "detected_at", "sog_knots")


_LATE = "10 minutes"


def _by_hour(spark, sf_dir, own) -> tuple[str, int]:
    """A topic of three parts: the newer half of the time in two, then the older half.

    Each part is one file of a small table; returned is the number of files. A micro-batch takes one
    part and drops what lies behind the watermark that was known one batch earlier, so the first
    part's newest position decides over the third.
    """
    base = shared_dir(spark, "late")
    rows = views.messages(own, sf_dir)
    bounds = rows.agg(F.min("timestamp").alias("a"), F.max("timestamp").alias("b")).first()
    middle = bounds["a"] + (bounds["b"] - bounds["a"]) / 2
    newer = F.col("timestamp") >= middle
    first = F.floor(F.col("offset") / 2) % 2 == 0
    parts = [rows.filter(part) for part in (newer & first, newer & ~first, ~newer)]
    return base, write_in_turn(own, parts, f"{base}/topic")


def _drained_late(spark, sf_dir) -> StreamPaths:
    own = own_session(spark)
    base, each = _by_hour(spark, sf_dir, own)
    paths = StreamPaths(base)
    topic = message_files(own, f"{base}/topic", max_files=each)
    run_pipeline(topic, paths, default_sinks(own, paths), watermark=_LATE)
    return paths


# Newer half first: of the older half only what lies within the watermark is kept.
_HALVES = (
    "halves AS (SELECT *, kafka_timestamp >= (SELECT min(kafka_timestamp)"
    " + (max(kafka_timestamp) - min(kafka_timestamp)) / 2 FROM raw) AS newer FROM accepted),"
    " latest AS (SELECT max(BaseDateTime) - INTERVAL 10 MINUTE AS bound FROM halves WHERE newer"
    " AND floor(kafka_offset / 2) % 2 = 0)"
)


def _late_oracle(select: str) -> str:
    return oracle("SELECT 1", "accepted").removesuffix(" SELECT 1") + f", {_HALVES} {select}"


@query("x1_watermark", _late_oracle(
    "SELECT DISTINCT MMSI, CAST(BaseDateTime AS VARCHAR) AS BaseDateTime FROM halves, latest"
    " WHERE newer OR BaseDateTime > bound"))
def watermark(spark, sf_dir):
    """Newer half first: rows of the older half behind the watermark are dropped."""
    paths = _drained_late(spark, sf_dir)
    return archive.read_archive(spark, paths.archive).select("MMSI", "BaseDateTime")


@query("x3_late_rows", _late_oracle(
    "SELECT 'positions' AS query, count(*) AS late_rows FROM halves, latest"
    " WHERE NOT newer AND BaseDateTime <= bound"))
def late_rows(spark, sf_dir):
    """The dropped rows as the job reports them, copies included."""
    paths = _drained_late(spark, sf_dir)
    return spark.read.parquet(paths.late_rows).groupBy("query").agg(
        F.sum("late_rows").alias("late_rows"))


# Per vessel: late is what lies 10 minutes behind its newest position of earlier files.
_KEPT_LATE = (
    "files AS (SELECT *, CASE WHEN NOT newer THEN 3 WHEN floor(kafka_offset / 2) % 2 = 0 THEN 1"
    " ELSE 2 END AS file FROM halves),"
    " known AS (SELECT *, max(BaseDateTime) OVER (PARTITION BY MMSI ORDER BY file RANGE BETWEEN"
    " UNBOUNDED PRECEDING AND 1 PRECEDING) AS newest FROM files)"
    " SELECT MMSI, CAST(BaseDateTime AS VARCHAR) AS BaseDateTime, bool_and(coalesce("
    "BaseDateTime <= newest - INTERVAL 10 MINUTE, false)) AS late FROM known GROUP BY ALL"
)


@query("x3_late_rows_kept", _late_oracle("").rstrip() + ", " + _KEPT_LATE)
def late_rows_kept(spark, sf_dir):
    """Archive and late table together: every position once, none dropped."""
    own = own_session(spark)
    base, each = _by_hour(spark, sf_dir, own)
    paths = StreamPaths(base)
    topic = message_files(own, f"{base}/topic", max_files=each)
    run_pipeline(topic, paths, default_sinks(own, paths), keep_late=timedelta(minutes=10))
    stored = [(archive.read_archive(spark, folder), late) for folder, late in (
        (paths.archive, False), (paths.late_positions, True))]
    on_time, late = (rows.select("MMSI", "BaseDateTime", F.lit(mark).alias("late"))
                     for rows, mark in stored)
    return on_time.unionAll(late)


_STATE_TEXTS = ("mmsi", "vessel_name", "lat", "lon", "sog_knots", "cog_degrees",
                "heading_degrees", "nav_status")


@query("x7_stream_latest_state", oracle(
    f"SELECT {', '.join(_STATE_TEXTS)}, CAST(event_ts AS VARCHAR) AS event_ts FROM state",
    "state"))
def stream_state(spark, sf_dir):
    paths = _replayed(spark, sf_dir)
    return fleet_state(spark, paths.fleet_state).select(*_STATE_TEXTS, "event_ts")


@query("x8_stream_alerts", oracle(
    "SELECT MMSI AS mmsi, CAST(BaseDateTime AS VARCHAR) AS detected_at, VesselName AS vessel_name,"
    " SOG AS sog_knots, LAT AS lat, LON AS lon, CAST(Status AS VARCHAR) AS nav_status,"
    " 'SPEED_VIOLATION' AS alert_type, 20.0e0 AS threshold_knots FROM unique_rows"
    " WHERE SOG > 20", "unique_rows"))
def stream_alerts(spark, sf_dir):
    paths = _replayed(spark, sf_dir)
    return archive.read_archive(spark, paths.alerts).drop("alert_date")


@query("s8_audit_markers", "SELECT 2 AS markers, count(DISTINCT CAST(ts AS DATE)) > 0 AS has_days"
       " FROM events")
def audit_markers(spark, sf_dir):
    """One marker per micro-batch of the replay; three groups of files at two a batch make two."""
    paths = _replayed(spark, sf_dir)
    markers = spark.read.json(f"{paths.archive}/_batch_markers").distinct()
    days = archive.read_archive(spark, paths.archive).select("date").distinct()
    return markers.agg(F.count("*").cast("int").alias("markers")).crossJoin(
        days.agg((F.count("*") > 0).alias("has_days")))


@query("x9_bounded_batches", "SELECT 2 AS batches, count(*) > 0 AS bounded FROM events")
def bounded_batches(spark, sf_dir):
    """No micro-batch takes more files than allowed."""
    own = own_session(spark)
    base = shared_dir(spark, "bounded")
    each = _topic(views.messages(own, sf_dir), f"{base}/topic", _FILES)
    query_ = (
        message_files(own, f"{base}/topic", max_files=2 * each).writeStream.format("parquet")
        .option("path", f"{base}/copy").option("checkpointLocation", f"{base}/checkpoint")
        .trigger(availableNow=True).start())
    query_.awaitTermination()
    batches = [p for p in query_.recentProgress if p.numInputRows]
    assert messages.topic_options("h", "t", True, 5)["maxOffsetsPerTrigger"] == "5"
    return spark.createDataFrame([(len(batches), len(batches) == 2)],
                                 "batches int, bounded boolean")


@query("x6_stream_side_outputs", oracle(
    "SELECT outcome, CASE WHEN outcome <> 'dead_letter' THEN trim(raw_MMSI) END AS MMSI,"
    " count(*) AS row_count FROM tagged"
    " WHERE outcome NOT IN ('clean', 'header') GROUP BY ALL", "tagged"))
def stream_side_outputs(spark, sf_dir):
    """Rejects by reason and dead letters, duplicates of bad rows included."""
    paths = _replayed(spark, sf_dir)
    rejected = spark.read.schema(REJECT_SCHEMA).parquet(paths.rejects)
    lost = spark.read.parquet(paths.dead_letters)
    return rejected.select(F.col("reject_reason").alias("outcome"), "MMSI").unionAll(
        lost.select(F.lit("dead_letter").alias("outcome"), "MMSI")
    ).groupBy("outcome", "MMSI").agg(F.count("*").alias("row_count"))


def _event_stream(spark, sf_dir):
    events = views.table(spark, sf_dir, "events")
    folder = shared_dir(spark, "events")
    events.select(
        F.col("ts").cast("timestamp").alias("rowtime"), F.col("event_type").alias("url")
    ).repartition(2, "rowtime").write.parquet(folder)
    return spark.readStream.schema("rowtime TIMESTAMP, url STRING").option(
        "maxFilesPerTrigger", 1
    ).parquet(folder)


def drain(spark, df, mode: str, folder: str) -> None:
    """Run a stream to the end of its input; each micro-batch adds its rows to a table."""
    def add(batch, batch_id: int) -> None:
        batch.withColumn("batch_id", F.lit(batch_id)).write.mode("append").parquet(
            f"{folder}/table")

    df.writeStream.outputMode(mode).foreachBatch(add).option(
        "checkpointLocation", f"{folder}/checkpoint"
    ).trigger(availableNow=True).start().awaitTermination()


@query("t4_running_totals",
       "SELECT event_type AS url, count(*) AS pv, CAST(max(ts) AS VARCHAR) AS last_time"
       " FROM events GROUP BY event_type")
def totals(spark, sf_dir):
    """Running count and newest time per key of a stream: the last change of every key."""
    own, folder = own_session(spark), shared_dir(spark, "totals")
    drain(own, running_totals(_event_stream(own, sf_dir), "rowtime", "url"), "update", folder)
    changes = spark.read.parquet(f"{folder}/table")
    return latest_by_key(changes, ["url"], "batch_id").drop("batch_id")


_TUMBLING = (
    "SELECT CAST(make_timestamp(CAST(floor(epoch(ts) / 5) AS BIGINT) * 5000000) AS VARCHAR)"
    " AS start_time, event_type AS url, count(*) AS pv FROM events GROUP BY ALL"
)


@query("t5_tumbling_counts", _TUMBLING)
def tumbling(spark, sf_dir):
    events = views.table(spark, sf_dir, "events").select(
        F.col("ts").cast("timestamp").alias("rowtime"), F.col("event_type").alias("url")
    )
    return tumbling_counts(events, "rowtime", "url", 5)


@query("t5_tumbling_counts_streamed", _TUMBLING)
def tumbling_streamed(spark, sf_dir):
    """The same windows of a stream with a watermark, by their last change."""
    own, folder = own_session(spark), shared_dir(spark, "tumbling")
    counts = tumbling_counts(_event_stream(own, sf_dir), "rowtime", "url", 5, _REPLAY_WATERMARK)
    drain(own, counts, "update", folder)
    changes = spark.read.parquet(f"{folder}/table")
    return latest_by_key(changes, ["start_time", "url"], "batch_id").drop("batch_id")
