import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tests.helpers import messages, record, rows
from wakeline.__main__ import build_parser, run
from wakeline.schema import RAW_FIELDS
from wakeline.session import shared_dir
from wakeline.plans.daily import seed_ports
from wakeline.sources import archive, files
from wakeline.streaming import pipeline
from wakeline.streaming.positions import clean_batch, clean_stream, late_rows
from wakeline.streaming.sinks import fan_out

VALUES = [
    record(), record(), record(MMSI="366000002", SOG="25.5"),
    record(BaseDateTime="2024-12-25T10:05:00", SOG="21"), record(MMSI="1"), record(MMSI="1"),
    record(LAT="99"), "{", record(MMSI="MMSI"),
    record(MMSI="366000003", BaseDateTime="2024-12-26T00:00:00"),
]


def topic(spark, batches):
    """One file per batch, numbered so that the file source reads them in order."""
    folder = shared_dir(spark, "topic")
    for values in batches:
        messages(spark, values).coalesce(1).write.mode("append").parquet(folder)
    return folder


def replay(spark, batches, sinks=None, publish=None):
    paths = pipeline.StreamPaths(shared_dir(spark, "stream"))
    source = pipeline.message_files(spark, topic(spark, batches), max_files=1)
    chosen = sinks or pipeline.default_sinks(spark, paths, publish=publish)
    pipeline.run_pipeline(source, paths, chosen, watermark="30 days")
    return paths


def test_stream_equals_batch(spark):
    sent = []
    paths = replay(spark, [VALUES[:5], VALUES[5:]],
                   publish=lambda df: sent.extend(json.loads(r["value"]) for r in df.collect()))
    expected = clean_batch(messages(spark, VALUES))
    found = archive.read_archive(spark, paths.archive)
    assert rows(found.select(*RAW_FIELDS)) == rows(expected.clean.select(*RAW_FIELDS))
    rejected = spark.read.parquet(paths.rejects)
    assert rows(rejected.groupBy("reject_reason").count()) == [
        ("mmsi_invalid", 2), ("position_out_of_range", 1)
    ]
    assert spark.read.parquet(paths.dead_letters).count() == 1
    alerts = archive.read_archive(spark, paths.alerts)
    assert rows(alerts.select("mmsi", "sog_knots")) == [(366000001, 21.0), (366000002, 25.5)]
    assert sorted(a["mmsi"] for a in sent) == [366000001, 366000002]
    assert set(sent[0]) == {"mmsi", "vessel_name", "sog_knots", "lat", "lon", "base_date_time",
                            "nav_status", "alert_type", "threshold_knots", "detected_at"}
    state = pipeline.fleet_state(spark, paths.fleet_state)
    assert rows(state.select("mmsi", "event_ts")) == [
        (366000001, datetime(2024, 12, 25, 10, 5)), (366000002, datetime(2024, 12, 25, 10)),
        (366000003, datetime(2024, 12, 26)),
    ]


def test_repeated_batch_changes_nothing(spark):
    paths = pipeline.StreamPaths(shared_dir(spark, "stream"))
    handle = fan_out(pipeline.default_sinks(spark, paths))
    batch = clean_batch(messages(spark, VALUES)).clean
    handle(batch, 0)
    # Only after a restart can a batch come again.
    fan_out(pipeline.default_sinks(spark, paths))(batch, 0)
    assert archive.read_archive(spark, paths.archive).count() == batch.count()
    assert archive.read_archive(spark, paths.alerts).count() == 2


def test_second_run_with_a_fresh_checkpoint_loses_nothing(spark):
    first, second = VALUES[:5], VALUES[5:]
    base = shared_dir(spark, "stream")
    for number, values in enumerate((first, second)):
        paths = pipeline.StreamPaths(base)
        source = pipeline.message_files(spark, topic(spark, [values]), max_files=1)
        folder = f"{base}/checkpoints-{number}"
        checkpoints = type("Paths", (pipeline.StreamPaths,), {
            "checkpoint": lambda self, query, folder=folder: f"{folder}/{query}"})(base)
        query = pipeline.start_pipeline(
            source, checkpoints, pipeline.default_sinks(spark, paths), watermark="30 days")[0]
        query.awaitTermination()
    expected = clean_batch(messages(spark, VALUES)).clean
    found = archive.read_archive(spark, paths.archive)
    assert rows(found.select(*RAW_FIELDS)) == rows(expected.select(*RAW_FIELDS))
    pipeline.compact(spark, paths, "2024-12-25")
    assert archive.read_archive(spark, paths.archive).count() == expected.count()


def test_backfill_takes_days_in_any_order(spark):
    base = shared_dir(spark, "backfill")
    late_first = [record(BaseDateTime=f"2024-12-{d:02d}T10:00:00") for d in (31, 25, 28, 1)]
    folder = topic(spark, [[value] for value in late_first])
    for _ in range(2):
        run(spark, build_parser().parse_args(
            ["stream", "--base", base, "--topic-files", folder]))
    assert archive.read_archive(spark, f"{base}/archive").count() == 4
    assert pipeline.fleet_state(spark, f"{base}/active_fleet_state").first()["event_ts"] == (
        datetime(2024, 12, 31, 10))


def test_dropped_rows_are_written_down(spark):
    times = ["2024-12-31T10:00:00", "2024-12-31T10:00:05", "2024-12-25T10:00:00"]
    paths = pipeline.StreamPaths(shared_dir(spark, "late"))
    source = pipeline.message_files(
        spark, topic(spark, [[record(BaseDateTime=t)] for t in times]), max_files=1)
    pipeline.run_pipeline(source, paths, pipeline.default_sinks(spark, paths))
    found = spark.read.parquet(paths.late_rows).collect()
    assert [(r["query"], r["late_rows"]) for r in found] == [("positions", 1)]


def test_failing_sink_fails_the_query(spark):
    def broken(batch, batch_id):
        raise ValueError("sink is down")

    with pytest.raises(Exception, match="sink is down"):
        replay(spark, [VALUES], sinks=[broken])


def test_late_rows_are_counted(spark):
    times = ["2024-12-31T10:00:00", "2024-12-31T10:00:05", "2024-12-31T10:00:07",
             "2024-12-25T10:00:00"]
    source = pipeline.message_files(
        spark, topic(spark, [[record(BaseDateTime=t)] for t in times]), max_files=1)
    seen = []
    query = (
        clean_stream(source).clean.writeStream
        .foreachBatch(lambda df, _: seen.extend(r["BaseDateTime"] for r in df.collect()))
        .option("checkpointLocation", shared_dir(spark, "checkpoint"))
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    dropped = sum(late_rows(json.loads(p.json)) for p in query.recentProgress)
    assert dropped == 1
    assert len(seen) == 3 and datetime(2024, 12, 25, 10) not in seen


def test_triggers():
    assert pipeline.trigger("drain") == {"availableNow": True}
    assert pipeline.trigger("live", 2) == {"processingTime": "2 seconds"}
    with pytest.raises(ValueError):
        pipeline.trigger("sometimes")


def test_jobs_from_the_command_line(spark):
    base = shared_dir(spark, "jobs")
    before = set(files.children(spark, base.rsplit("/", 1)[0]))
    folder = topic(spark, [VALUES])
    parse = build_parser().parse_args
    run(spark, parse(["stream", "--base", base, "--topic-files", folder]))
    run(spark, parse(["history", "--results", f"{base}/history", "--topic-files", folder]))
    day = ["--archive", f"{base}/archive", "--results", f"{base}/results", "--exec-date",
           "2024-12-25"]
    run(spark, parse(["compact", "--base", base, "--exec-date", "2024-12-25"]))
    seed_ports(spark).write.parquet(f"{base}/ports")
    run(spark, parse(["kpis", *day, "--ports", f"{base}/ports"]))
    run(spark, parse(["visits", *day[:4], "--ports", f"{base}/ports"]))
    assert spark.read.parquet(f"{base}/results/port_visits").count() > 0
    run(spark, parse(["clusters", *day, "--models", f"{base}/models", "--k", "2"]))
    run(spark, parse(["day", *day, "--models", f"{base}/models"]))
    kpis = spark.read.parquet(f"{base}/results/fleet_daily_kpis")
    assert kpis.agg(F.sum("ping_count")).first()[0] == 3
    assert spark.read.parquet(f"{base}/history").count() == 4
    parent = shared_dir(spark, "x").rsplit("/", 1)[0]
    left = [n for n in files.children(spark, parent)
            if n.startswith(("wakeline-updates", "wakeline-unique", "wakeline-vessel",
                             "wakeline-backfill", "wakeline-compact"))]
    assert not [n for n in left if n not in before]


def test_stream_after_backfill_adds_only_what_is_new(spark):
    """Several batches, a day of the backfill and a later one, also with another checkpoint."""
    base = shared_dir(spark, "stream")
    folder = topic(spark, [VALUES[:4], VALUES[4:]])
    run(spark, build_parser().parse_args(
        ["stream", "--base", base, "--topic-files", folder]))
    before = rows(archive.read_archive(spark, f"{base}/archive").select(*RAW_FIELDS))
    new = [record(MMSI="366000009"), record(BaseDateTime="2024-12-27T00:00:00", SOG="30")]
    for values in ([new[0]], [VALUES[0], new[1]], [new[1], VALUES[3]]):
        messages(spark, values).coalesce(1).write.mode("append").parquet(folder)
    paths = pipeline.StreamPaths(base)
    for number in range(2):
        source = pipeline.message_files(spark, folder, max_files=1)
        again = pipeline.StreamPaths(base)
        sinks = pipeline.default_sinks(spark, paths)
        object.__setattr__(again, "checkpoint", lambda query: f"{base}/checkpoints{number}/{query}")
        pipeline.run_pipeline(source, again, sinks, watermark="30 days")
    found = archive.read_archive(spark, paths.archive).select(*RAW_FIELDS)
    expected = clean_batch(messages(spark, new)).clean.select(*RAW_FIELDS)
    assert rows(found) == sorted(before + rows(expected))
    alerts = archive.read_archive(spark, paths.alerts)
    assert rows(alerts.select("mmsi", "sog_knots")) == [
        (366000001, 21.0), (366000001, 30.0), (366000002, 25.5)]


def test_backfill_uses_its_alert_and_database_options(spark, monkeypatch):
    from wakeline.sources import jdbc, messages as topics

    sent, upserts = [], []
    monkeypatch.setattr(topics, "write_topic", lambda df, servers, topic: sent.extend(
        (servers, topic, json.loads(r["value"])["mmsi"]) for r in df.collect()))
    monkeypatch.setattr(jdbc, "upsert_via_staging", lambda df, target, table, *_, **__: upserts.append(
        (target.url, table, df.count())))
    run(spark, build_parser().parse_args([
        "stream", "--base", shared_dir(spark, "stream"), "--topic-files", topic(spark, [VALUES]),
        "--servers", "host:1", "--alert-topic", "alerts", "--jdbc-url", "jdbc:x"]))
    assert sorted(sent) == [("host:1", "alerts", 366000001), ("host:1", "alerts", 366000002)]
    assert upserts == [("jdbc:x", "active_fleet_state", 3), ("jdbc:x", "vessel_speed_alerts", 2)]
    with pytest.raises(SystemExit):
        run(spark, build_parser().parse_args([
            "stream", "--base", "x", "--topic-files", "y", "--alert-topic", "alerts"]))


def test_a_larger_replay_has_more_files_and_as_many_batches(spark, monkeypatch):
    from wakeline_checks import streams

    monkeypatch.setattr(streams, "_FILE_MESSAGES", 2)
    folder, own, seen = shared_dir(spark, "turns"), streams.own_session(spark), []
    whole = messages(spark, [record(SOG=str(n)) for n in range(8)])
    each = streams.write_in_turn(own, [whole, whole.filter("false"), whole.limit(3)],
                                 f"{folder}/topic")
    stored = [n for n in files.children(spark, f"{folder}/topic") if n.endswith(".parquet")]
    assert each == 4 and len(stored) == 12
    pipeline.message_files(own, f"{folder}/topic", each).writeStream.foreachBatch(
        lambda batch, number: seen.append(batch.count())).option(
        "checkpointLocation", f"{folder}/checkpoint").trigger(
        availableNow=True).start().awaitTermination()
    assert [n for n in seen if n] == [8, 3]
    assert streams.file_groups(5) == 3 and streams.file_groups(7, 3) == 2
    assert streams.file_groups(0) == 1


@pytest.mark.parametrize("offset", ["null", "7", "offset"])
def test_files_of_a_topic_are_small_whatever_its_offsets(spark, monkeypatch, offset):
    from wakeline_checks import streams, views

    monkeypatch.setattr(streams, "_FILE_MESSAGES", 10)
    sent = messages(spark, [record(SOG=str(n)) for n in range(300)]).withColumn(
        "offset", F.expr(f"cast({offset} as long)"))
    folder = shared_dir(spark, "spread")
    assert streams._topic(sent, folder, 3) == 10
    stored = spark.read.parquet(folder)
    sizes = stored.groupBy(F.input_file_name()).count().toDF("file", "n")
    assert rows(stored.select(*sent.columns)) == rows(sent)
    assert sizes.count() > 20 and sizes.agg(F.max("n")).first()[0] <= 30

    monkeypatch.setattr(views, "messages", lambda spark, sf_dir: sent)
    assert rows(streams.bounded_batches(spark, "none")) == [(2, True)]


def test_batches_of_the_archive_are_cleaned_once(spark, monkeypatch):
    from wakeline_checks import tables, views

    plans = []
    monkeypatch.setattr(views, "messages", lambda spark, sf_dir: messages(spark, VALUES))
    monkeypatch.setattr(tables, "ArchiveSink", lambda folder: lambda batch, number: plans.append(
        batch._jdf.queryExecution().analyzed().toString()))
    tables._archived_batches(spark, "none")
    assert len(plans) == 5 and not any("from_json" in plan for plan in plans)


def test_late_rows_of_several_vessels_in_one_call():
    from datetime import timedelta

    import pandas as pd

    from wakeline.streaming.late import LATE, LateAwareDeduplicator

    class States(dict):
        getValue = dict.get

        def updateValue(self, key, value):
            self[key] = value

    kept = LateAwareDeduplicator(timedelta(minutes=10), "MMSI", "at", ("n",))
    kept.known = States()

    def call(*found):
        rows = pd.DataFrame([(m, pd.Timestamp(f"2024-01-01 {at}"), n) for m, at, n in found],
                            columns=["MMSI", "at", "n"])
        out = pd.concat(kept.handleInputRows((0,), iter([rows[:2], rows[2:]]), None))
        return sorted(zip(out["MMSI"], out["n"], out[LATE]))

    assert call((2, "08:00", 1), (1, "10:00", 3), (1, "10:00", 2), (1, "09:00", 4)) == [
        (1, 2, False), (1, 4, False), (2, 1, False)]
    assert call((1, "09:50", 5), (1, "09:51", 6), (2, "07:55", 7), (3, "01:00", 8),
                (1, "10:00", 9)) == [
        (1, 5, True), (1, 6, False), (2, 7, False), (3, 8, False)]
