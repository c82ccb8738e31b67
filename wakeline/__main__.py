"""Command line of the jobs, for spark-submit:

    python -m wakeline stream   --base PATH (--topic-files PATH | --servers HOSTS --topic NAME)
    python -m wakeline compact  --base PATH --exec-date DAY
    python -m wakeline kpis     --archive PATH --results PATH --exec-date DAY [--ports PATH]
    python -m wakeline clusters --archive PATH --results PATH --models PATH --exec-date DAY
    python -m wakeline day      --archive PATH --results PATH --models PATH --exec-date DAY
    python -m wakeline visits   --archive PATH --results PATH [--ports PATH]
    python -m wakeline history  --topic-files PATH --results PATH
    python -m wakeline publish  --results PATH --exec-date DAY --jdbc-url URL

`stream --mode backfill` cleans everything that is there in one batch, in any order of time. `drain`
and `live` are streams: rows behind the watermark are dropped, and counted in BASE/late_rows.
"""

from __future__ import annotations

import argparse
import logging
import sys
from datetime import date, timedelta
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from wakeline import schema
from wakeline.plans import daily
from wakeline.plans.history import clean_history
from wakeline.session import build_session, remove_intermediates
from wakeline.sources import archive, jdbc, messages
from wakeline.streaming import pipeline
from wakeline.streaming.sinks import JdbcAlertSink, JdbcFleetStateSink


def build_parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="wakeline")
    jobs = parser.add_subparsers(dest="job", required=True)
    yesterday = (date.today() - timedelta(days=1)).isoformat()

    def add_topic(job: argparse.ArgumentParser) -> None:
        job.add_argument("--topic-files", help="Parquet folder that stands for the topic")
        job.add_argument("--servers", help="message brokers")
        job.add_argument("--topic", default="raw_ais_positions")

    def add_properties(job: argparse.ArgumentParser) -> None:
        job.add_argument("--jdbc-property", action="append", default=[], metavar="KEY=VALUE")

    stream = jobs.add_parser("stream", help="clean positions and feed the sinks")
    add_topic(stream)
    add_properties(stream)
    stream.add_argument("--base", required=True)
    stream.add_argument("--mode", choices=("backfill", "drain", "live"),
                        default="backfill")
    stream.add_argument("--alert-threshold", type=float, default=schema.ALERT_THRESHOLD_KNOTS)
    stream.add_argument("--alert-topic", help="publish alerts to this topic as well")
    stream.add_argument("--jdbc-url", help="keep latest state and alerts in this database as well")
    stream.add_argument("--watermark", default=schema.WATERMARK)
    stream.add_argument("--keep-late-seconds", type=int, help="store rows that are this much older"
                        " than their vessel's newest in a table of their own, instead of dropping"
                        " what lies behind the watermark (drain and live)")
    stream.add_argument("--live-seconds", type=int, default=schema.LIVE_TRIGGER_SECONDS)
    stream.add_argument("--max-offsets", type=int, default=schema.MAX_OFFSETS_PER_TRIGGER)
    stream.add_argument("--max-records-per-file", type=int, default=schema.MAX_RECORDS_PER_FILE)

    def add_day(job: argparse.ArgumentParser) -> None:
        job.add_argument("--archive", required=True)
        job.add_argument("--results", required=True)
        job.add_argument("--exec-date", default=yesterday)

    def add_ports(job: argparse.ArgumentParser) -> None:
        job.add_argument("--ports", help="Parquet table of ports; the ten built-in ones otherwise")
        job.add_argument("--ports-jdbc-url", help="database that holds the port table")
        add_properties(job)

    def add_kpis(job: argparse.ArgumentParser) -> None:
        add_ports(job)
        job.add_argument("--port-radius-nm", type=float, default=schema.DEFAULT_PORT_RADIUS_NM)
        job.add_argument("--grid-cell-deg", type=float, default=schema.GRID_STEP_DEG)
        job.add_argument("--alert-threshold", type=float, default=schema.ALERT_THRESHOLD_KNOTS)

    def add_clusters(job: argparse.ArgumentParser) -> None:
        job.add_argument("--models", required=True)
        job.add_argument("--k", type=int, default=schema.CLUSTER_COUNT)
        job.add_argument("--anomaly-threshold-pct", type=float,
                         default=schema.ANOMALY_PERCENTILE)
        job.add_argument("--refit-model", action="store_true")

    for name, parts in (("kpis", (add_day, add_kpis)), ("clusters", (add_day, add_clusters)),
                        ("day", (add_day, add_kpis, add_clusters))):
        job = jobs.add_parser(name)
        for part in parts:
            part(job)

    compact = jobs.add_parser("compact", help="rewrite a closed day of the stream's folders")
    compact.add_argument("--base", required=True)
    compact.add_argument("--exec-date", default=yesterday)

    visits = jobs.add_parser("visits", help="complete port visits of the whole archive")
    visits.add_argument("--archive", required=True)
    visits.add_argument("--results", required=True)
    visits.add_argument("--port-radius-nm", type=float, default=schema.DEFAULT_PORT_RADIUS_NM)
    add_ports(visits)

    publish = jobs.add_parser("publish", help="copy a day's result tables to a database")
    publish.add_argument("--results", required=True)
    publish.add_argument("--exec-date", default=yesterday)
    publish.add_argument("--jdbc-url", required=True)
    add_properties(publish)

    history = jobs.add_parser("history", help="clean all messages in one batch")
    add_topic(history)
    history.add_argument("--results", required=True)
    return parser


def _topic(spark: SparkSession, args: argparse.Namespace, streaming: bool) -> DataFrame:
    if args.topic_files:
        if streaming:
            return pipeline.message_files(spark, args.topic_files, max_files=1000)
        return spark.read.schema(schema.MESSAGE_SCHEMA).parquet(args.topic_files)
    if not args.servers:
        raise SystemExit("give --topic-files or --servers")
    limit = getattr(args, "max_offsets", schema.MAX_OFFSETS_PER_TRIGGER)
    return messages.read_topic(spark, args.servers, args.topic, streaming, limit)


def _target(url: str, args: argparse.Namespace) -> jdbc.JdbcTarget:
    return jdbc.JdbcTarget(url, dict(p.split("=", 1) for p in args.jdbc_property))


def _ports(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    if args.ports_jdbc_url:
        return jdbc.read_query(spark, _target(args.ports_jdbc_url, args), jdbc.PORT_QUERY)
    return daily.port_table(spark, args.ports)


def _stream(spark: SparkSession, args: argparse.Namespace) -> None:
    paths = pipeline.StreamPaths(args.base.rstrip("/"))
    publish, database = None, []
    if args.alert_topic:
        if not args.servers:
            raise SystemExit("--alert-topic needs --servers")
        publish = partial(messages.write_topic, servers=args.servers, topic=args.alert_topic)
    if args.jdbc_url:
        target = _target(args.jdbc_url, args)
        database = [JdbcFleetStateSink(target),
                    JdbcAlertSink(target, threshold=args.alert_threshold)]
    if args.mode == "backfill":
        pipeline.backfill(_topic(spark, args, False), paths, args.alert_threshold,
                          args.max_records_per_file, publish, database)
        return
    keep_late = None
    if args.keep_late_seconds is not None:
        keep_late = timedelta(seconds=args.keep_late_seconds)
    sinks = pipeline.default_sinks(
        spark, paths, args.alert_threshold, args.max_records_per_file, publish
    )
    pipeline.run_pipeline(
        _topic(spark, args, True), paths, [*sinks, *database], args.mode, args.watermark,
        args.live_seconds, keep_late
    )


def _kpi_options(args: argparse.Namespace) -> dict:
    return {"port_radius_nm": args.port_radius_nm, "grid_cell_deg": args.grid_cell_deg,
            "alert_threshold": args.alert_threshold}


def _cluster_options(args: argparse.Namespace) -> dict:
    return {"k": args.k, "percent": args.anomaly_threshold_pct, "refit": args.refit_model}


def run(spark: SparkSession, args: argparse.Namespace) -> None:
    try:
        _run(spark, args)
    finally:
        remove_intermediates(spark)


def _run(spark: SparkSession, args: argparse.Namespace) -> None:
    if args.job == "stream":
        _stream(spark, args)
    elif args.job == "history":
        archive.write_by_date(clean_history(_topic(spark, args, False)), args.results)
    elif args.job == "kpis":
        daily.daily_kpis(spark, args.archive, args.results, _ports(spark, args),
                         args.exec_date, **_kpi_options(args))
    elif args.job == "clusters":
        daily.daily_clusters(spark, args.archive, args.results, args.models, args.exec_date,
                             **_cluster_options(args))
    elif args.job == "compact":
        pipeline.compact(spark, pipeline.StreamPaths(args.base.rstrip("/")), args.exec_date)
    elif args.job == "visits":
        daily.all_visits(spark, args.archive, args.results, _ports(spark, args),
                         args.port_radius_nm)
    elif args.job == "publish":
        daily.publish_day(spark, args.results, _target(args.jdbc_url, args), args.exec_date)
    else:
        daily.run_day(spark, args.archive, args.results, args.models, _ports(spark, args),
                      args.exec_date, **_kpi_options(args), **_cluster_options(args))


def main(argv: list[str] | None = None) -> int:
    args = build_parser().parse_args(argv)
    logging.basicConfig(level=logging.INFO)
    spark = build_session(f"wakeline-{args.job}", streaming=args.job == "stream")
    try:
        run(spark, args)
    finally:
        spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())
