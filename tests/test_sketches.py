from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tests.helpers import messages, record, rows
from wakeline.operators import sketches
from wakeline.plans import basics
from wakeline.plans.congestion import port_congestion, port_slots
from wakeline.session import shared_dir
from wakeline.sources import archive
from wakeline.streaming import pipeline
from wakeline.streaming.positions import clean_batch


def test_quantiles_of_merged_days(spark):
    df = spark.range(20_000).select((F.col("id") % 7).alias("day"), (F.col("id") % 2).alias("g"),
                                    F.when(F.col("id") % 11 > 0, F.col("id").cast("double")).alias("v"))
    days = sketches.quantile_sketches(df, ["day", "g"], "v")
    assert days.count() == 14
    for row in sketches.merged_quantiles(days, ["g"], 0.95).collect():
        values = sorted(r.v for r in df.where(f"g = {row.g} and v is not null").collect())
        assert row.n == len(values)
        rank = sum(v <= row.threshold for v in values) / len(values)
        assert abs(rank - 0.95) <= 0.0266


def test_members_of_two_ranges(spark):
    df = spark.createDataFrame(
        [(p, d, m) for p, d, lo, hi in ((1, 1, 0, 60), (1, 2, 40, 90), (2, 1, 0, 5), (3, 2, 0, 7))
         for m in range(lo, hi)] * 2, "port int, day int, m bigint")
    found = sketches.members_of_both(sketches.member_sketches(df, ["port", "day"], "m"), ["port"],
                                     F.col("day") == 1, F.col("day") == 2)
    assert rows(found) == [(1, 60, 50, 20), (2, 5, 0, 0), (3, 0, 7, 0)]


def test_theta_error_beyond_its_exact_range(spark):
    df = spark.range(60_000).select(F.lit(1).alias("g"), (F.col("id") % 2).alias("day"),
                                    (F.col("id") / 3).cast("bigint").alias("m"))
    row = sketches.members_of_both(sketches.member_sketches(df, ["g", "day"], "m"), ["g"],
                                   F.col("day") == 0, F.col("day") == 1).first()
    assert abs(row.in_first - 20_000) < 1_200 and abs(row.in_both - 20_000) < 1_500


def test_congestion_windows_sketched_and_exact(spark):
    start = datetime(2024, 12, 25, 10)
    inside = spark.createDataFrame(
        [("P", v, start + timedelta(minutes=m), float(v % 9) if v % 4 else None)
         for v in range(300) for m in (v % 40, 40 + v % 50)],
        "port_id string, MMSI bigint, BaseDateTime timestamp, SOG double")
    exact = rows(port_congestion(port_slots(inside, exact=True), exact=True))
    assert {(r[1], r[2]) for r in exact} == {
        (w, len({v for v in range(300) for m in (v % 40, 40 + v % 50)
                 if w <= start + timedelta(minutes=m) < w + timedelta(hours=1)}))
        for w in {r[1] for r in exact}}
    assert {r[4] for r in exact} == {"HIGH"} or len({r[4] for r in exact}) > 1
    for real, found in zip(exact, rows(port_congestion(port_slots(inside)))):
        assert real[:2] == found[:2] and abs(real[2] - found[2]) <= 0.06 * real[2] + 1
    with pytest.raises(ValueError):
        port_congestion(port_slots(inside), window_seconds=1000)


def test_month_columns_of_all_years(spark):
    df = spark.createDataFrame([(date(1990, 1, 5),), (date(2031, 1, 6),), (date(2031, 2, 1),), (None,)],
                               "d date")
    table = basics.month_table(df, "d")
    assert table.columns == ["month", "n_all", "n_1990", "n_2031"]
    assert rows(table) == [(1, 2, 1, 1), (2, 1, 0, 1)]
    assert basics.per_day(table).columns == ["month", "per_day_1990", "per_day_2031"]


def test_late_rows_are_kept_beside_the_archive(spark):
    def at(mmsi, clock):
        return record(MMSI=mmsi, BaseDateTime=f"2024-12-25T{clock}:00")

    batches = [[at("366000001", "10:00"), at("366000001", "10:00"), at("366000002", "08:00")],
               [at("366000001", "09:00"), at("366000001", "09:55"), at("366000002", "08:30")],
               [at("366000001", "09:00"), at("366000001", "10:00"), at("366000002", "07:00")]]
    base = shared_dir(spark, "late")
    for values in batches:
        messages(spark, values).coalesce(1).write.mode("append").parquet(f"{base}/topic")
    paths = pipeline.StreamPaths(base)
    from wakeline_checks.streams import own_session
    own = own_session(spark)
    pipeline.run_pipeline(pipeline.message_files(own, f"{base}/topic"), paths,
                          pipeline.default_sinks(own, paths), keep_late=timedelta(minutes=30))

    def keys(path):
        return rows(archive.read_archive(spark, path).select(
            "MMSI", F.date_format("BaseDateTime", "HH:mm")))

    assert keys(paths.archive) == [(366000001, "09:55"), (366000001, "10:00"), (366000002, "08:00"),
                                   (366000002, "08:30")]
    assert keys(paths.late_positions) == [(366000001, "09:00"), (366000002, "07:00")]


def test_a_backfill_returns_the_counts_of_its_write(spark):
    values = [record(), record(MMSI="1"), "{", record(MMSI="MMSI"), record(LAT="99")]
    paths = pipeline.StreamPaths(shared_dir(spark, "counted"))
    counts = pipeline.backfill(messages(spark, values), paths)
    assert {k: n for k, n in counts.items() if n} == {
        "clean": 1, "mmsi_invalid": 1, "dead_letter": 1, "header": 1, "position_out_of_range": 1}
    assert clean_batch(messages(spark, values)).clean.count() == 1
