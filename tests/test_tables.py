from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tests.helpers import positions, raw_frame, record, rows
from wakeline.operators.latest import latest_by_key, replace_day, upsert
from wakeline.operators.quality import GateError, require_rows
from wakeline.plans.daily import seed_ports
from wakeline.schema import FLEET_STATE_SCHEMA, PORT_SCHEMA
from wakeline.session import shared_dir
from wakeline.sources import archive, csv_archive, files, jdbc, tables

KV = "k INT, v INT"


def test_latest_row_has_greatest_time_nulls_last(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 3, "b"), (1, None, "c"), (2, None, "d")],
                               "k INT, t INT, v STRING")
    assert rows(latest_by_key(df, ["k"], "t")) == [(1, 3, "b"), (2, None, "d")]


def test_latest_of_equal_times_is_stable(spark):
    df = spark.createDataFrame([(1, 5, i) for i in range(50)], "k INT, t INT, v INT")
    assert {rows(latest_by_key(df.repartition(n), ["k"], "t"))[0][2] for n in (1, 4, 9)} == {49}


def test_upsert(spark):
    table = spark.createDataFrame([(1, 1), (2, 2)], KV)
    update = spark.createDataFrame([(2, 9), (3, 3)], KV)
    once = upsert(table, update, ["k"])
    assert rows(once) == [(1, 1), (2, 9), (3, 3)]
    assert rows(upsert(once, update, ["k"])) == rows(once)


def test_upsert_overwrites_with_null_and_keeps_other_columns(spark):
    schema = "k INT, a INT, b INT"
    table = spark.createDataFrame([(1, 1, 1)], schema)
    update = spark.createDataFrame([(1, None, 7), (2, 5, 6)], schema)
    assert rows(upsert(table, update, ["k"], ["a"])) == [(1, None, 1), (2, 5, 6)]


def test_guarded_upsert_keeps_newer_rows(spark):
    schema = "k INT, t INT, v STRING"
    table = spark.createDataFrame([(1, 5, "new"), (2, 5, "same")], schema)
    update = spark.createDataFrame([(1, 3, "late"), (2, 5, "again"), (3, 1, "first")], schema)
    assert rows(upsert(table, update, ["k"], newer_by="t")) == [
        (1, 5, "new"), (2, 5, "again"), (3, 1, "first")
    ]


def day_rows(spark, *pairs):
    return spark.createDataFrame(
        [(date(2024, 12, d), v) for d, v in pairs], "kpi_date DATE, v INT"
    )


def test_replace_day(spark):
    table = day_rows(spark, (24, 1), (25, 2), (25, 3))
    new = day_rows(spark, (25, 9), (26, 4))
    once = replace_day(table, new, "kpi_date", "2024-12-25")
    assert [r[1] for r in rows(once)] == [1, 9]
    assert rows(replace_day(once, new, "kpi_date", "2024-12-25")) == rows(once)


def test_stored_replace_and_removal_of_a_day(spark):
    path = shared_dir(spark, "t")
    tables.upsert_table(day_rows(spark, (24, 1), (25, 2)), path, ["kpi_date", "v"])
    for _ in range(2):
        tables.replace_table_day(day_rows(spark, (25, 9)), path, "2024-12-25")
        assert sorted(r["v"] for r in tables.read_table(spark, path).collect()) == [1, 9]
    tables.replace_table_day(day_rows(spark, (26, 1)), path, "2024-12-25")
    assert [r["v"] for r in tables.read_table(spark, path).collect()] == [1]


def test_stored_upsert_rewrites_only_touched_days(spark):
    path = shared_dir(spark, "t")
    schema = "kpi_date DATE, k INT, v INT"
    first = spark.createDataFrame([(date(2024, 12, d), k, 0) for d in (24, 25) for k in (1, 2)],
                                  schema)
    tables.upsert_table(first, path, ["kpi_date", "k"])
    untouched = files.children(spark, f"{path}/kpi_date=2024-12-24")
    tables.upsert_table(spark.createDataFrame([(date(2024, 12, 25), 2, 5)], schema), path,
                        ["kpi_date", "k"])
    found = tables.read_table(spark, path).select("kpi_date", "k", "v")
    assert [r[2] for r in rows(found)] == [0, 0, 0, 5]
    assert files.children(spark, f"{path}/kpi_date=2024-12-24") == untouched


def test_stray_days_fail_the_upsert(spark):
    path = shared_dir(spark, "t")
    mixed = day_rows(spark, (25, 1), (26, 2))
    for _ in range(2):  # before and after the first write
        with pytest.raises(Exception, match="row outside of 2024-12-25: 2024-12-26"):
            tables.upsert_table(mixed, path, ["kpi_date", "v"], days=["2024-12-25"])
        tables.upsert_table(day_rows(spark, (25, 1)), path, ["kpi_date", "v"],
                            days=["2024-12-25"])
    assert tables.read_table(spark, path).count() == 1
    with pytest.raises(Exception, match="no day"):
        tables.upsert_table(
            spark.createDataFrame([(None, 1)], "kpi_date DATE, v INT"), path, ["v"],
            days=["2024-12-25"])


def test_rows_without_a_day_are_upserted_once(spark):
    path = shared_dir(spark, "t")
    update = spark.createDataFrame([(None, 1), (None, 2)], "kpi_date DATE, v INT")
    for _ in range(2):
        tables.upsert_table(update, path, ["kpi_date", "v"])
    assert tables.read_table(spark, path).count() == 2


def state(spark, *items):
    return spark.createDataFrame(
        [(k, "n", 0.0, 0.0, "POINT(0.0 0.0)", s, None, None, None, datetime(2024, 12, d, h), None)
         for k, d, h, s in items], FLEET_STATE_SCHEMA).withColumn(
        "event_date", F.to_date("event_ts"))


def test_state_of_appended_changes(spark):
    path = shared_dir(spark, "s")

    def current():
        found = tables.latest_state(spark, path, FLEET_STATE_SCHEMA, ["mmsi"], "event_ts")
        return rows(found.select("mmsi", "sog_knots"))

    assert current() == []
    archive.append_by_date(state(spark, (1, 25, 5, 1.0), (2, 25, 5, 1.0)), path, "event_date")
    update = state(spark, (1, 25, 3, 9.0), (2, 25, 6, 9.0), (3, 24, 1, 9.0))
    expected = [(1, 1.0), (2, 9.0), (3, 9.0)]
    for _ in range(2):
        archive.append_by_date(update, path, "event_date")
        assert current() == expected
    tables.compact_changes(spark, path, "2024-12-25", FLEET_STATE_SCHEMA, ["mmsi"], "event_ts",
                           "event_date")
    assert current() == expected
    assert spark.read.parquet(f"{path}/event_date=2024-12-25").count() == 2
    tables.compact_changes(spark, path, "2024-12-01", FLEET_STATE_SCHEMA, ["mmsi"], "event_ts",
                           "event_date")


def test_state_reads_the_snapshot_and_later_days_only(spark):
    path = shared_dir(spark, "s")

    def write(day, *items):
        changes = state(spark, *items).drop("event_date").withColumn(
            "written_on", F.lit(date(2024, 12, day)))
        archive.append_by_date(changes, path, "written_on")

    def snapshot(day):
        tables.snapshot_state(spark, path, f"2024-12-{day}", FLEET_STATE_SCHEMA, ["mmsi"],
                              "event_ts")

    def current():
        found = tables.latest_state(spark, path, FLEET_STATE_SCHEMA, ["mmsi"], "event_ts")
        folders = {name.split("/")[-2] for name in found.inputFiles()}
        return folders, rows(found.select("mmsi", "sog_knots"))

    write(10, (1, 10, 5, 1.0), (2, 10, 5, 1.0))
    write(11, (1, 11, 5, 2.0))
    write(12, (3, 12, 5, 3.0))
    snapshot(11)
    assert current() == ({"as_of=2024-12-11", "written_on=2024-12-12"},
                         [(1, 2.0), (2, 1.0), (3, 3.0)])
    # Late positions are written on a later day, whatever day they are of.
    write(13, (2, 10, 9, 7.0), (1, 10, 1, 8.0))
    for day in (12, 13, 13):
        snapshot(day)
    assert current() == ({"as_of=2024-12-13"}, [(1, 2.0), (2, 7.0), (3, 3.0)])
    assert files.children(spark, f"{path}/_snapshot") == ["as_of=2024-12-12", "as_of=2024-12-13"]
    with pytest.raises(ValueError):
        tables.snapshot_state(spark, path, date.today().isoformat(), FLEET_STATE_SCHEMA, ["mmsi"],
                              "event_ts")


def test_rows_added_while_a_day_is_compacted_stay(spark):
    path = shared_dir(spark, "a")
    first = positions(spark, [(1, "2024-12-25 10:00:00", 0.0, 0.0)] * 2)
    added = positions(spark, [(2, "2024-12-25 11:00:00", 0.0, 0.0)])
    archive.append_by_date(first, path)
    old = files.children(spark, f"{path}/date=2024-12-25")
    archive.append_by_date(added, path)
    archive.replace_files(first.limit(1), path, "2024-12-25", old)
    assert rows(archive.read_archive(spark, path).select("MMSI")) == [(1,), (2,)]


def test_archive_days_and_batches(spark):
    path = shared_dir(spark, "a")
    pings = positions(spark, [(k, f"2024-12-{d} 10:00:00", 0.0, 0.0)
                              for d in (24, 25, 26) for k in range(10)])
    key = ["MMSI", "BaseDateTime"]
    for batch in (0, 0, 1):
        archive.append_new(pings.filter(F.col("MMSI") % 2 == batch), path, key)
    archive.write_marker(spark, path, 1, "run")
    assert archive.read_archive(spark, path).count() == 30
    folders = [n for n in files.children(spark, path) if n.startswith("date=")]
    assert len(folders) == 3 and not [n for n in files.children(spark, f"{path}/{folders[0]}")
                                      if "=" in n]
    day = archive.read_days(spark, path, "2024-12-25")
    assert day.count() == 10
    assert "PartitionFilters: [isnotnull(date" in day._jdf.queryExecution().executedPlan().toString()
    assert archive.read_day_with_previous(spark, path, "2024-12-25").count() == 20
    assert archive.read_day_with_previous(spark, path, "2024-12-24").count() == 10
    assert archive.read_archive(spark, path, [date(2024, 12, 1)]) is None
    archive.require_day(spark, path, "2024-12-25")
    with pytest.raises(GateError):
        archive.require_day(spark, path, "2024-12-31")
    archive.append_by_date(day, path)
    archive.compact_day(spark, path, "2024-12-25", key)
    assert archive.read_archive(spark, path).count() == 30


def test_one_large_day_is_split_over_files(spark):
    path = shared_dir(spark, "a")
    df = spark.range(10_000).withColumn("date", F.lit(date(2024, 12, 25)))
    archive.write_by_date(df, path, max_records=3000)
    parts = [n for n in files.children(spark, f"{path}/date=2024-12-25") if n.endswith("parquet")]
    assert len(parts) == 4
    assert archive.read_archive(spark, path).count() == 10_000


def write_text(spark, folder, name, text):
    path = f"{folder}/{name}"
    fs, target = files._fs(spark, path)
    stream = fs.create(target)
    stream.write(bytearray(text.encode()))
    stream.close()
    return path


def test_csv_archive_rules(spark):
    folder = shared_dir(spark, "csv")
    good = write_text(spark, folder, "a.csv",
                      "MMSI,BaseDateTime,LAT,LON,VesselName\n"
                      " 366000001 ,t1,1,2,\" A, \"\"B\"\" \"\n"
                      "MMSI,BaseDateTime,LAT,LON,VesselName\n"
                      ",t2,1,2,x\n"
                      "366000002,t3\n"
                      "366000003,t4,1,2,C,surplus\n")
    swapped = write_text(spark, folder, "b.csv", "LAT,MMSI\n5,366000004\n")
    without = write_text(spark, folder, "c.csv", "LAT,LON\n1,2\n")
    empty = write_text(spark, folder, "d.csv", "")
    paths = [good, swapped, without, empty, f"{folder}/missing.csv"]
    found = csv_archive.read_archive(spark, paths)
    assert rows(found.select("MMSI", "BaseDateTime", "LAT", "VesselName")) == [
        ("366000001", "t1", "1", 'A, "B"'), ("366000002", "t3", "", ""),
        ("366000003", "t4", "1", "C"), ("366000004", "", "5", ""),
    ]
    listing = csv_archive.list_archive(spark, paths)
    assert (listing.missing, listing.empty, listing.without_mmsi) == (
        [f"{folder}/missing.csv"], [empty], [without])
    assert sum(csv_archive.require_archive_rows(spark, paths).values()) == 4
    with pytest.raises(GateError, match="missing.csv"):
        csv_archive.require_archive_rows(spark, [empty, f"{folder}/missing.csv"])


def test_row_gate(spark):
    full, none = day_rows(spark, (25, 1), (25, 2)), day_rows(spark, (24, 1))
    assert require_rows({"a": full, "b": none}, "2024-12-25", ["a"]) == {"a": 2, "b": 0}
    with pytest.raises(GateError, match="b"):
        require_rows({"a": full, "b": none}, "2024-12-25", ["a", "b"])


def test_seeding_ports_twice_keeps_changes_out(spark):
    path = shared_dir(spark, "ports")
    old = spark.createDataFrame([("US_HOU", "Old name", 0.0, 0.0, 1.0), ("X", "x", 1.0, 1.0, 2.0)],
                                PORT_SCHEMA)
    old.write.parquet(path)
    found = {r["port_id"]: r["port_name"] for r in seed_ports(spark, path).collect()}
    assert len(found) == 11 and found["US_HOU"] == "Port of Houston" and found["X"] == "x"


def test_geometry_fill_touches_only_missing_rows_of_the_day(spark):
    df = spark.createDataFrame(
        [(date(2024, 12, 25), 1.5, 2.0, None), (date(2024, 12, 25), 1.5, 2.0, "kept"),
         (date(2024, 12, 24), 1.5, 2.0, None), (date(2024, 12, 25), None, 2.0, None)],
        "kpi_date DATE, lon DOUBLE, lat DOUBLE, geom_wkt STRING")
    found = [r["geom_wkt"] for r in tables.fill_geometry(df, "2024-12-25").collect()]
    assert found == ["POINT(1.5 2.0)", "kept", None, None]


def test_jdbc_statements():
    assert jdbc.staging_name("t", "2024-12-25") == "stg_t_20241225"
    assert jdbc.upsert_sql("t", "s", ["a", "b"], ["a"], ["b"]) == (
        "INSERT INTO t (a, b) SELECT DISTINCT a, b FROM s ON CONFLICT (a) DO UPDATE SET b = EXCLUDED.b"
    )
    assert jdbc.upsert_sql("t", "s", ["a", "b"], ["a"], ["b"], "b").endswith(
        "WHERE t.b <= EXCLUDED.b")
    assert jdbc.delete_day_sql("t", "d") == "DELETE FROM t WHERE d = ?"
    assert jdbc.delete_day_sql("t", "d", True) == "DELETE FROM t WHERE DATE(d) = ?"


def test_literal_rows(spark):
    assert raw_frame(spark, [record()]).first()["MMSI"] == "366000001"


class RecordedWork:
    """Stands for the database: keeps statements and appended tables in order."""

    def __init__(self, monkeypatch):
        self.log = []
        monkeypatch.setattr(jdbc, "execute", lambda spark, target, statements: self.log.extend(
            (text.split(" (")[0], tuple(days)) for text, days in statements))
        monkeypatch.setattr(jdbc, "append_rows", lambda df, target, table, **_: self.log.append(
            ("append", table, df.count())))


def test_jdbc_upsert_order_and_cleanup(spark, monkeypatch):
    work = RecordedWork(monkeypatch)
    target = jdbc.JdbcTarget("jdbc:none", {})
    df = spark.createDataFrame([(1, 1), (2, 2)], KV)
    jdbc.upsert_via_staging(df, target, "t", ["k"], ["v"], "2024-12-25")
    assert [entry[0].split(" ")[0] for entry in work.log] == [
        "CREATE", "TRUNCATE", "append", "INSERT", "DROP"]
    assert ("append", "stg_t_20241225", 2) in work.log

    def fail(*args, **kwargs):
        raise ValueError("no connection")

    work.log.clear()
    monkeypatch.setattr(jdbc, "append_rows", fail)
    with pytest.raises(ValueError):
        jdbc.upsert_via_staging(df, target, "t", ["k"], ["v"])
    assert work.log[-1][0].startswith("DROP")


def test_jdbc_replace_day_deletes_and_inserts_together(spark, monkeypatch):
    work = RecordedWork(monkeypatch)
    jdbc.replace_day(spark.createDataFrame([(1, 1)], KV), jdbc.JdbcTarget("jdbc:none", {}), "t",
                     "kpi_date", "2024-12-25")
    assert [entry[0].split(" ")[0] for entry in work.log] == [
        "CREATE", "TRUNCATE", "append", "DELETE", "INSERT", "DROP"]
    assert ("DELETE FROM t WHERE kpi_date = ?", ("2024-12-25",)) in work.log


def test_jdbc_stream_sinks(spark, monkeypatch):
    from wakeline.streaming.sinks import JdbcAlertSink, JdbcFleetStateSink

    work = RecordedWork(monkeypatch)
    target = jdbc.JdbcTarget("jdbc:none", {})
    batch = positions(spark, [(1, "2024-12-25 10:00:00", 1.0, 1.0, 30.0, 70),
                              (1, "2024-12-25 11:00:00", 1.0, 1.0, 5.0, 70)])
    JdbcFleetStateSink(target)(batch, 7)
    JdbcAlertSink(target)(batch, 7)
    assert ("append", "stg_active_fleet_state_batch7", 1) in work.log
    assert ("append", "stg_vessel_speed_alerts_batch7", 1) in work.log


def test_view_of_latest_state(spark):
    from wakeline.plans.reports import fleet_view

    table = state(spark, (1, 25, 5, 1.0)).withColumn("geom_wkt", F.lit("POINT(-95.1 29.8)"))
    fleet_view(table).createOrReplaceTempView("v_active_fleet_state")
    found = spark.sql("SELECT lat, lon FROM v_active_fleet_state").first()
    assert (found["lat"], found["lon"]) == (29.8, -95.1)
