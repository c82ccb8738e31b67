from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tests.helpers import positions, rows
from wakeline.operators.geofence import geofence_events, with_neighbours
from wakeline.operators.spatial import positions_in_zones, zone_of_each
from wakeline.session import shared_dir
from wakeline.streaming.geofence import stream_geofence_events
from wakeline_checks.streams import drain, own_session

SQUARE = "POLYGON((0 0, 2 0, 2 2, 0 2, 0 0))"


def zones(spark, *named):
    return spark.createDataFrame(list(named), "port_name string, geom_wkt string")


def day(clock):
    return f"2024-12-25 {clock}:00"


# Enters A, stays, leaves; enters again and is silent for over an hour; comes back; is last seen in A.
TRACK = [(1, day("10:00"), 1.0, 1.0), (1, day("10:10"), 1.5, 1.0), (1, day("10:20"), 5.0, 5.0),
         (1, day("10:30"), 2.0, 2.0), (1, day("12:00"), 1.0, 1.0), (2, day("12:30"), 9.0, 9.0)]
EVENTS = [("ENTER", "10:00"), ("INSIDE", "10:10"), ("EXIT", "10:20"), ("ENTER", "10:30"),
          ("EXIT", "11:30"), ("ENTER", "12:00")]


def events_of(df):
    return sorted(((r.event_type, r.event_time.strftime("%H:%M")) for r in df.collect()),
                  key=lambda e: (e[1], e[0]))


def test_events_of_a_track(spark):
    placed = zone_of_each(positions(spark, TRACK), zones(spark, ("A", SQUARE)))
    found = geofence_events(placed, silence_seconds=3600)
    assert events_of(found) == sorted(EVENTS, key=lambda e: (e[1], e[0]))
    for until, more in (("12:59", []), ("13:00", [("EXIT", "13:00")])):
        known = F.lit(datetime.fromisoformat(day(until)))
        assert events_of(geofence_events(placed, silence_seconds=3600, known_until=known)) == sorted(
            EVENTS + more, key=lambda e: (e[1], e[0]))


def test_stream_gives_the_same_with_timers_and_late_rows(spark):
    own, base = own_session(spark), shared_dir(spark, "geo")
    track = positions(own, TRACK + [(2, day("14:30"), 9.0, 9.0)])
    clock = F.date_format("BaseDateTime", "HH:mm")
    parts = [clock < "10:25", (clock >= "10:25") & (clock < "12:10"), clock >= "12:10"]
    for number, part in enumerate(parts):
        batch = track.filter(part)
        if number == 1:
            # A position older than the newest one of its vessel changes nothing.
            batch = batch.union(positions(own, [(1, day("10:15"), 9.0, 9.0)]))
        batch.coalesce(1).write.mode("append").parquet(f"{base}/in")
    stream = own.readStream.schema(track.schema).option("maxFilesPerTrigger", 1).parquet(f"{base}/in")
    drain(own, stream_geofence_events(zone_of_each(stream, zones(own, ("A", SQUARE))),
                                      silence_seconds=3600, watermark="10 minutes"), "append", base)
    assert events_of(spark.read.parquet(f"{base}/table")) == sorted(
        EVENTS + [("EXIT", "13:00")], key=lambda e: (e[1], e[0]))


def test_neighbours_of_a_hot_key(spark):
    df = spark.range(2000).select(F.lit(1).alias("k"), F.timestamp_seconds(F.col("id") * 7).alias("t"),
                                  F.col("id").alias("v"))
    found = with_neighbours(df, ["k"], "t", "v").select("v", "before.value", "after.value").toDF(
        "v", "b", "a").orderBy("v").collect()
    assert [(r.b, r.a) for r in found] == [
        (i - 1 if i else None, i + 1 if i < 1999 else None) for i in range(2000)]


def test_polygons(spark):
    named = [
        ("concave", "POLYGON((0 0, 4 0, 4 4, 2 1, 0 4, 0 0))"),
        ("hole", "POLYGON((0 0, 4 0, 4 4, 0 4, 0 0), (1 1, 3 1, 3 3, 1 3, 1 1))"),
        ("parts", "MULTIPOLYGON(((10 10, 11 10, 11 11, 10 10)), ((20 20, 21 20, 21 21, 20 20)))"),
        ("none", None), ("text", "nothing"),
    ]
    points = {1: (0.5, 1.5), 2: (2.0, 2.0), 3: (3.5, 3.9), 4: (10.4, 10.6), 5: (20.2, 20.8),
              6: (4.0, 2.0), 7: (50.0, 50.0)}
    track = positions(spark, [(k, day("10:00"), lat, lon) for k, (lat, lon) in points.items()])
    found = positions_in_zones(track, zones(spark, *named))
    assert rows(found.select("MMSI", "port_name")) == [
        (1, "concave"), (1, "hole"), (3, "concave"), (3, "hole"), (4, "parts"), (5, "parts"),
        (6, "hole")]
    placed = zone_of_each(track, zones(spark, *named))
    assert placed.where("port_name is null").select("MMSI").distinct().count() == 2
    with pytest.raises(ValueError):
        zone_of_each(track, zones(spark, *named), max_broadcast_rows=1)
