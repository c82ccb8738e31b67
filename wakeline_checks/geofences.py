"""Checks of zone events, polygons and nearest vessels against DuckDB."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from wakeline.operators.geofence import geofence_events
from wakeline.operators.nearest import nearest_vessels
from wakeline.operators.spatial import positions_in_zones, zone_of_each
from wakeline.schema import ZONE_SCHEMA, ZONES
from wakeline.session import materialize, shared_dir
from wakeline.streaming.geofence import final_watermark, stream_geofence_events
from wakeline.streaming.positions import clean_batch
from wakeline_checks import views
from wakeline_checks.registry import oracle, query, rounded
from wakeline_checks.streams import drain, own_session, write_in_turn

_SILENCE = 24 * 3600
_DELAY = timedelta(minutes=10)


def _rectangles() -> str:
    rows = []
    for name, *_, wkt in ZONES:
        xy = [tuple(p.split()) for p in wkt.strip("POLYGN()").split(", ")]
        x, y = sorted({float(p[0]) for p in xy}), sorted({float(p[1]) for p in xy})
        rows.append(f"('{name}', {x[0]!r}e0, {x[1]!r}e0, {y[0]!r}e0, {y[1]!r}e0)")
    return f"(VALUES {', '.join(rows)}) AS z(port_name, west, east, south, north)"


_LIMIT = "BaseDateTime + INTERVAL 24 HOUR"
_EVENTS = oracle("SELECT 1", "unique_rows").removesuffix(" SELECT 1") + (
    ", visited AS (SELECT MMSI, BaseDateTime, list(port_name) FILTER (port_name IS NOT NULL)"
    f" AS zones FROM unique_rows LEFT JOIN {_rectangles()} ON LAT BETWEEN south AND north"
    " AND LON BETWEEN west AND east GROUP BY 1, 2),"
    " around AS (SELECT *, lag(BaseDateTime) OVER w AS t0, lag(zones) OVER w AS z0,"
    " lead(BaseDateTime) OVER w AS t1, lead(zones) OVER w AS z1 FROM visited"
    " WINDOW w AS (PARTITION BY MMSI ORDER BY BaseDateTime)),"
    " there AS (SELECT *, unnest(zones) AS port_name FROM around)"
    " SELECT MMSI, port_name, CASE WHEN list_contains(coalesce(z0, []), port_name)"
    " AND BaseDateTime <= t0 + INTERVAL 24 HOUR THEN 'INSIDE' ELSE 'ENTER' END AS event_type,"
    " CAST(BaseDateTime AS VARCHAR) AS event_time FROM there UNION ALL"
    " SELECT MMSI, port_name, 'EXIT',"
    f" CAST(CASE WHEN t1 <= {_LIMIT} THEN t1 ELSE {_LIMIT} END AS VARCHAR) FROM there"
    f" WHERE (t1 <= {_LIMIT} AND NOT list_contains(coalesce(z1, []), port_name))"
    f" OR t1 > {_LIMIT} OR (t1 IS NULL AND {_LIMIT} <="
    " (SELECT max(BaseDateTime) - INTERVAL 10 MINUTE FROM unique_rows))")


def _positions(spark, sf_dir):
    return clean_batch(views.messages(spark, sf_dir)).clean.select(
        "MMSI", "BaseDateTime", "LAT", "LON")


def _zones(spark):
    return spark.createDataFrame(ZONES, ZONE_SCHEMA)


@query("g2_geofence_events", _EVENTS)
def events_in_batch(spark, sf_dir):
    positions = _positions(spark, sf_dir)
    return geofence_events(
        zone_of_each(positions, _zones(spark)), silence_seconds=_SILENCE,
        known_until=final_watermark(positions, "BaseDateTime", _DELAY))


@query("g2_geofence_streamed", _EVENTS)
def events_in_a_stream(spark, sf_dir):
    """The same events from three micro-batches in order of time; silences end by timers."""
    own, base = own_session(spark), shared_dir(spark, "geofence")
    positions = materialize(_positions(own, sf_dir), "positions")
    bounds = positions.agg(F.min("BaseDateTime").alias("a"), F.max("BaseDateTime").alias("b")).first()
    if bounds["a"] is None:
        bounds = {"a": None, "b": None}
        thirds = []
    else:
        third = (bounds["b"] - bounds["a"]) / 3
        thirds = [bounds["a"] + third, bounds["a"] + 2 * third]
    place = sum((F.col("BaseDateTime") >= F.lit(t).cast("timestamp")).cast("int") for t in thirds)
    parts = [positions.filter(place == number) for number in range(3)] if thirds else [positions]
    each = write_in_turn(own, parts, f"{base}/positions")
    stream = own.readStream.schema(positions.schema).option("maxFilesPerTrigger", each).parquet(
        f"{base}/positions")
    events = stream_geofence_events(
        zone_of_each(stream, _zones(own)), silence_seconds=_SILENCE,
        watermark=f"{int(_DELAY.total_seconds())} seconds")
    drain(own, events, "append", base)
    return spark.read.parquet(f"{base}/table").drop("batch_id")


# A concave zone with a hole, and one of two parts, around the middle of the seeded ports.
_RINGS = [
    (1, [(32.25, 31.2), (32.35, 31.2), (32.35, 31.3), (32.3, 31.23), (32.25, 31.3), (32.25, 31.2)]),
    (1, [(32.29, 31.205), (32.31, 31.205), (32.3, 31.22), (32.29, 31.205)]),
    (2, [(32.52, 29.93), (32.6, 29.97), (32.52, 30.01), (32.56, 29.97), (32.52, 29.93)]),
    (2, [(29.85, 31.17), (29.9, 31.17), (29.9, 31.21), (29.85, 31.21), (29.85, 31.17)]),
]


def _wkt(number: int) -> str:
    rings = ["(" + ", ".join(f"{x} {y}" for x, y in ring) + ")" for n, ring in _RINGS if n == number]
    if number == 1:
        return f"POLYGON({', '.join(rings)})"
    return "MULTIPOLYGON(" + ", ".join(f"({ring})" for ring in rings) + ")"


_EDGES = ", ".join(
    f"({n}, {a[0]!r}e0, {a[1]!r}e0, {b[0]!r}e0, {b[1]!r}e0)"
    for n, ring in _RINGS for a, b in zip(ring, ring[1:]))


@query("g1_polygons", oracle(
    "SELECT zone, MMSI, CAST(BaseDateTime AS VARCHAR) AS BaseDateTime, count(*) AS n FROM ("
    "SELECT zone, pos.e AS e, MMSI, BaseDateTime, bool_or((bx - ax) * (LAT - ay) = (LON - ax) * (by_ - ay)"
    " AND LON BETWEEN least(ax, bx) AND greatest(ax, bx)"
    " AND LAT BETWEEN least(ay, by_) AND greatest(ay, by_)) OR count(*) FILTER ("
    "(ay > LAT) <> (by_ > LAT) AND LON < (bx - ax) * (LAT - ay) / (by_ - ay) + ax) % 2 = 1 AS inside"
    " FROM (SELECT row_number() OVER () AS e, * FROM pos) AS pos,"
    f" (VALUES {_EDGES}) AS edges(zone, ax, ay, bx, by_) GROUP BY ALL) WHERE inside GROUP BY ALL",
    "pos"))
def polygons(spark, sf_dir):
    """Positions in a concave zone with a hole and in a zone of two parts."""
    zones = spark.createDataFrame([(1, _wkt(1)), (2, _wkt(2))], "zone int, geom_wkt string")
    return positions_in_zones(views.positions(spark, sf_dir), zones).groupBy(
        "zone", "MMSI", "BaseDateTime").agg(F.count("*").alias("n"))


_APART = (
    "(pow(sin((radians(a.LAT) - radians(b.LAT)) / 2), 2) + cos(radians(a.LAT)) * cos(radians(b.LAT))"
    " * pow(sin((radians(a.LON) - radians(b.LON)) / 2), 2))"
)
_NEWEST = (
    "newest AS (SELECT * FROM (SELECT date_trunc('hour', BaseDateTime) AS hour, MMSI, LAT, LON, SOG,"
    " COG, row_number() OVER (PARTITION BY date_trunc('hour', BaseDateTime), MMSI ORDER BY"
    " BaseDateTime DESC, LAT DESC, LON DESC, SOG DESC NULLS LAST, COG DESC NULLS LAST) AS place"
    " FROM pos) WHERE place = 1),"
    " pairs AS (SELECT a.hour, a.MMSI AS mmsi, b.MMSI AS near_mmsi, a.LAT AS lat, a.LON AS lon,"
    " a.SOG AS sog, a.COG AS cog, b.LAT AS lat2, b.LON AS lon2, b.SOG AS sog2, b.COG AS cog2,"
    f" round(2 * 3440.065e0 * atan2(sqrt({_APART}), sqrt(1 - {_APART})), 6) AS d"
    " FROM newest AS a JOIN newest AS b ON a.hour = b.hour AND a.MMSI <> b.MMSI"
    " AND abs(a.LAT - b.LAT) < 0.06),"
    " best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY hour, mmsi ORDER BY d,"
    " near_mmsi) AS place FROM pairs WHERE d <= 3) WHERE place = 1),"
    " moved AS (SELECT *, (lon2 - lon) * 60 * cos(radians(lat)) AS x, (lat2 - lat) * 60 AS y,"
    " sog2 * sin(radians(cog2)) / 60 - sog * sin(radians(cog)) / 60 AS u,"
    " sog2 * cos(radians(cog2)) / 60 - sog * cos(radians(cog)) / 60 AS v FROM best),"
    " timed AS (SELECT *, CASE WHEN u * u + v * v > 0 THEN greatest(0, -(x * u + y * v)"
    " / (u * u + v * v)) WHEN u * u + v * v = 0 THEN 0 END AS t FROM moved)"
)


@query("g4_nearest_vessels", oracle("SELECT 1", "pos").removesuffix(" SELECT 1") + (
    f", {_NEWEST} SELECT CAST(n.hour AS VARCHAR) AS hour, n.MMSI AS mmsi, near_mmsi,"
    f" {rounded('d', 4)} AS distance_nm, {rounded('t', 2)} AS cpa_minutes FROM newest AS n"
    " LEFT JOIN timed AS t ON n.hour = t.hour AND n.MMSI = t.mmsi"))
def nearest(spark, sf_dir):
    """The nearest vessel within three miles in each hour, one row a vessel and hour."""
    found = nearest_vessels(views.positions(spark, sf_dir), 3.0, unit="hour")
    return found.select(F.col("minute").alias("hour"), "mmsi", "near_mmsi",
                        F.round("distance_nm", 4).alias("distance_nm"),
                        "cpa_minutes")
