"""Checks of spatial joins, sessions, daily key figures and their reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from wakeline_checks import views
from wakeline_checks.registry import DISTANCE, mean, oracle, query, rounded, run_job
from wakeline.functions import ais, geo
from wakeline.operators import sessions
from wakeline.operators.spatial import link_zones_to_ports, ports_in_range, positions_in_zones
from wakeline.plans import kpi, reports
from wakeline.schema import ZONE_SCHEMA, ZONES
from wakeline.session import shared_dir
from wakeline.sources import archive

_WHEN = "CAST(BaseDateTime AS VARCHAR) AS BaseDateTime"
_KEYS = ["MMSI", "port_id"]


def _positions(spark, sf_dir):
    return views.positions(spark, sf_dir)


def _inside(spark, sf_dir, **options):
    return ports_in_range(_positions(spark, sf_dir), views.ports(spark), **options)


# --- positions and ports ----------------------------------------------------------------------

@query("p16_valid_speed", oracle(
    f"SELECT MMSI, {_WHEN}, SOG FROM pos WHERE SOG >= 0 AND SOG < 102.2", "pos"))
def valid_speed(spark, sf_dir):
    return _positions(spark, sf_dir).filter(ais.valid_speed(F.col("SOG"))).select(
        "MMSI", "BaseDateTime", "SOG"
    )


@query("p21_bounding_box", oracle(
    "SELECT port_id, "
    f"{rounded('radius_nm / 60 * 1.2e0', 6)} AS lat_margin, "
    + rounded("radius_nm / (60 * greatest(cos(radians(abs(port_lat))), 0.01e0)) * 1.2e0", 6)
    + " AS lon_margin, count(*) AS positions_in_box FROM pos, ports"
    " WHERE abs(LAT - port_lat) <= radius_nm / 60 * 1.2e0 AND abs(LON - port_lon) <="
    " radius_nm / (60 * greatest(cos(radians(abs(port_lat))), 0.01e0)) * 1.2e0"
    " GROUP BY port_id, port_lat, radius_nm", "pos", "ports"))
def bounding_box(spark, sf_dir):
    """Positions per port box."""
    # The corners of a box lie within 1.2 * sqrt(2) radii, so twice the radius reaches them all.
    wide = views.ports(spark).withColumns({
        "box_radius": F.col("radius_nm"), "radius_nm": F.col("radius_nm") * 2.0,
    })
    near = ports_in_range(_positions(spark, sf_dir), wide)
    lat_margin = geo.lat_margin(F.col("box_radius"))
    lon_margin = geo.lon_margin(F.col("box_radius"), F.col("port_lat"))
    in_box = (F.abs(F.col("LAT") - F.col("port_lat")) <= lat_margin) & (
        geo.lon_gap(F.col("LON"), F.col("port_lon")) <= lon_margin
    )
    return near.filter(in_box).groupBy(
        "port_id", F.round(lat_margin, 6).alias("lat_margin"),
        F.round(lon_margin, 6).alias("lon_margin"),
    ).agg(F.count("*").alias("positions_in_box"))


@query("p22_haversine", oracle(
    f"SELECT MMSI, {_WHEN}, port_id, {rounded(DISTANCE, 6)} AS dist_nm FROM pos, ports"
    f" WHERE {DISTANCE} <= radius_nm * 1.1e0", "pos", "ports"))
def haversine(spark, sf_dir):
    wide = views.ports(spark).withColumn("radius_nm", F.col("radius_nm") * 1.1)
    return ports_in_range(_positions(spark, sf_dir), wide).select(
        "MMSI", "BaseDateTime", "port_id", F.round("dist_nm", 6).alias("dist_nm")
    )


@query("p23_radius_filter", oracle(
    "SELECT port_id, count(*) AS pings, count(DISTINCT MMSI) AS vessels FROM inport"
    " GROUP BY port_id", "inport"))
def radius_filter(spark, sf_dir):
    return _inside(spark, sf_dir).groupBy("port_id").agg(
        F.count("*").alias("pings"), F.count_distinct("MMSI").alias("vessels")
    )


_IN_PORT = (
    f"SELECT MMSI, {_WHEN}, port_id, LAT, LON, {rounded('dist_nm', 6)} AS dist_nm FROM inport"
)


def _in_port_columns(df):
    return df.select(
        "MMSI", "BaseDateTime", "port_id", "LAT", "LON", F.round("dist_nm", 6).alias("dist_nm")
    )


@query("j1_ports_in_range", oracle(_IN_PORT, "inport"))
def in_range(spark, sf_dir):
    return _in_port_columns(_inside(spark, sf_dir))


@query("j1_ports_in_range_salted", oracle(_IN_PORT, "inport"))
def in_range_salted(spark, sf_dir):
    """The way taken when the port list is too large to broadcast."""
    return _in_port_columns(_inside(spark, sf_dir, max_broadcast_rows=0))


# --- sessions ---------------------------------------------------------------------------------

@query("w2_previous_ping", oracle(
    f"SELECT MMSI, port_id, {_WHEN}, CAST(prev_ts AS VARCHAR) AS prev_ts FROM all_lagged",
    "all_lagged"))
def previous_ping(spark, sf_dir):
    return sessions.previous_row_time(_inside(spark, sf_dir), _KEYS, "BaseDateTime").select(
        *_KEYS, "BaseDateTime", "prev_ts"
    )


@query("w3_gap_sessions", oracle(
    f"SELECT MMSI, port_id, {_WHEN}, session_id FROM all_numbered", "all_numbered"))
def gap_session_rows(spark, sf_dir):
    return sessions.tag_sessions(_inside(spark, sf_dir), _KEYS, "BaseDateTime").select(
        *_KEYS, "BaseDateTime", "session_id"
    )


@query("a1_port_visits", oracle(
    "SELECT MMSI, port_id, session_id, CAST(entry_ts AS VARCHAR) AS entry_ts,"
    " CAST(exit_ts AS VARCHAR) AS exit_ts, ping_count FROM all_visits", "all_visits"))
def port_visit_rows(spark, sf_dir):
    return sessions.gap_sessions(_inside(spark, sf_dir), _KEYS, "BaseDateTime").drop(
        "dwell_minutes"
    )


@query("a2_dwell_minutes", oracle(
    "SELECT MMSI, port_id, CAST(entry_ts AS VARCHAR) AS entry_ts, dwell_minutes"
    " FROM all_visits", "all_visits"))
def dwell_minutes(spark, sf_dir):
    return sessions.gap_sessions(_inside(spark, sf_dir), _KEYS, "BaseDateTime").select(
        *_KEYS, "entry_ts", "dwell_minutes"
    )


@query("a3_last_ping_of_day", oracle(
    "SELECT MMSI, CAST(kpi_date AS VARCHAR) AS kpi_date,"
    " CAST(day_last_ping AS VARCHAR) AS day_last_ping FROM last_seen", "last_seen"))
def last_ping(spark, sf_dir):
    return kpi.last_pings(_positions(spark, sf_dir))


@query("j2_visits_with_last_ping", oracle(
    "SELECT v.MMSI, port_id, CAST(entry_ts AS VARCHAR) AS entry_ts,"
    " CAST(exit_ts AS VARCHAR) AS exit_ts, CAST(day_last_ping AS VARCHAR) AS day_last_ping"
    " FROM all_visits AS v LEFT JOIN last_seen AS l"
    " ON v.MMSI = l.MMSI AND CAST(exit_ts AS DATE) = l.kpi_date", "all_visits", "last_seen"))
def visits_with_last_ping(spark, sf_dir):
    visits = sessions.gap_sessions(_inside(spark, sf_dir), _KEYS, "BaseDateTime")
    dated = visits.withColumn("kpi_date", F.to_date("exit_ts"))
    return kpi.with_last_ping(dated, _positions(spark, sf_dir)).select(
        "MMSI", "port_id", "entry_ts", "exit_ts", "day_last_ping")


_DWELL = (
    "SELECT CAST(kpi_date AS VARCHAR) AS kpi_date, mmsi, port_id, CAST(entry_ts AS VARCHAR)"
    " AS entry_ts, CAST(exit_ts AS VARCHAR) AS exit_ts, dwell_minutes FROM dwell"
)


@query("a4_port_dwell_times", oracle(_DWELL, "dwell"))
def dwell_times(spark, sf_dir):
    """The daily rule for every day of the input at once."""
    return kpi.port_dwell_times(_positions(spark, sf_dir), views.ports(spark))


@query("a4_port_dwell_times_one_day", oracle(
    f"{_DWELL} WHERE kpi_date = DATE '2024-01-15'", "dwell"))
def dwell_times_of_day(spark, sf_dir):
    """The same rule as a daily run calls it."""
    return kpi.port_dwell_times(
        _positions(spark, sf_dir), views.ports(spark), exec_date="2024-01-15"
    )


@query("a4_port_visits_whole_range", oracle(
    "SELECT CAST(CAST(exit_ts AS DATE) AS VARCHAR) AS kpi_date, MMSI AS mmsi, port_id,"
    " CAST(entry_ts AS VARCHAR) AS entry_ts, CAST(exit_ts AS VARCHAR) AS exit_ts,"
    " dwell_minutes, ping_count FROM all_visits", "all_visits"))
def visits_whole_range(spark, sf_dir):
    return kpi.port_visits(_positions(spark, sf_dir), views.ports(spark))


# --- fleet figures, grid, alerts --------------------------------------------------------------

_KPI_COLUMNS = (
    "CAST(kpi_date AS VARCHAR) AS kpi_date, vessel_type, avg_sog, min_sog, max_sog, stddev_sog,"
    " ping_count"
)


@query("a5_fleet_daily_kpis", oracle(f"SELECT {_KPI_COLUMNS} FROM kpis", "kpis"))
def fleet_kpis(spark, sf_dir):
    return kpi.fleet_daily_kpis(_positions(spark, sf_dir))


@query("a6_route_density_grid", oracle(
    "SELECT CAST(date AS VARCHAR) AS kpi_date, "
    f"{rounded('round(LAT / 0.05e0) * 0.05e0', 4)} + 0.0 AS grid_lat,"
    f" {rounded('round(LON / 0.05e0) * 0.05e0', 4)} + 0.0 AS grid_lon,"
    " count(*) AS ping_count FROM pos GROUP BY ALL", "pos"))
def density_grid(spark, sf_dir):
    return kpi.route_density_grid(_positions(spark, sf_dir))


_ALERTS = (
    "SELECT CAST(detected_at AS VARCHAR) AS detected_at, mmsi, vessel_name, sog_knots, lat, lon,"
    " nav_status, alert_type, threshold_knots FROM alerts"
)


@query("p18_speed_alerts", oracle(_ALERTS, "alerts"))
def alerts(spark, sf_dir):
    return kpi.speed_alerts(_positions(spark, sf_dir))


@query("p19_alert_filter", oracle(
    f"SELECT MMSI, {_WHEN}, SOG FROM pos WHERE SOG > 102.2", "pos"))
def alert_filter(spark, sf_dir):
    return kpi.speed_violations(_positions(spark, sf_dir), 102.2).select(
        "MMSI", "BaseDateTime", "SOG"
    )


@query("p20_alert_messages", oracle(
    "SELECT CAST(MMSI AS VARCHAR) AS key, MMSI AS mmsi, VesselName AS vessel_name,"
    " SOG AS sog_knots, LAT AS lat, LON AS lon, CAST(BaseDateTime AS VARCHAR) AS base_date_time,"
    " Status AS nav_status, 'SPEED_VIOLATION' AS alert_type, 20.0e0 AS threshold_knots"
    " FROM pos WHERE SOG > 20", "pos"))
def alert_messages(spark, sf_dir):
    """Alert messages, read back by a consumer."""
    sent = kpi.alert_messages(_positions(spark, sf_dir), detected_at=F.col("BaseDateTime"))
    fields = (
        "mmsi BIGINT, vessel_name STRING, sog_knots DOUBLE, lat DOUBLE, lon DOUBLE,"
        " base_date_time TIMESTAMP, nav_status INT, alert_type STRING, threshold_knots DOUBLE"
    )
    return sent.select("key", F.from_json("value", fields).alias("v")).select("key", "v.*")


# --- reports over these tables ----------------------------------------------------------------

@query("a13_violations", oracle("SELECT count(*) AS speed_violations FROM alerts", "alerts"))
def violations(spark, sf_dir):
    return reports.violations(alerts(spark, sf_dir))


@query("a16_dwell_by_port", oracle(
    f"SELECT port_id, {mean('dwell_minutes', 1)} AS avg_dwell_minutes,"
    " count(*) AS dwell_events FROM dwell GROUP BY port_id"
    " ORDER BY avg_dwell_minutes DESC, port_id", "dwell"))
def dwell_by_port(spark, sf_dir):
    return reports.dwell_by_port(dwell_times(spark, sf_dir))


@query("a16_dwell_by_port_and_day", oracle(
    "SELECT CAST(kpi_date AS VARCHAR) AS kpi_date, port_id, count(*) AS completed_dwell_events,"
    f" {mean('dwell_minutes', 1)} AS avg_dwell_mins FROM dwell"
    " GROUP BY kpi_date, port_id", "dwell"))
def dwell_by_port_and_day(spark, sf_dir):
    return reports.dwell_by_port_and_day(dwell_times(spark, sf_dir))


@query("a17_speed_by_type", oracle(
    "SELECT vessel_type, CAST(sum(ping_count) AS BIGINT) AS total_pings,"
    f" {mean('avg_sog', 2)} AS avg_speed, max(max_sog) AS max_speed FROM kpis"
    " GROUP BY vessel_type ORDER BY total_pings DESC, vessel_type", "kpis"))
def speed_by_type(spark, sf_dir):
    return reports.speed_by_type(fleet_kpis(spark, sf_dir))


@query("a28_pings_per_day", oracle(
    "SELECT CAST(kpi_date AS VARCHAR) AS kpi_date, count(*) AS type_rows,"
    " CAST(sum(ping_count) AS BIGINT) AS pings FROM kpis GROUP BY kpi_date", "kpis"))
def pings_per_day(spark, sf_dir):
    return reports.pings_per_day(fleet_kpis(spark, sf_dir))


@query("l2_top_types_of_day", oracle(
    "SELECT CAST(kpi_date AS VARCHAR) AS kpi_date, vessel_type, ping_count,"
    " avg_sog AS avg_sog_kts, max_sog AS max_sog_kts FROM kpis"
    " WHERE kpi_date = DATE '2024-01-15' ORDER BY ping_count DESC, vessel_type LIMIT 5",
    "kpis"))
def top_types(spark, sf_dir):
    return reports.top_types_of_day(fleet_kpis(spark, sf_dir), "2024-01-15")


@query("l3_alert_log", oracle(
    "SELECT CAST(detected_at AS VARCHAR) AS detected_at, mmsi, vessel_name, sog_knots,"
    " threshold_knots, lat, lon FROM alerts ORDER BY detected_at DESC, mmsi, sog_knots, lat, lon,"
    " vessel_name LIMIT 100", "alerts"))
def alert_log(spark, sf_dir):
    return reports.alert_log(alerts(spark, sf_dir))


@query("l7_busiest_ports", oracle(
    "SELECT port_id, count(*) AS dwell_events, "
    f"{mean('dwell_minutes', 1)} AS avg_dwell_minutes FROM dwell GROUP BY port_id"
    " ORDER BY avg_dwell_minutes DESC, port_id LIMIT 5", "dwell"))
def busiest_ports(spark, sf_dir):
    return reports.busiest_ports(dwell_times(spark, sf_dir))


@query("p31_day_predicate", oracle(
    f"SELECT {_KPI_COLUMNS} FROM kpis WHERE kpi_date = DATE '2024-01-20'", "kpis"))
def day_predicate(spark, sf_dir):
    return reports.on_day(fleet_kpis(spark, sf_dir), "2024-01-20")


@query("u2_union_two_days", oracle(
    f"SELECT MMSI, {_WHEN}, CAST(date AS VARCHAR) AS date FROM pos"
    " WHERE date BETWEEN DATE '2024-01-14' AND DATE '2024-01-15'", "pos"))
def union_two_days(spark, sf_dir):
    columns = ["MMSI", "BaseDateTime", "date"]
    positions = _positions(spark, sf_dir).select(*columns)
    days = [reports.on_day(positions, day, "date") for day in ("2024-01-14", "2024-01-15")]
    return days[0].unionByName(days[1])


@query("u3_distinct_rows", oracle(
    "SELECT DISTINCT MMSI, port_id, CAST(date AS VARCHAR) AS date FROM inport", "inport"))
def distinct_rows(spark, sf_dir):
    return _inside(spark, sf_dir).select("MMSI", "port_id", "date").distinct()


@query("j5_zones_of_ports", oracle(
    "SELECT z.port_name, port_id AS port_ref_id, count(MMSI) AS positions FROM"
    " (SELECT * FROM (VALUES ('Port Said', 32.25, 32.35, 31.20, 31.30),"
    " ('Suez Port', 32.52, 32.60, 29.95, 30.05), ('Alexandria Port', 29.85, 29.95, 31.17, 31.23))"
    " AS z(port_name, west, east, south, north)) AS z JOIN ports ON z.port_name = ports.port_name"
    " JOIN pos ON LAT BETWEEN south AND north AND LON BETWEEN west AND east GROUP BY ALL",
    "pos", "ports"))
def zones_of_ports(spark, sf_dir):
    """Positions per seeded zone, zones linked to the ports of their name (also G1)."""
    zones = link_zones_to_ports(spark.createDataFrame(ZONES, ZONE_SCHEMA), views.ports(spark))
    inside = positions_in_zones(_positions(spark, sf_dir), zones)
    return inside.groupBy("port_name", "port_ref_id").agg(F.count("*").alias("positions"))


@query("a4_port_visits_stored", oracle(
    "SELECT MMSI AS mmsi, port_id, CAST(entry_ts AS VARCHAR) AS entry_ts,"
    " CAST(exit_ts AS VARCHAR) AS exit_ts, ping_count, dwell_minutes FROM all_visits",
    "all_visits"))
def stored_visits(spark, sf_dir):
    """The visits job over a stored archive and a stored port table."""
    base = shared_dir(spark, "visits")
    archive.write_by_date(_positions(spark, sf_dir), f"{base}/archive")
    views.ports(spark).write.parquet(f"{base}/ports")
    run_job(spark, "visits", "--archive", f"{base}/archive", "--results", base,
            "--ports", f"{base}/ports")
    return spark.read.parquet(f"{base}/port_visits").drop("kpi_date")
