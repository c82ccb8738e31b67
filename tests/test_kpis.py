import math
import random
from collections import defaultdict
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tests.helpers import positions, rows
from wakeline.functions import geo
from wakeline.operators import sessions
from wakeline.operators.spatial import link_zones_to_ports, ports_in_range
from wakeline.plans import kpi
from wakeline.plans.daily import seed_ports
from wakeline.schema import PORT_SCHEMA, PORTS, ZONE_SCHEMA, ZONES

PEV_LAT, PEV_LON = 26.09, -80.12


def haversine(lat_a, lon_a, lat_b, lon_b):
    p, q = math.radians(lat_a), math.radians(lat_b)
    a = (math.sin((p - q) / 2) ** 2
         + math.cos(p) * math.cos(q) * math.sin(math.radians(lon_a - lon_b) / 2) ** 2)
    return 2 * 3440.065 * math.atan2(math.sqrt(a), math.sqrt(1 - a))


def test_radius_rule(spark):
    pings = positions(spark, [
        (1, "2024-12-25 10:00:00", PEV_LAT + offset, PEV_LON) for offset in (0.0, 0.04, 0.055)
    ])
    found = ports_in_range(pings, seed_ports(spark))
    assert [round(r["dist_nm"], 4) for r in found.orderBy("dist_nm").collect()] == [0.0, 2.4016]


@pytest.mark.parametrize("cell_deg, broadcast_rows", [(0.25, 1000), (0.25, 0), (0.7, 0), (2.0, 0)])
def test_cell_join_equals_comparing_every_pair(spark, cell_deg, broadcast_rows):
    """Random positions and overlapping ports, also across the antimeridian and far north."""
    rng = random.Random(5)
    ports = [
        ("A", "a", 179.95, 10.0, 20.0), ("B", "b", -179.9, 10.1, 30.0),
        ("C", "c", 5.0, 78.0, 40.0), ("D", "d", -180.0, -5.0, 15.0), ("E", "e", 0.0, 0.0, None),
    ]
    points = []
    for number in range(400):
        _, _, lon, lat, radius = rng.choice(ports)
        spread = (radius or 3.0) / 60 * 1.3
        lat_p = lat + rng.uniform(-spread, spread)
        lon_p = lon + rng.uniform(-spread, spread) / max(math.cos(math.radians(lat)), 0.01)
        lon_p = (lon_p + 180) % 360 - 180
        points.append((number, "2024-12-25 10:00:00", lat_p, lon_p))
    expected = sorted(
        (n, p[0]) for n, _, lat, lon in points for p in ports
        if haversine(lat, lon, p[3], p[2]) <= (p[4] or 3.0)
    )
    found = ports_in_range(
        positions(spark, points), spark.createDataFrame(ports, PORT_SCHEMA), 3.0, cell_deg,
        max_broadcast_rows=broadcast_rows,
    )
    assert sorted((r["MMSI"], r["port_id"]) for r in found.collect()) == expected
    assert expected


def test_session_gap_is_inclusive(spark):
    pings = positions(spark, [
        (1, f"2024-12-25 {t}", PEV_LAT, PEV_LON)
        for t in ("10:00:00", "12:00:00", "14:00:00", "16:00:01")
    ])
    found = sessions.gap_sessions(pings, ["MMSI"], "BaseDateTime").orderBy("session_id").collect()
    assert [(r["dwell_minutes"], r["ping_count"]) for r in found] == [(240.0, 3), (0.0, 1)]


def brute_sessions(times, gap):
    result, current = [], []
    for t in sorted(times):
        if current and (t - current[-1]).total_seconds() > gap:
            result.append(current)
            current = []
        current.append(t)
    return result + [current]


@pytest.mark.parametrize("gap", [7200, 1000, 3601])
def test_sessions_of_a_hot_key_equal_row_by_row_sessions(spark, gap):
    """One key with a third of all rows, repeated times included."""
    rng = random.Random(gap)
    start = datetime(2024, 12, 25)
    data = []
    for number in range(900):
        key = 0 if number % 3 == 0 else number % 40 + 1
        spread = 200_000 if key == 0 else 90_000
        data.append((key, start + timedelta(seconds=rng.randrange(spread))))
    data += data[:30]
    df = spark.createDataFrame(data, "k INT, t TIMESTAMP").repartition(5)
    by_key = defaultdict(list)
    for key, t in data:
        by_key[key].append(t)
    expected = sorted(
        (key, number, s[0], s[-1], len(s))
        for key, times in by_key.items()
        for number, s in enumerate(brute_sessions(times, gap), start=1)
    )
    found = sessions.gap_sessions(df, ["k"], "t", gap).select(
        "k", "session_id", "entry_ts", "exit_ts", "ping_count"
    )
    assert sorted(tuple(r) for r in found.collect()) == expected
    tagged = sessions.tag_sessions(df, ["k"], "t", gap).groupBy("k", "session_id").agg(
        F.min("t"), F.max("t"), F.count("*")
    )
    assert sorted(tuple(r) for r in tagged.collect()) == expected
    lagged = sessions.previous_row_time(df, ["k"], "t", bin_seconds=500)
    pairs = sorted(
        (key, t, before)
        for key, times in by_key.items()
        for before, t in zip([datetime.min, *sorted(times)], sorted(times))
    )
    assert sorted(
        (r["k"], r["t"], r["prev_ts"] or datetime.min) for r in lagged.collect()
    ) == pairs


def dwell(spark, pings, day="2024-12-25"):
    return kpi.port_dwell_times(positions(spark, pings), seed_ports(spark), day)


def test_open_visits_are_deferred(spark):
    here = (PEV_LAT, PEV_LON)
    pings = [
        (1, "2024-12-25 23:00:00", *here),
        (2, "2024-12-25 21:59:59", *here),
        (3, "2024-12-25 22:00:00", *here),
        (4, "2024-12-25 23:00:00", *here), (4, "2024-12-25 23:30:00", 0.0, 0.0),
    ]
    assert [r["mmsi"] for r in dwell(spark, pings).orderBy("mmsi").collect()] == [2, 4]


def test_visit_across_midnight_is_reported_once_by_the_second_day(spark):
    here = (PEV_LAT, PEV_LON)
    pings = [(1, "2024-12-25 23:00:00", *here), (1, "2024-12-26 00:30:00", *here),
             (1, "2024-12-26 03:00:00", 0.0, 0.0)]
    assert dwell(spark, pings, "2024-12-25").count() == 0
    found = dwell(spark, pings, "2024-12-26").collect()
    assert [(r["dwell_minutes"], r["entry_ts"].day) for r in found] == [(90.0, 25)]


def test_all_days_at_once_equal_each_day_alone(spark):
    rng = random.Random(3)
    start = datetime(2024, 12, 20)
    pings = []
    for number in range(500):
        port = PORTS[rng.randrange(3)]
        t = start + timedelta(seconds=rng.randrange(5 * 86400))
        away = 0.5 if rng.random() < 0.2 else 0.0
        pings.append((rng.randrange(6), str(t), port[3] + away, port[2]))
    together = rows(kpi.port_dwell_times(positions(spark, pings), seed_ports(spark)))
    alone = []
    for day in range(20, 26):
        alone += [tuple(r) for r in dwell(spark, pings, f"2024-12-{day}").collect()]
    assert together == sorted(alone, key=repr)
    assert together


def test_range_version_keeps_visits_the_daily_rule_loses(spark):
    here = (PEV_LAT, PEV_LON)
    pings = [(1, "2024-12-25 23:00:00", *here), (1, "2024-12-26 02:00:00", *here),
             (1, "2024-12-26 12:00:00", 0.0, 0.0)]
    daily = kpi.port_dwell_times(positions(spark, pings), seed_ports(spark))
    whole = kpi.port_visits(positions(spark, pings), seed_ports(spark))
    assert daily.count() == 1 and whole.count() == 2


def test_fleet_figures(spark):
    pings = [(1, "2024-12-25 10:00:00", 0.0, 0.0, sog, 70) for sog in (0.0, 10.0, 20.0, 102.2, None)]
    pings += [(2, "2024-12-25 10:00:00", 0.0, 0.0, 5.0, None),
              (3, "2024-12-25 10:00:00", 0.0, 0.0, 7.0, 99)]
    found = {r["vessel_type"]: tuple(r)[2:] for r in kpi.fleet_daily_kpis(
        positions(spark, pings), "2024-12-25").collect()}
    assert found["Cargo (70)"] == (10.0, 0.0, 20.0, 10.0, 3)
    assert found["Unknown"] == (5.0, 5.0, 5.0, 0.0, 1)
    assert found["Type 99"][4] == 1


def test_grid_cell(spark):
    found = kpi.route_density_grid(
        positions(spark, [(1, "2024-12-25 10:00:00", 29.81, -95.13)]), "2024-12-25").first()
    assert (found["grid_lat"], found["grid_lon"], found["ping_count"]) == (29.8, -95.15, 1)


def test_grid_rank_equals_round(spark):
    edges = [0.5, -0.5, 0.49999999999999994, -0.49999999999999994, 1.5, 2.5, -2.5, 0.0, -0.0,
             595.4999999999999, 595.5, 1.4999999999999998]
    rng = random.Random(1)
    values = edges + [rng.uniform(-180, 180) for _ in range(5000)] + [
        rng.randrange(-7200, 7200) * 0.025 for _ in range(2000)]
    df = spark.createDataFrame([(v,) for v in values], "v DOUBLE")
    for step in (0.05, 1.0, 0.1):
        wrong = df.filter(
            geo.grid_rank(F.col("v"), step) != F.round(F.col("v") / step).cast("int"))
        assert wrong.count() == 0


def test_alert_threshold_is_exclusive(spark):
    pings = [(1, "2024-12-25 10:00:00", 0.0, 0.0, sog) for sog in (20.0, 20.01, None)]
    found = kpi.speed_alerts(positions(spark, pings)).collect()
    assert [r["sog_knots"] for r in found] == [20.01]
    assert found[0]["alert_type"] == "SPEED_VIOLATION" and found[0]["threshold_knots"] == 20.0


def test_zones_are_linked_by_port_name(spark):
    zones = spark.createDataFrame([*ZONES, ("Elsewhere", "port", "EG", "POLYGON((0 0))")],
                                  ZONE_SCHEMA)
    found = {r["port_name"]: r["port_ref_id"]
             for r in link_zones_to_ports(zones, seed_ports(spark)).collect()}
    assert found == {"Port Said": "EG_PSD", "Suez Port": "EG_SUZ", "Alexandria Port": "EG_ALY",
                     "Elsewhere": None}
